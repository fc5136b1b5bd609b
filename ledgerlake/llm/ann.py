"""Approximate nearest neighbours with a hash-prefix forest.

In every tree a vector is a string of bits, the sides of random hyperplanes it lies on, and the tree is the sorted array
of these strings. The upper levels of a few trees lie across the cluster: rows that share a prefix of such a tree are a
block, and a query meets the blocks of its own prefixes only. How many of these trees are used, and how far a query
ascends in all of them, comes from the exact neighbours, in the whole table, of a bounded sample of rows.

The lower levels lie within a block. There a query descends each tree to its longest matching prefix and then
ascends all trees of the block in step, prefix by prefix, until the matches of all trees reach a number; these candidates
are scored exactly. A block finds that number itself, from a sample of its own rows. So the wanted recall holds whatever
the data look like: where nothing is near anything, queries ascend to the root and meet every block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import ship, written

BITS = 64
#: Rows of a block, queries that are put to a block at once, trees, and rows of a block from which it is tuned.
BLOCK, CHUNK, TREES, PROBES = 8192, 2048, 64, 96
#: Share of the probes' exact neighbours that a block's number of matches would have found.
AIM = 0.94
#: Trees that may lie across the cluster, bits of their strings, rows of the table from which their use is decided, and
#: the share of those rows' exact neighbours that must be in a block that the row meets.
ROUTES, ROUTE_BITS, SAMPLE, ROUTE_AIM = 16, 32, 128, 0.98


def usable(vector: Column) -> Column:
    """Whether a vector is there, with finite components that are not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Scaled so that squares neither overflow nor vanish; cosines stay the same."""
    largest = np.abs(vectors).max(axis=1, keepdims=True)
    return np.where((largest > 1e100) | (largest < 1e-100), vectors / largest, vectors)


def cosines(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Cosines in double precision; equal vectors get equal values."""
    dots = np.einsum("ij,j->i", vectors, query)
    norms = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
    return dots / (norms * np.sqrt(np.einsum("j,j->", query, query)))


class Forest:
    """The sorted arrays of one block."""

    def __init__(self, vectors: np.ndarray, trees: int = TREES, seed: int = 0):
        self.vectors = vectors
        planes = np.random.default_rng(seed).standard_normal((trees, vectors.shape[1], BITS))
        self.planes = planes
        codes = self.codes(vectors)
        self.order = [np.argsort(c, kind="stable") for c in codes]
        self.arrays = [c[o] for c, o in zip(codes, self.order)]

    def codes(self, vectors: np.ndarray) -> list[np.ndarray]:
        """Each vector's bit string in each tree, as an unsigned integer."""
        out = []
        for planes in self.planes:
            bits = np.packbits(vectors @ planes > 0, axis=1)
            out.append(bits.view(">u8").ravel().astype(np.uint64))
        return out

    def ranges(self, codes: list[np.ndarray], level: int) -> tuple[np.ndarray, np.ndarray]:
        """Where, in each tree's array, the strings begin and end that share the first `level` bits; (trees, queries)."""
        if level == 0:
            shape = (len(codes), len(codes[0]))
            return np.zeros(shape, np.int64), np.full(shape, len(self.vectors))
        free = np.uint64((1 << (BITS - level)) - 1)
        low = [np.searchsorted(a, c & ~free, side="left") for a, c in zip(self.arrays, codes)]
        high = [np.searchsorted(a, c | free, side="right") for a, c in zip(self.arrays, codes)]
        return np.array(low), np.array(high)

    def candidates(self, queries: np.ndarray, matches: int):
        """Yields (query, rows): all rows of the longest prefixes at which the trees together have `matches`."""
        codes = self.codes(queries)
        waiting = np.arange(len(queries))
        for level in range(BITS, -1, -1):
            low, high = self.ranges([c[waiting] for c in codes], level)
            done = (high - low).sum(axis=0) >= matches if level else np.ones(len(waiting), bool)
            for k in np.flatnonzero(done):
                parts = [o[a:b] for o, a, b in zip(self.order, low[:, k], high[:, k]) if b > a]
                yield int(waiting[k]), np.unique(np.concatenate(parts)) if level else np.arange(len(self.vectors))
            waiting = waiting[~done]
            if not len(waiting):
                return

    def tune(self, k: int, probes: int = PROBES, aim: float = AIM) -> int:
        """Matches at which `aim` of the exact k neighbours of the block's first rows are among the candidates."""
        n = len(self.vectors)
        probes, k = min(probes, n), min(k, n - 1)
        least = len(self.planes) * (k + 2)  # then some tree alone has more than k others
        if k < 1:
            return least
        codes, own = self.codes(self.vectors), range(probes)
        needed = []
        counts = np.empty((BITS + 1, probes), dtype=np.int64)
        for level in range(BITS + 1):
            low, high = self.ranges([c[:probes] for c in codes], level)
            counts[level] = (high - low).sum(axis=0)
        for p in own:
            score = cosines(self.vectors[p], self.vectors)
            score[p] = -np.inf
            near = np.argpartition(-score, k - 1)[:k]
            differ = np.array([c[near] ^ c[p] for c in codes])
            # common leading bits: those before the first difference
            common = BITS - np.ceil(np.log2(differ.astype(np.float64) + 1)).astype(np.int64)
            needed += counts[np.clip(common.max(axis=0), 0, BITS), p].tolist()
        return max(least, int(np.ceil(np.quantile(needed, aim))))


def _search(index: pd.DataFrame, queries: pd.DataFrame, k: int) -> pd.DataFrame:
    found = []
    if len(index) and len(queries):
        index = index.sort_values("row")
        rows, ids = index["row"].to_numpy(), index["vec_id"]
        vectors = _unit(np.stack(index["vec"].to_list()).astype(np.float64))
        asked = _unit(np.stack(queries["vec"].to_list()).astype(np.float64))
        forest = Forest(vectors)
        own, names = queries["row"].to_numpy(), queries["vec_id"].tolist()
        order = ids.fillna(np.iinfo(np.int64).max).to_numpy(dtype=np.int64)
        for q, at in forest.candidates(asked, forest.tune(k)):
            at = at[rows[at] != own[q]]
            score = cosines(asked[q], vectors[at])
            best = np.lexsort((rows[at], order[at], -score))[:k]
            found += [(own[q], names[q], rows[at[b]], ids.iloc[at[b]], score[b]) for b in best]
    return pd.DataFrame(found, columns=["query_row", "query_id", "row", "vec_id", "score"]).astype(
        {"query_id": "Int64", "vec_id": "Int64"}
    )


# ---- upper levels ---------------------------------------------------------------------------------------------------


def _prefixes(vectors: np.ndarray) -> np.ndarray:
    """The bit strings of vectors of one length in the trees across the cluster; (trees, rows)."""
    dim = vectors.shape[1]
    planes = np.random.default_rng([1, dim]).standard_normal((ROUTES, dim, ROUTE_BITS))
    return np.stack([np.packbits(vectors @ p > 0, axis=1).view(">u4").ravel() for p in planes]).astype(np.int64)


def _by_length(batch: pa.RecordBatch, lengths) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, places, vectors) for each of the lengths that occur."""
    dims = batch.column("dim").to_numpy()
    for dim in np.intersect1d(dims, list(lengths)).tolist():
        at = np.flatnonzero(dims == dim)
        yield dim, at, _unit(batch.column("vec").take(pa.array(at)).flatten().to_numpy().reshape(len(at), dim))


def _shared_bits(rows: DataFrame, lengths: list[int], k: int) -> dict[int, np.ndarray]:
    """For the exact neighbours of a sample of each length's rows: leading bits in common with their row, tree by tree."""
    few = Window.partitionBy("dim").orderBy(F.xxhash64("row"), "row")
    drawn = rows.filter(F.col("dim").isin(lengths)).select("dim", "row", F.row_number().over(few).alias("at")).filter(F.col("at") <= SAMPLE)
    sample = rows.select("dim", "row", "vec").join(drawn, ["dim", "row"]).toPandas()  # SAMPLE rows a length
    probes = {}
    for dim, own in sample.groupby("dim"):
        vectors = _unit(np.stack(own["vec"].to_list()).astype(np.float64))
        probes[dim] = own["row"].to_numpy(), vectors / np.linalg.norm(vectors, axis=1)[:, None], _prefixes(vectors)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {}
        for batch in batches:
            for dim, at, vectors in _by_length(batch, probes):
                own, asked, strings = probes[dim]
                score = asked @ (vectors / np.linalg.norm(vectors, axis=1)[:, None]).T
                ids = batch.column("row").to_numpy()[at]
                score[own[:, None] == ids] = -np.inf
                differ = strings[:, :, None] ^ _prefixes(vectors)[:, None, :]
                common = ROUTE_BITS - np.frexp(differ.astype(np.float64))[1]
                ids = np.broadcast_to(ids, score.shape)
                if dim in best:
                    score, ids, common = (np.concatenate(x, axis=-1) for x in zip(best[dim], (score, ids, common)))
                top = np.argsort(-score, axis=1, kind="stable")[:, :k]
                best[dim] = (
                    np.take_along_axis(score, top, 1), np.take_along_axis(ids, top, 1), np.take_along_axis(common, np.broadcast_to(top, (ROUTES, *top.shape)), 2)
                )
        for dim, (score, ids, common) in best.items():
            probe, place = np.nonzero(np.isfinite(score))
            bits = common[:, probe, place].T.astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(probe), dim, np.int32)), pa.array(probe), pa.array(ids[probe, place]), pa.array(score[probe, place]), pa.array(list(bits), pa.list_(pa.int32()))],
                names=["dim", "probe", "row", "score", "common"],
            )

    found = rows.select("dim", "row", "vec").mapInArrow(near, "dim int, probe long, row long, score double, common array<int>")
    order = Window.partitionBy("dim", "probe").orderBy(F.desc("score"), "row")
    found = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("dim", "common").toPandas()
    return {dim: np.stack(part["common"].to_list()) for dim, part in found.groupby("dim")}  # k times SAMPLE rows a length


def _trees_and_level(common: np.ndarray, depth: int) -> tuple[int, int]:
    """Trees to use, and leading bits that a query's blocks share with it, so that it meets the fewest blocks."""
    ways = []
    for trees in range(1, ROUTES + 1):
        reach = np.sort(common[:, :trees].max(axis=1))
        level = min(int(reach[int((1 - ROUTE_AIM) * len(reach))]), depth)
        ways.append((trees << (depth - level), trees, level))
    # from the root one tree shows all rows
    return min([*ways, (1 << depth, 1, 0)])[1:]


def _plan(index: DataFrame, k: int, block: int) -> dict[int, tuple[int, int, int]]:
    """(trees, bits of a block's prefix, bits that a query's blocks share with it) by length; lengths of few vectors have one block."""
    counts = index.groupBy("dim").count().filter(F.col("count") > block).collect()  # a row for each length of many vectors
    depth = {r["dim"]: min((-(-r["count"] // block) - 1).bit_length(), ROUTE_BITS) for r in counts}
    shared = _shared_bits(index, list(depth), k) if depth else {}
    chosen = {dim: _trees_and_level(shared[dim], bits) for dim, bits in depth.items()}
    return {dim: (trees, depth[dim], level) for dim, (trees, level) in chosen.items()}


def _with_blocks(rows: DataFrame, plan: dict[int, tuple[int, int, int]], asks: bool) -> DataFrame:
    """Each row once for every tree and block it belongs to or, as a query, meets: columns tree and leaf."""

    # rows taken at once, so that their blocks are few enough to hold
    step = max(1, 100_000 // max((trees << (depth - level if asks else 0) for trees, depth, level in plan.values()), default=1))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(k, step) for b in batches for k in range(0, b.num_rows, step)):
            dims = batch.column("dim").to_numpy()
            at, tree, leaf = [np.flatnonzero(~np.isin(dims, list(plan)))], [], []
            tree.append(np.zeros(len(at[0]), np.int32))
            leaf.append(np.zeros(len(at[0]), np.int64))
            for dim, own, vectors in _by_length(batch, plan):
                trees, depth, level = plan[dim]
                free = depth - level if asks else 0
                strings = _prefixes(vectors)[:trees] >> (ROUTE_BITS - depth) >> free << free
                blocks = strings[:, :, None] + np.arange(1 << free)
                at.append(np.broadcast_to(own[None, :, None], blocks.shape).ravel())
                tree.append(np.broadcast_to(np.arange(trees, dtype=np.int32)[:, None, None], blocks.shape).ravel())
                leaf.append(blocks.ravel())
            at, tree, leaf = (np.concatenate(x) for x in (at, tree, leaf))
            for i in range(0, len(at), 1000):
                part = batch.take(pa.array(at[i : i + 1000]))
                yield part.append_column("tree", pa.array(tree[i : i + 1000])).append_column("leaf", pa.array(leaf[i : i + 1000]))

    return rows.mapInArrow(place, "dim int, row long, vec_id long, vec array<double>, tree int, leaf long")


def nearest(
    vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", block: int = BLOCK
) -> DataFrame:
    """query_id, rank, vec_id and score: for each row that `is_query` names, its k nearest other rows by cosine.

    Vectors that are null, all zero or hold null or non-finite components take no
    part, as query or candidate; vectors of another length than the query's are no
    candidates. Ties go to the smaller vec_id, null ids last. Of repeated rows
    each is a row of its own, and a query's candidates are all rows but its own. Of
    equal vectors only the first k + 1 can be among anyone's k nearest, so no more are
    indexed. A task holds one block, of `block` rows, and one chunk of queries.
    """
    ship(vectors.sparkSession)
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vec"), is_query.alias("ask")
    ).filter(usable(F.col("vec")))
    rows = written(
        rows.withColumns({"dim": F.size("vec"), "ask": F.coalesce("ask", F.lit(False)), "row": F.monotonically_increasing_id()}),
        "ann-rows",
    )
    columns, keys = ["dim", "row", "vec_id", "vec"], ["dim", "tree", "leaf"]
    copies = Window.partitionBy("vec").orderBy(F.asc_nulls_last("vec_id"), "row")
    index = written(rows.withColumn("copy", F.row_number().over(copies)).filter(F.col("copy") <= k + 1).select(*columns), "ann-index")
    plan = _plan(index, k, block)
    index = _with_blocks(index, plan, False)
    queries = written(_with_blocks(rows.filter("ask").select(*columns), plan, True), "ann-queries")
    # a block of many rows is cut into pieces, and its queries into chunks
    index = written(index, "ann-blocks")
    sizes = index.groupBy(*keys).agg(F.ceil(F.count("*") / block).cast("int").alias("pieces"))
    asked = queries.groupBy(*keys).agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"))
    sizes = written(sizes.join(asked, keys), "ann-sizes")
    deal = lambda parts, seed: F.pmod(F.xxhash64("row", F.lit(seed)), parts).cast("int")
    every = lambda parts: F.explode(F.sequence(F.lit(0), F.col(parts) - 1))
    index = index.join(sizes, keys).select(*columns, "tree", "leaf", deal(F.col("pieces"), 1).alias("piece"), every("chunks").alias("chunk"))
    queries = queries.join(sizes, keys).select(*columns, "tree", "leaf", every("pieces").alias("piece"), deal(F.col("chunks"), 2).alias("chunk"))
    keys += ["piece", "chunk"]
    found = index.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInPandas(
        lambda left, right: _search(left, right, k),
        "query_row long, query_id long, row long, vec_id long, score double",
    )
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    return (
        found.dropDuplicates(["query_row", "row"]).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
