"""Grouped prefix join: documents whose word n-gram sets reach a Jaccard similarity, as connected components.

Sets that reach similarity t share one of their first n - ceil(t * n) + 1 n-grams in any common order. Rare first is a
good one, so n-grams are ordered by a sketch of how many documents hold them. Equal sets are one class; classes of
equal size and prefix are one group. Groups are paired over the lists of groups that share a prefix n-gram; pairs must
pass the size, position and bitmap bounds, and what is left is expanded to members and verified on the whole sets.

A short list is paired as a whole. In a long one, first each group is paired with a few leaders, then each class with its
nearest of another component; pairs that these links already connect need no check for the components, and the rest is
compared block by block inside tasks, so no list is expanded into all its pairs. No pair that may be a link is left out.
Where links are counted, the pairs within components are compared block by block and verified as well.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import Words, chunked, discard, gathered, mix, ship, written
from ledgerlake.llm.components import components

#: Places of the sketch of n-gram frequencies, as a power of two.
SKETCH_BITS = 20
#: 64-bit words of the bitmap of a set of up to 1024 n-grams; each doubling of the set doubles it.
BITMAP, BITMAP_SET = 32, 1024
#: Classes in a list that is paired as a whole; classes in a block of a longer one; leaders of such a list.
SHORT, BLOCK, LEADERS = 64, 512, 3
#: Bits of the filter that finds again the documents whose sets are needed, as a power of two.
FILTER_BITS = 23


def shingles(text: bytes | None, n: int) -> np.ndarray:
    """The set of hashes of word n-grams, sorted; of fewer words, one hash of all; of none, empty."""
    words = Words(text or b"", lower=True)
    if not len(words):
        return words.hash[:0]
    return np.unique(words.windows(n)) if len(words) >= n else words.whole()


# ---- frequencies ----------------------------------------------------------------------------------------------------


def frequency_levels(texts: DataFrame, n: int) -> np.ndarray:
    """For each place of the sketch, log2 of how many times documents have an n-gram that falls there."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(1 << SKETCH_BITS, dtype=np.int64)
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                found = [shingles(t.as_py(), n) for t in batch.column(0).slice(k, 256)]
                seen += np.bincount((np.concatenate(found) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=len(seen))
        yield chunked(seen)

    total = gathered(texts.mapInArrow(count, "chunk int, data binary"), "add")
    if not len(total):
        total = np.zeros(1 << SKETCH_BITS, dtype=np.int64)
    return np.log2(np.maximum(total, 1)).astype(np.uint8)


# ---- keys of one document -------------------------------------------------------------------------------------------


def _need(a: Column, b: Column, t: Fraction) -> Column:
    """The overlap that sets of sizes a and b need: the least k with k / (a + b - k) >= t."""
    return F.ceil((a + b) * F.lit(t.numerator) / F.lit(t.numerator + t.denominator) - F.lit(1e-9))


def _sketched(grams: np.ndarray, levels: np.ndarray, t: Fraction) -> tuple[np.ndarray, np.ndarray]:
    """Prefix in rare-first order, and bitmap."""
    level = levels[(grams >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)].astype(np.uint64)
    ordered = np.sort(level << np.uint64(58) | grams >> np.uint64(6))
    n = len(grams)
    prefix = ordered[: n - -(-n * t.numerator // t.denominator) + 1]
    words = BITMAP << (-(-n // BITMAP_SET) - 1).bit_length()
    bits = np.zeros(words * 64, dtype=np.uint8)
    bits[(mix(grams) & np.uint64(words * 64 - 1)).astype(np.int64)] = 1
    return prefix, np.packbits(bits).view(np.int64)


_KEYS = "doc_id {}, tk long, n long, f1 long, f2 long, p1 long, prefix array<long>, bits array<long>"


def _keys(docs: DataFrame, n: int, t: Fraction) -> DataFrame:
    """Each document's set size, fingerprint of the set, prefix and bitmap."""
    levels = docs.sparkSession.sparkContext.broadcast(frequency_levels(docs.select("text"), n))  # 1 MB, whatever the input

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(k, 256) for b in batches for k in range(0, b.num_rows, 256)):
            sizes, first, second, third, prefixes, bitmaps = [], [], [], [], [], []
            for text in batch.column(2):
                grams = shingles(text.as_py(), n)
                sizes.append(len(grams))
                with np.errstate(over="ignore"):
                    first.append(int(mix(grams).sum().view(np.int64)) if len(grams) else 0)
                    second.append(int(np.bitwise_xor.reduce(mix(~grams)).view(np.int64)) if len(grams) else 0)
                prefix, bits = _sketched(grams, levels.value, t) if len(grams) else (grams, np.zeros(0, np.int64))
                with np.errstate(over="ignore"):
                    third.append(int(mix(prefix).sum().view(np.int64)) if len(grams) else 0)
                prefixes.append(prefix.view(np.int64))
                bitmaps.append(bits)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(first, pa.int64()),
                    pa.array(second, pa.int64()), pa.array(third, pa.int64()), pa.array(prefixes, pa.list_(pa.int64())), pa.array(bitmaps, pa.list_(pa.int64())),
                ],
                names=["doc_id", "tk", "n", "f1", "f2", "p1", "prefix", "bits"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    keyed = docs.select("doc_id", "tk", "text").mapInArrow(key, _KEYS.format(kind))
    return written(keyed.withColumn("row", F.monotonically_increasing_id()), "jaccard-keys")


# ---- candidate pairs ------------------------------------------------------------------------------------------------


def _may_link(a: str, b: str, t: Fraction) -> Column:
    """Size and position bounds, and that the pair's prefixes don't already agree at the place before."""
    c = lambda side, name: F.col(f"{side}.{name}")
    small, large = F.least(c(a, "n"), c(b, "n")), F.greatest(c(a, "n"), c(b, "n"))
    rest = F.least(c(a, "n") - c(a, "pos"), c(b, "n") - c(b, "pos"))
    return (
        (small * t.denominator >= large * t.numerator)
        & (rest >= _need(c(a, "n"), c(b, "n"), t))
        & ~F.coalesce(c(a, "prev") == c(b, "prev"), F.lit(False))
    )


def _few_differences(a: Column, b: Column, n_a: Column, n_b: Column, t: Fraction) -> Column:
    """Sets differ in at least the places in which their bitmaps do; a bitmap twice as long is folded first."""
    def folded(bits: Column) -> Column:
        half = (F.size(bits) / 2).cast("int")
        return F.zip_with(F.slice(bits, 1, half), F.slice(bits, half + 1, half), lambda x, y: x.bitwiseOR(y))

    def differences(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda total, k: total + k)

    found = (
        F.when(F.size(a) == F.size(b), differences(a, b))
        .when(F.size(a) == 2 * F.size(b), differences(folded(a), b))
        .when(2 * F.size(a) == F.size(b), differences(a, folded(b)))
        .otherwise(0)  # sizes this different link at low thresholds only
    )
    return found <= n_a + n_b - 2 * _need(n_a, n_b, t)


def _postings(keys: DataFrame, classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (list, id, n, pos, prev, size) of all lists with two classes or more, and (id, n, group) of classes that share a group.

    A list is that of a prefix n-gram, in which a group stands under its smallest
    member, or that of a group's members; size is its number of classes.
    """
    groups = written(
        classes.groupBy("n", "p1").agg(F.min("id").alias("group"), F.count("*").alias("members")), "jaccard-groups"
    )
    several = written(groups.filter("members > 1"), "jaccard-shared")
    shared = written(classes.select("id", "n", "p1").join(several, ["n", "p1"]).select("id", "n", "group"), "jaccard-members")
    # prefixes of the groups' smallest members
    prefixes = written(
        keys.select(F.col("row").alias("group"), "prefix").join(groups.select("group", "n", "members"), "group"), "jaccard-prefixes"
    )
    counts = prefixes.select(F.explode("prefix").alias("list")).groupBy("list").agg(F.count("*").alias("rows")).filter("rows > 1")
    more = prefixes.filter("members > 1").select(F.explode("prefix").alias("list"), (F.col("members") - 1).alias("more"))
    counts = counts.join(more.groupBy("list").agg(F.sum("more").alias("more")), "list", "left")
    lists = written(counts.select("list", (F.col("rows") + F.coalesce("more", F.lit(0))).alias("size")), "jaccard-lists")
    bits = _marks(lists.withColumnRenamed("list", "tk"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Postings of n-grams that other groups may have too."""
        for batch in batches:
            prefix = batch.column("prefix")
            length = pc.list_value_length(prefix).to_numpy(zero_copy_only=False).astype(np.int64)
            grams = prefix.flatten().to_numpy()
            owner = np.repeat(np.arange(batch.num_rows), length)
            pos = np.arange(len(grams)) - np.repeat(np.cumsum(length) - length, length)
            keep = np.flatnonzero(_marked(grams, bits.value))
            before = pa.array(grams[np.maximum(keep - 1, 0)], mask=pos[keep] == 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(grams[keep]), batch.column("group").take(pa.array(owner[keep])), batch.column("n").take(pa.array(owner[keep])), pa.array(pos[keep]), before],
                names=["list", "id", "n", "pos", "prev"],
            )

    of_grams = prefixes.select("group", "n", "prefix").mapInArrow(rows, "list long, id long, n long, pos long, prev long")
    of_groups = shared.select(
        F.xxhash64("group", F.lit("group")).alias("list"), "id", "n", F.lit(0).cast("long").alias("pos"),
        F.lit(None).cast("long").alias("prev"),
    )
    lists = lists.unionByName(of_groups.groupBy("list").agg(F.count("*").alias("size")))
    postings = written(of_grams.unionByName(of_groups).join(lists, "list"), "jaccard-postings")
    discard(groups, several, prefixes)
    return postings, shared


def _short_pairs(postings: DataFrame, shared: DataFrame, t: Fraction) -> DataFrame:
    """All pairs of short lists that pass the bounds, expanded to members."""
    short = postings.filter(F.col("size") <= SHORT)
    pairs = short.alias("a").join(
        short.alias("b"), (F.col("a.list") == F.col("b.list")) & (F.col("a.id") < F.col("b.id")) & _may_link("a", "b", t)
    ).select(F.col("a.id").alias("a"), F.col("b.id").alias("b")).distinct()
    for side in ("a", "b"):
        members = shared.select(F.col("group").alias(side), F.col("id").alias("member"))
        pairs = pairs.join(members, side, "left").withColumn(side, F.coalesce("member", side)).drop("member")
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a != b")


def _leader_pairs(postings: DataFrame, t: Fraction) -> DataFrame:
    """In long lists, each row with a few leaders: those of the smallest hashes, so that many lists have the same ones."""
    long = postings.filter(F.col("size") > SHORT)
    leader = [F.min(F.struct(F.xxhash64("id", F.lit(k)).alias("h"), "id", "n", "pos", "prev")).alias(f"l{k}") for k in range(LEADERS)]
    leaders = long.groupBy("list").agg(*leader)
    leaders = written(leaders.select("list", F.explode(F.array(*(f"l{k}" for k in range(LEADERS)))).alias("l")).select("list", "l.*"), "jaccard-leaders")
    return long.alias("a").join(
        leaders.alias("b"), (F.col("a.list") == F.col("b.list")) & (F.col("a.id") != F.col("b.id")) & _may_link("a", "b", t)
    ).select(F.least("a.id", "b.id").alias("a"), F.greatest("a.id", "b.id").alias("b"))


def _block_pairs(
    postings: DataFrame, shared: DataFrame, nodes: DataFrame, labels: DataFrame, t: Fraction, nearest: bool
) -> DataFrame:
    """In long lists, pairs of different components that pass the bounds, found block against block.

    All of them, or with `nearest` for each class and block the one whose bitmap is nearest.
    """
    long = postings.filter(F.col("size") > SHORT)
    member = shared.select(F.col("group").alias("id"), F.col("id").alias("member"))
    long = long.join(member, "id", "left").withColumn("id", F.coalesce("member", "id")).drop("member")
    long = long.join(labels.select(F.col("node").alias("id"), "component"), "id", "left")
    long = written(long.withColumn("component", F.coalesce("component", "id")), "jaccard-long")
    found = _blocks(long, nodes)

    def pair(frame):
        """Pairs of asking rows with the others."""
        asks = frame["asks"].to_numpy()
        a, b = _block_matches(frame[asks], frame[~asks], t, nearest)
        return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return found.groupBy("list", "i", "j").applyInPandas(pair, "a long, b long")


def _blocks(long: DataFrame, nodes: DataFrame) -> DataFrame:
    """Rows of lists with several components, with the chunk i and block j in which they meet; `asks` tells the sides.

    Rows of a list's largest component need not meet each other. So only the rest asks, in
    chunks, and meets all rows, in blocks: copies of a row are as many as chunks of the rest,
    those of the rest as many as blocks. Two rows that both ask meet in the chunk of the lower number.
    """
    size = long.groupBy("list", "component").agg(F.count("*").alias("rows"))
    size = size.groupBy("list").agg(F.max(F.struct("rows", "component")).alias("most"), F.sum("rows").alias("all"))
    parts = lambda rows: F.ceil(rows / BLOCK).cast("int")
    open_lists = size.filter("all > most.rows").select(
        "list", F.col("most.component").alias("most"), parts(F.col("all") - F.col("most.rows")).alias("chunks"), parts(F.col("all")).alias("blocks")
    )
    rows = long.join(written(open_lists, "jaccard-open"), "list").join(nodes.select("id", "bits"), "id").withColumns({
        "rest": F.col("component") != F.col("most"),
        "block": F.pmod(F.xxhash64("id"), "blocks").cast("int"),
        "chunk": F.pmod(F.xxhash64("id", F.lit("chunk")), "chunks").cast("int"),
    })
    place = lambda asks, i, j: F.struct(F.lit(asks).alias("asks"), i.alias("i"), j.alias("j"))
    last = F.when(F.col("rest"), F.col("chunk")).otherwise(F.col("chunks") - 1)
    met = F.transform(F.sequence(F.lit(0), last), lambda i: place(False, i, F.col("block")))
    asked = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: place(True, F.col("chunk"), j))
    rows = rows.withColumn("place", F.explode(F.when(F.col("rest"), F.concat(met, asked)).otherwise(met)))
    once = F.col("rest") & (F.col("chunk") == F.col("place.i"))
    return rows.select("list", "place.*", "id", "n", "pos", F.coalesce("prev", "id").alias("prev"), "component", "bits", once.alias("once"))


def _fold(bits: np.ndarray, words: int) -> np.ndarray:
    """Bitmaps of a power-of-two length, in rows (also none), folded to `words`."""
    return np.bitwise_or.reduce(bits.reshape(len(bits), bits.shape[1] // words, words), axis=1)


def _block_matches(left, right, t: Fraction, nearest: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of ids; rows marked `once` stand on both sides and are taken from the side of the smaller id."""
    get = lambda f, c: f[c].to_numpy()
    if not len(left) or not len(right):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    width = np.array([len(b) for b in right["bits"]])
    n, ids, component, prev, pos, once = (get(right, c) for c in ("n", "id", "component", "prev", "pos", "once"))
    maps = {w: np.stack(right["bits"][width == w].to_list()).view(np.uint64) for w in np.unique(width).tolist()}
    place = np.zeros(len(right), dtype=np.int64)
    for w in maps:
        place[width == w] = np.arange((width == w).sum())
    found_a, found_b = [], []
    for row in left.itertuples():
        need = -(-(n + row.n) * t.numerator // (t.numerator + t.denominator))
        ok = np.minimum(n, row.n) * t.denominator >= np.maximum(n, row.n) * t.numerator
        ok &= (component != row.component) & (prev != row.prev)
        ok &= np.minimum(n - pos, row.n - row.pos) >= need
        if not nearest:
            ok &= ~once | (ids > row.id)
        if not ok.any():
            continue
        own, best = np.asarray(row.bits).view(np.uint64)[None, :], None
        for w, bits in maps.items():
            at = np.flatnonzero(ok & (width == w))
            words = min(w, own.shape[1])
            differ = np.bitwise_count(_fold(bits[place[at]], words) ^ _fold(own, words)).sum(axis=1)
            near = differ <= (n + row.n - 2 * need)[at]
            at, differ = at[near], differ[near]
            if nearest:
                least = min(zip(differ.tolist(), ids[at].tolist()), default=None)
                best = least if best is None or (least is not None and least < best) else best
            else:
                found_a.append(np.full(len(at), row.id))
                found_b.append(ids[at])
        if best is not None:
            found_a.append(np.array([row.id]))
            found_b.append(np.array([best[1]]))
    if not found_a:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found_a), np.concatenate(found_b)


# ---- verification ---------------------------------------------------------------------------------------------------


def _sets(docs: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """(tk, grams) of the texts whose keys are in `wanted`, a written table of different ones.

    A filter of fixed size lets tasks skip most other texts before any shuffle.
    """
    bits = _marks(wanted)

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = set()
        for batch in batches:
            keys, fresh = batch.column(0).to_numpy(), []
            for k in np.flatnonzero(_marked(keys, bits.value)).tolist():
                if keys[k] not in done:  # copies have one set
                    done.add(keys[k])
                    fresh.append(k)
            texts = batch.column(1)
            sets = [shingles(texts[k].as_py(), n).tobytes() for k in fresh]
            yield pa.RecordBatch.from_arrays([pa.array(keys[fresh], pa.int64()), pa.array(sets, pa.binary())], names=["tk", "grams"])

    found = docs.filter("text is not null").select("tk", "text").mapInArrow(grams, "tk long, grams binary")
    return written(found.join(wanted, "tk", "left_semi").dropDuplicates(["tk"]), "jaccard-sets")


def _verified(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, n: int, t: Fraction) -> DataFrame:
    """The pairs (a, b) of classes that reach the similarity; bitmaps rule most others out first."""
    x = nodes.select(F.col("id").alias("a"), F.col("tk").alias("tk_a"), F.col("n").alias("n_a"), F.col("bits").alias("bits_a"))
    y = nodes.select(F.col("id").alias("b"), F.col("tk").alias("tk_b"), F.col("n").alias("n_b"), F.col("bits").alias("bits_b"))
    likely = pairs.join(x, "a").join(y, "b").filter(
        _few_differences(F.col("bits_a"), F.col("bits_b"), F.col("n_a"), F.col("n_b"), t)
    )
    likely = written(likely.select("a", "b", "tk_a", "tk_b"), "jaccard-likely")
    wanted = likely.select(F.col("tk_a").alias("tk")).union(likely.select(F.col("tk_b").alias("tk"))).distinct()
    sets = _sets(docs, written(wanted, "jaccard-wanted"), n)
    joined = (
        likely.join(sets.select(F.col("tk").alias("tk_a"), F.col("grams").alias("set_a")), "tk_a")
        .join(sets.select(F.col("tk").alias("tk_b"), F.col("grams").alias("set_b")), "tk_b")
        .select("a", "b", "set_a", "set_b")
    )

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for k in range(batch.num_rows):
                a, b = (np.frombuffer(batch.column(c)[k].as_py(), dtype=np.uint64) for c in (2, 3))
                both = np.sort(np.concatenate([a, b]))
                common = int((both[1:] == both[:-1]).sum())
                keep.append(common * t.denominator >= t.numerator * (len(both) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    links = written(joined.mapInArrow(verify, "a long, b long"), "jaccard-verified")
    discard(sets, likely)
    return links


def _link_counts(keys: DataFrame, classes: DataFrame, links: DataFrame) -> DataFrame:
    """(id, links) of every class: how many other rows each of its rows is linked with, its copies among them."""
    rows = keys.filter("n > 0").groupBy("f1", "f2", "n").agg(F.count("*").alias("rows"))
    rows = written(classes.select("id", "f1", "f2", "n").join(rows, ["f1", "f2", "n"]).select("id", "rows"), "jaccard-rows")
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    others = both.join(rows.withColumnRenamed("id", "b"), "b").groupBy("a").agg(F.sum("rows").alias("others"))
    counted = rows.join(others.withColumnRenamed("a", "id"), "id", "left")
    return counted.select("id", (F.col("rows") - 1 + F.coalesce("others", F.lit(0))).alias("links"))


def _labelled(docs: DataFrame, n: int, threshold: Fraction, count: bool = False) -> DataFrame:
    """doc_id, tk (a hash of the text), n and component (a number; null without n-grams) of every (doc_id, text) row.

    With `count` also links, the number of other rows that the row is linked with.
    """
    docs = docs.withColumn("tk", F.xxhash64("text"))
    keys = _keys(docs, n, threshold)
    classes = written(
        keys.filter("n > 0").groupBy("f1", "f2", "n").agg(
            F.min_by(F.struct("tk", "p1", "bits"), "row").alias("first"), F.min("row").alias("id")
        ).select("id", "f1", "f2", "n", "first.*"),
        "jaccard-classes",
    )
    nodes = classes.select("id", "tk", "n", "bits")
    postings, shared = _postings(keys, classes)
    candidates = _short_pairs(postings, shared, threshold).union(_leader_pairs(postings, threshold)).distinct()
    links = _verified(candidates, docs, nodes, n, threshold)
    labels = written(components(links), "jaccard-labels")
    # what is left in long lists: first each class with its nearest of another component, which joins most
    # components with few pairs, and in the end every pair of components still apart
    for nearest in (True, True, False):
        more = written(_block_pairs(postings, shared, nodes, labels, threshold, nearest).distinct(), "jaccard-blocks")
        if more.isEmpty():
            break
        links = links.union(_verified(more, docs, nodes, n, threshold))
        labels = written(components(links), "jaccard-labels")
    named = classes.select("id", "f1", "f2", "n").join(labels.withColumnRenamed("node", "id"), "id", "left")
    more = []
    if count:
        # without labels each class is a component of its own, so that the blocks give all pairs of long lists
        rest = _block_pairs(postings, shared, nodes, labels.limit(0), threshold, False).distinct()
        rest = written(rest.join(links, ["a", "b"], "left_anti"), "jaccard-blocks")
        links = links.union(_verified(rest, docs, nodes, n, threshold)).distinct()
        named, more = named.join(_link_counts(keys, classes, links), "id"), ["links"]
    named = written(named.select("f1", "f2", "n", F.coalesce("component", "id").alias("component"), *more), "jaccard-named")
    found = written(
        keys.select("doc_id", "tk", "n", "f1", "f2").join(named, ["f1", "f2", "n"], "left").select("doc_id", "tk", "n", "component", *more),
        "jaccard-labelled",
    )
    discard(keys, classes, postings, named)
    return found


def jaccard_components(
    docs: DataFrame, n: int = 5, threshold: Fraction = Fraction(4, 5), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_shingles and component_id of every row.

    Texts are lower-cased (A-Z) and cut into words; a document's set holds its
    word n-grams, or all its words as one if they are fewer. Rows whose sets reach the
    Jaccard threshold are linked; component_id is the smallest id reachable. A row
    without words (a null or empty text) has no n-grams and is linked with
    nothing. Repeated ids are rows of their own; a component of null ids has a null
    component_id. N-grams are compared by 64-bit hashes. Only the two named columns are read.
    """
    return _components(docs, n, threshold, id_col, text_col, False)


def jaccard_links(
    docs: DataFrame, n: int = 5, threshold: Fraction = Fraction(4, 5), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_shingles, component_id and n_links of every row, as `jaccard_components` has them.

    n_links is the number of other rows that reach the threshold with this one, equal
    ones among them; the sum over all rows is twice the number of links. Verified pairs
    of different sets are listed, so work grows with the links of a group of near copies.
    """
    return _components(docs, n, threshold, id_col, text_col, True)


def _components(docs: DataFrame, n: int, threshold: Fraction, id_col: str, text_col: str, count: bool) -> DataFrame:
    ship(docs.sparkSession)
    found = _labelled(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text")), n, threshold, count)
    # a second grouping column leaves the join its own exchange, so that a component's many rows can be split
    least = found.filter("n > 0").groupBy("component", F.xxhash64("component")).agg(F.min("doc_id").alias("component_id"))
    found = found.join(least.select("component", "component_id"), "component", "left")
    links = [F.coalesce("links", F.lit(0)).alias("n_links")] if count else []
    return found.select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), *links
    )


def keep_first(
    docs: DataFrame, n: int = 5, threshold: Fraction = Fraction(4, 5), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """docs with one row of each component: that with the smallest id (null first), of equal ids one text.

    Rows without words all stay. Texts are not shuffled: a filter of fixed size
    separates the rows that may go, and only those meet the list of keys that do.
    """
    ship(docs.sparkSession)
    key = [F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text")]
    found = _labelled(docs.select(*key), n, threshold).filter("n > 0")
    first = found.groupBy("component", F.xxhash64("component")).agg(F.min(F.struct("doc_id", "tk")).alias("first"))
    stays = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("tk") == F.col("first.tk"))
    judged = found.join(first.select("component", "first"), "component").withColumn("stays", stays)
    # rows to drop, and keys that stay but stand in several rows
    keys = judged.groupBy("doc_id", "tk", "stays").agg(F.count("*").alias("rows")).filter("not stays or rows > 1")
    keys = written(keys.select(F.xxhash64("doc_id", "tk").alias("tk"), "stays"), "jaccard-drop")
    bits = _marks(keys)

    @F.pandas_udf("boolean")
    def listed(hashes: pd.Series) -> pd.Series:
        return pd.Series(_marked(hashes.to_numpy(), bits.value))

    names = docs.columns
    docs = docs.withColumns({"_key": F.xxhash64(F.col(id_col), F.xxhash64(F.col(text_col).cast("binary"))), "_row": F.monotonically_increasing_id()})
    suspect = docs.filter(listed(F.col("_key"))).join(keys.withColumnRenamed("tk", "_key"), "_key", "left")
    # of rows that stay under one key one is taken; those that the filter caught by chance all stay
    suspect = suspect.filter("stays is null or stays").withColumn("_copy", F.when(F.col("stays"), 0).otherwise(F.col("_row")))
    return docs.filter(~listed(F.col("_key"))).select(*names).unionByName(suspect.dropDuplicates(["_key", "_copy"]).select(*names))


def _marks(wanted: DataFrame) -> Broadcast:
    """A filter of fixed size that holds all 64-bit keys `tk` of `wanted`."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << FILTER_BITS, dtype=bool)
        for batch in batches:
            keys = mix(batch.column(0).to_numpy().view(np.uint64))
            bits[(keys >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
        yield chunked(np.packbits(bits))

    marks = gathered(wanted.select("tk").mapInArrow(mark, "chunk int, data binary"), "or")
    marks = marks if len(marks) else np.zeros((1 << FILTER_BITS) // 8, dtype=np.uint8)
    return wanted.sparkSession.sparkContext.broadcast(marks)  # 1 MB, whatever the input


def _marked(keys: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """True for all keys that the filter holds, and for few others."""
    at = mix(keys.view(np.uint64)) >> np.uint64(64 - FILTER_BITS)
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (7 - (at & np.uint64(7))).astype(np.uint8)) & 1 > 0
