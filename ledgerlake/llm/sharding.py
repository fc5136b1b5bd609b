"""Longest-processing-time sharding: groups that stay together, largest first, each to the least-loaded shard.

Groups of one size are interchangeable, so the assignment needs only how many groups of each size there are. That
histogram is small: D different sizes take at least D * (D + 1) / 2 bytes, so D < sqrt(2 * total bytes). The heap
runs over it on the driver and says which run of each size goes where; the groups themselves are numbered within
their size and looked up, in parallel.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import rank_in_group, written

_HEAP_RUN = 64


def _threshold(loads: np.ndarray, size: int, count: int) -> np.ndarray:
    """How many of `count` equal groups each shard gets, but for the last few, which are left over.

    A shard's load before each of its next groups is load, load + size, ...; the
    heap hands out the smallest `count` of all these.
    """
    low, high = int(loads.min()), int(loads.min()) + size * (count + 1)
    taken = lambda top: np.maximum(0, -((loads - top) // size))  # noqa: E731  groups that start below top
    while high - low > 1:
        middle = (low + high) // 2
        if int(taken(middle).sum()) <= count:
            low = middle
        else:
            high = middle
    return taken(low)


def lpt_plan(sizes: list[tuple[int, int]], n_shards: int) -> list[tuple[int, list[int], list[int]]]:
    """For (size, groups of it) rows: size, shards, and where each shard's run of the numbered groups ends."""
    heap = [(0, k) for k in range(n_shards)]
    plan = []
    for size, count in sorted(sizes, reverse=True):
        runs: list[list[int]] = []
        if size <= 0:  # weightless groups are dealt evenly
            share = [count // n_shards + (k < count % n_shards) for k in range(n_shards)]
            runs = [[k, n] for k, n in enumerate(share) if n]
            count = 0
        elif count > _HEAP_RUN:
            loads = np.zeros(n_shards, dtype=np.int64)
            for load, k in heap:
                loads[k] = load
            bulk = _threshold(loads, size, count)
            runs = [[k, int(n)] for k, n in enumerate(bulk) if n]
            count -= int(bulk.sum())
            heap = [(int(load), k) for k, load in enumerate(loads + bulk * size)]
            heapq.heapify(heap)
        for _ in range(count):
            load, k = heap[0]
            heapq.heapreplace(heap, (load + size, k))
            runs.append([k, 1])
        ends, total = [], 0
        for _, n in runs:
            total += n
            ends.append(total)
        plan.append((size, [k for k, _ in runs], ends))
    return plan


def lpt_shards(groups: DataFrame, n_shards: int, key: str = "key", size: str = "size") -> DataFrame:
    """(key, size, shard) for a written table of groups with different keys.

    An empty table gives an empty result. A null size counts as 0; groups of
    size 0 or less are dealt evenly. Ties go to the shard with the smaller number.
    """
    if n_shards < 1:
        raise ValueError("at least one shard is needed")
    groups = groups.select(F.col(key).alias(key), F.coalesce(F.col(size).cast("long"), F.lit(0)).alias(size))
    histogram = groups.groupBy(size).agg(F.count("*").alias("n")).toArrow()
    sizes = list(zip(histogram[size].to_pylist(), histogram["n"].to_pylist()))
    plan = lpt_plan(sizes, n_shards)
    columns = list(zip(*plan)) or [(), (), ()]
    arrow = pa.table({
        size: pa.array(columns[0], pa.int64()),
        "_shards": pa.array(columns[1], pa.list_(pa.int32())),
        "_ends": pa.array(columns[2], pa.list_(pa.int64())),
    })
    placed = groups.sparkSession.createDataFrame(arrow)
    run = F.size(F.filter("_ends", lambda end: end <= F.col("_index")))
    return (
        rank_in_group(groups, [size], key, "_index")
        .join(placed, size)
        .select(key, size, F.get("_shards", run).alias("shard"))
    )


def shard_documents(
    docs: DataFrame, n_shards: int, id_col: str = "doc_id", text_col: str = "text", overhead: int = 16
) -> DataFrame:
    """Every document's shard: equal texts stay together, shards get near equal bytes.

    Columns: doc_id, size (UTF-8 bytes of the text plus `overhead`), text_crc32,
    shard, slot (gapless from 0 in its shard). Documents without text form one
    group of size `overhead` each, apart from empty texts. Repeated rows and
    repeated or null ids are rows like others. No other column is read.
    """
    text = F.col(text_col)
    rows = written(
        docs.select(
            F.col(id_col).alias("doc_id"),
            (F.coalesce(F.octet_length(text), F.lit(0)) + overhead).cast("long").alias("size"),
            F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
            F.coalesce(F.md5(text.cast("binary")), F.lit("none")).alias("key"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "shard-rows",
    )
    groups = written(rows.groupBy("key").agg(F.sum("size").alias("size")), "shard-groups")
    shards = written(lpt_shards(groups, n_shards).select("key", "shard"), "shard-plan")
    placed = written(rows.join(shards, "key").drop("key"), "shard-placed")
    return rank_in_group(placed, ["shard"], "row", "slot").drop("row")
