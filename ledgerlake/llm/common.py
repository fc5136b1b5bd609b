"""Helpers shared by the operators: hand-over tables, ranks without one big task, word and shingle hashes."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.session import scratch_dir

#: Tasks that the rows of one group are dealt to while they are numbered.
RANK_PIECES = 64

#: White space that separates words: space and 0x09 to 0x0D.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def put(spark: SparkSession, label: str, name: str, data: bytes) -> str:
    """Writes a small file to the shared folder; its full path."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_dir(spark, label), name)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    out = files.create(path)
    out.write(bytearray(data))
    out.close()
    return files.makeQualified(path).toString()


_SHIPPED: set[str] = set()


#: Rows and bytes that a Python worker is handed at once; a row may hold a whole text or set.
BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20
_BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH_ROWS), "spark.sql.execution.arrow.maxBytesPerBatch": str(BATCH_BYTES)}


def ship(spark: SparkSession) -> None:
    """Hands this package to the executors' Python workers, once in an application, and bounds their batches.

    The limits are the session's from then on: a plan made here runs when its caller asks for rows.
    """
    for name, value in _BATCH.items():
        spark.conf.set(name, value)
    application = spark.sparkContext.applicationId
    if application in _SHIPPED:
        return
    root, data = Path(__file__).resolve().parents[1], io.BytesIO()
    with zipfile.ZipFile(data, "w") as archive:
        for file in sorted(root.rglob("*.py")):
            archive.write(file, file.relative_to(root.parent))
    spark.sparkContext.addPyFile(put(spark, "package", "ledgerlake.zip", data.getvalue()))
    _SHIPPED.add(application)


def written(df: DataFrame, label: str) -> DataFrame:
    """df as a table in the shared folder: computed once, and safe from lost executors."""
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.written_at = path
    return table


def discard(*tables: DataFrame) -> None:
    """Removes tables of `written` that nothing reads any more."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table.written_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def rank_in_group(df: DataFrame, keys: list[str], row: str, name: str, pieces: int = RANK_PIECES) -> DataFrame:
    """df with `name`: a gapless number from 0 within each group of `keys`, in no particular order.

    `row` tells rows apart and `df` must be a written table. A group's rows are
    dealt to `pieces` tasks, numbered there, and moved up by the rows of the
    pieces before, so no task sees a whole group.
    """
    piece = "_piece"
    df = df.withColumn(piece, F.pmod(F.xxhash64(row), F.lit(pieces)))
    before = Window.partitionBy(*keys).orderBy(piece).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        df.groupBy(*keys, piece).agg(F.count("*").alias("_n"))
        .withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .drop("_n")
    )
    numbered = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys, piece).orderBy(row)) - 1)
    return (
        numbered.join(starts, [*keys, piece])
        .withColumn(name, F.col(name).cast("long") + F.col("_start"))
        .drop(piece, "_start")
    )


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


# ---- arrays of fixed size, gathered from all tasks ----------------------------------------------------------------

#: Rows that an array is cut into while it is added up.
CHUNKS = 64


def chunked(array: np.ndarray) -> pa.RecordBatch:
    """An array as CHUNKS rows (chunk, data)."""
    return _chunk_rows(dict(enumerate(np.array_split(array, CHUNKS))))


def gathered(parts: DataFrame, combine: str) -> np.ndarray:
    """The sum or the union of arrays that tasks emit as (chunk, data) rows, by way of several tasks for each chunk."""
    ship(parts.sparkSession)
    add = np.add if combine == "add" else np.bitwise_or
    kind = np.int64 if combine == "add" else np.uint8

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, data in zip(batch.column("chunk").to_pylist(), batch.column("data")):
                values = np.frombuffer(data.as_py(), dtype=kind)
                sums[chunk] = add(sums[chunk], values) if chunk in sums else values
        yield _chunk_rows(sums)

    salted = parts.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(16)))
    some = salted.repartition("chunk", "salt").select("chunk", "data").mapInArrow(total, "chunk int, data binary")
    rows = some.repartition("chunk").mapInArrow(total, "chunk int, data binary").collect()  # CHUNKS rows
    return np.concatenate([np.frombuffer(r["data"], dtype=kind) for r in sorted(rows)]) if rows else np.zeros(0, kind)


def _chunk_rows(chunks: dict[int, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(chunks), pa.int32()), pa.array([c.tobytes() for c in chunks.values()], pa.binary())], names=["chunk", "data"]
    )


# ---- vectorised hashes of words -------------------------------------------------------------------------------

_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers."""
    x = x ^ (x >> np.uint64(30))
    x = x * _MIX1
    x ^= x >> np.uint64(27)
    x *= _MIX2
    x ^= x >> np.uint64(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_ODD = np.uint64(0xD1342543DE82EF95)  # odd, so it has an inverse modulo 2**64
_ODD_INVERSE = np.uint64(pow(int(_ODD), -1, 1 << 64))
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _powers(base: np.uint64, n: int) -> np.ndarray:
    """base ** 0 ... base ** (n - 1), modulo 2**64."""
    out = np.full(max(n, 1), base, dtype=np.uint64)
    out[0] = 1
    np.multiply.accumulate(out, out=out)
    return out[:n]


#: Bytes of a text that are hashed at a time; the tables of powers have as many places, however long a text is.
SLICE = 1 << 16


class Words:
    """The words of a UTF-8 text: where each begins and ends, and a 64-bit hash of each.

    A word's hash is a sum over its bytes, weighted by their place, so it is the
    difference of two running totals. Totals are made slice by slice, with the last one
    and the power of the first place carried over.
    """

    _up = _powers(_ODD, SLICE)
    _down = _powers(_ODD_INVERSE, SLICE)

    def __init__(self, text: bytes, lower: bool = False):
        data = np.frombuffer(text, dtype=np.uint8)
        if lower:
            data = _LOWER[data]
        self.data = data
        edge = np.zeros(len(data) + 2, dtype=np.int8)
        np.logical_not(SPACE[data], out=edge[1:-1].view(bool))
        change = np.flatnonzero(np.diff(edge))
        self.begin, self.end = change[::2], change[1::2]
        self.hash = mix(self._weighted())

    def _weighted(self) -> np.ndarray:
        out = np.empty(len(self.begin), dtype=np.uint64)
        carried, up, down = np.uint64(0), np.uint64(1), np.uint64(1)
        step_up, step_down = np.uint64(pow(int(_ODD), SLICE, 1 << 64)), np.uint64(pow(int(_ODD_INVERSE), SLICE, 1 << 64))
        started = np.zeros(len(self.begin), dtype=np.uint64)
        with np.errstate(over="ignore"):
            for at in range(0, len(self.data), SLICE):
                part = self.data[at : at + SLICE]
                total = np.empty(len(part) + 1, dtype=np.uint64)
                total[0] = 0
                np.cumsum(_BYTE[part] * Words._up[: len(part)], out=total[1:])
                total = total * up + carried
                # a begin lies before its slice's bytes, an end behind them
                i, j = np.searchsorted(self.begin, [at, at + len(part)])
                started[i:j] = total[self.begin[i:j] - at]
                out[i:j] = Words._down[self.begin[i:j] - at] * down
                i, j = np.searchsorted(self.end, [at + 1, at + len(part) + 1])
                out[i:j] *= total[self.end[i:j] - at] - started[i:j]
                carried, up, down = total[-1], up * step_up, down * step_down
        return out

    def __len__(self) -> int:
        return len(self.begin)

    def windows(self, n: int) -> np.ndarray:
        """A hash of each run of n words."""
        h = self.hash
        if len(h) < n:
            return h[:0]
        out = h[: len(h) - n + 1].copy()
        for k in range(1, n):
            out *= _ODD
            out += h[k : len(h) - n + 1 + k]
        return mix(out)

    def whole(self) -> np.ndarray:
        """One hash of all words together."""
        with np.errstate(over="ignore"):
            return mix(np.array([(self.hash * _powers(_ODD, len(self.hash))).sum() + np.uint64(len(self.hash))]))
