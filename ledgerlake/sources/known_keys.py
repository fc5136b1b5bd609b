"""The keys of a hub that were ever seen, with their first day: merged day by day, never copied.

Each day adds a folder with its new keys and one with bitmaps of them. Together the bitmaps are a Bloom filter of fixed size:
a key whose bit is not set was never seen, so only perhaps known keys meet the stored ones. A key's first day
is the least of those stored for it, so days may be absent, come late or be written again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.sources.snapshots import SnapshotLog

#: Bits of one bitmap, as Spark's bitmap functions have them.
BITMAP = 8 * 4096
KEPT = ("load_date", "record_source")


class KnownKeys:
    """First-seen days of ``key`` below ``root``. The filter has ``bitmaps`` times 4 KB: about 16 bits a key are enough."""

    def __init__(self, spark: SparkSession, root: str, key: str, bitmaps: int = 1024):
        self.spark, self.key, self.bitmaps = spark, key, bitmaps
        self.log = SnapshotLog(spark, root)

    def _bit(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.bitmaps * BITMAP))

    def days(self) -> list[str]:
        return sorted(name.removeprefix("keys/") for name in self.log.state() if name.startswith("keys/"))

    def _read(self, kind: str, schema: str, without: str | None) -> DataFrame:
        folders = [f for name, f in self.log.state().items() if name.startswith(kind) and name != f"{kind}{without}"]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*self.log.located(folders))

    def known(self, without: str | None = None) -> DataFrame:
        """Key, first day and its source of every key; ``without`` leaves out what one day has added."""
        rows = self._read("keys/", f"{self.key} string, load_date date, record_source string", without)
        return rows.groupBy(self.key).agg(F.min(F.struct(*KEPT)).alias("first")).select(self.key, "first")

    def _with_first(self, rows: DataFrame, dt: str | None) -> DataFrame:
        """rows with ``first``, the stored first day and source of their key; null for keys never seen on other days."""
        marks = self._read("marks/", "bitmap long, bits binary", dt).groupBy("bitmap").agg(F.bitmap_or_agg("bits").alias("bits"))
        bit = F.col("_bit")
        byte = F.conv(F.hex(F.substring("bits", F.floor(bit % BITMAP / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        seen = F.coalesce(F.call_function("shiftright", byte, (bit % 8).cast("int")).bitwiseAND(1) == 1, F.lit(False))
        # at most `bitmaps` rows of 4 KB, whatever the number of keys
        marked = rows.withColumn("_bit", self._bit()).withColumn("bitmap", F.floor(F.col("_bit") / BITMAP))
        marked = marked.join(F.broadcast(marks), "bitmap", "left").withColumn("_seen", seen).drop("_bit", "bitmap", "bits")
        perhaps = marked.where("_seen").join(self.known(dt), self.key, "left")
        never = marked.where("not _seen").withColumn("first", F.lit(None).cast(perhaps.schema["first"].dataType))
        return perhaps.unionByName(never).drop("_seen")

    def first_seen(self, today: DataFrame, dt: str) -> DataFrame:
        """Hub rows of day ``dt`` with the day and source with which their keys were first seen, on this or any other day."""
        own, stored = F.struct(*KEPT), F.col("first")
        first = F.when(stored.isNull() | (own < stored), own).otherwise(stored)
        joined = self._with_first(today, dt).withColumn("first", first)
        return joined.select(*[F.col(f"first.{c}").alias(c) if c in KEPT else F.col(c) for c in today.columns])

    def add(self, rows: DataFrame, dt: str) -> None:
        """Stores the hub rows of day ``dt`` whose keys are new, or were first seen later; replaces what the day has stored before."""
        new = self._with_first(rows, dt).where(F.col("first").isNull() | (F.col("load_date") < F.col("first.load_date")))
        keys, marks = self.log.fresh(), self.log.fresh()
        new.select(self.key, *KEPT).write.parquet(f"{self.log.root}/{keys}")
        stored = self.spark.read.schema(f"{self.key} string").parquet(f"{self.log.root}/{keys}").withColumn("_bit", self._bit())
        bits = stored.groupBy(F.floor(F.col("_bit") / BITMAP).alias("bitmap")).agg(
            F.bitmap_construct_agg(F.col("_bit") % BITMAP).alias("bits")
        )
        bits.write.parquet(f"{self.log.root}/{marks}")
        self.log.commit(lambda now: {f"keys/{dt}": keys, f"marks/{dt}": marks})
