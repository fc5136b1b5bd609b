"""A table that change feeds are merged into when it is read.

A base and the deltas of batches lie in folders of their own, each row with the version it comes from: commit time,
message number and place in the message. A delete is a row too. A key's row is that of its greatest version, wherever it
lies, so neither the order in which batches arrive, nor how a feed is cut into batches, nor a batch that comes twice
changes what is read. Compaction makes base and deltas a new base and keeps versions and deletes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.sources.snapshots import Edits, SnapshotLog

#: Where a change stands in its feed; a row of the first base stands before all changes.
VERSION = ("es", "batch", "pos")
_STORED = T.StructType([
    *(T.StructField(f"_{name}", T.LongType()) for name in VERSION), T.StructField("_gone", T.BooleanType())
])


class ChangeTable:
    """Rows by ``key`` below ``root``, with the columns of ``schema``."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, key: str = "trans_id", fmt: str = "parquet"):
        self.spark, self.schema, self.key, self.fmt = spark, schema, key, fmt
        self.log = SnapshotLog(spark, root)

    # --- writing ---

    def _store(self, rows: DataFrame) -> str:
        folder = self.log.fresh()
        rows.write.format(self.fmt).save(f"{self.log.root}/{folder}")
        return folder

    def load(self, base: DataFrame) -> None:
        """Takes ``base`` as it is for the rows before all changes; a base loaded earlier is replaced, deltas stay.

        Rows that share a key are all kept until a change comes for it, and so are rows without a key.
        """
        first = [F.lit(None).cast("long").alias(f"_{name}") for name in VERSION]
        folder = self._store(self._conformed(base).select("*", *first, F.lit(False).alias("_gone")))
        self.log.commit(lambda now: {"base": folder})

    def apply(self, changes: DataFrame, batch: str) -> None:
        """Adds one batch of changes: rows with ``op``, the columns of VERSION, and the table's columns that they carry.

        Only the newest change of a key is kept. A batch of the same name replaces the
        earlier one, which makes a retry harmless. Changes without a key are skipped.
        """
        stored = self._conformed(changes.where(F.col(self.key).isNotNull()), [
            *(F.col(name).cast("long").alias(f"_{name}") for name in VERSION),
            F.coalesce(F.col("op") == "DELETE", F.lit(False)).alias("_gone"),
        ])
        folder = self._store(_newest(stored, self.key))
        self.log.commit(lambda now: {f"delta/{batch}": folder})

    def _conformed(self, rows: DataFrame, more: Sequence[Column] = ()) -> DataFrame:
        """The table's columns in its types, null where ``rows`` has none, and ``more``."""
        cells = [
            (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in self.schema
        ]
        return rows.select(*cells, *more)

    # --- reading ---

    def has_base(self) -> bool:
        return "base" in self.log.state()

    def batches(self) -> list[str]:
        """Names of the batches that wait for compaction."""
        return sorted(name.removeprefix("delta/") for name in self.log.state() if name.startswith("delta/"))

    def read(self, version: int | None = None) -> DataFrame:
        """The rows as of the newest manifest, or the numbered one."""
        return self._merged(self.log.state(version)).where(~F.col("_gone")).select(*self.schema.names)

    def _folders(self, folders: list[str]) -> DataFrame:
        schema = T.StructType([*self.schema.fields, *_STORED.fields])
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.format(self.fmt).schema(schema).load(self.log.located(folders))

    def _merged(self, state: dict[str, str]) -> DataFrame:
        """Base and deltas with one version of each changed key, deletes among them.

        The base is not shuffled while the deltas are small: it meets the newest deltas
        twice, its keys alone to find the version that a delta must beat, and its rows to drop those that
        were beaten.
        """
        base = self._folders([state["base"]] if "base" in state else [])
        deltas = self._folders([folder for name, folder in state.items() if name.startswith("delta/")])
        newest = _newest(deltas, self.key)
        place = F.struct(*(f"_{name}" for name in VERSION))
        asked = newest.select(self.key, place.alias("_delta"))
        # rows of the first base have no version, and any change beats them; semi and anti joins keep the deltas' size known
        held = base.where("_es is not null").select(self.key, place.alias("_base"))
        lost = held.join(asked, self.key).where("_base > _delta").select(self.key)
        won = asked.select(self.key).join(lost, self.key, "left_anti")
        fresh = newest.join(won, self.key, "left_semi").select(*base.columns)
        return base.join(won, self.key, "left_anti").select(*base.columns).unionByName(fresh)

    # --- upkeep ---

    def compact(self, forget_before: int | None = None) -> None:
        """Makes base and deltas a new base, with their versions.

        Deletes stay, so that an older change which comes late still loses against
        them; those committed before ``forget_before`` (milliseconds, like ``es``) go, for
        feeds that are known to be no later. Batches that come in meanwhile stay deltas.
        """
        state = self.log.state()
        if not any(name.startswith("delta/") for name in state):
            return
        rows = self._merged(state)
        if forget_before is not None:
            rows = rows.where(~F.col("_gone") | (F.col("_es") >= forget_before))
        folder = self._store(rows)

        def edit(now: dict[str, str]) -> Edits:
            if now.get("base") != state.get("base"):
                return {}  # another base since: this one is of no use
            done = {name: None for name, old in state.items() if name.startswith("delta/") and now.get(name) == old}
            return {"base": folder, **done}

        self.log.commit(edit)

    def vacuum(self, keep: int = 2, older_than: float = 86_400.0) -> int:
        """Removes folders that no kept manifest names; see ``SnapshotLog.vacuum``."""
        return self.log.vacuum("data/s-*", keep, older_than)


def _newest(stored: DataFrame, key: str) -> DataFrame:
    """One row for each key: that of the greatest version, of equal ones the greatest row. Reduced before the shuffle."""
    version = [f"_{name}" for name in VERSION]
    rest = [c for c in stored.columns if c not in (key, *version)]
    best = F.max(F.struct(*version, *rest)).alias("best")
    return stored.groupBy(key).agg(best).select(*[c if c == key else F.col("best")[c].alias(c) for c in stored.columns])
