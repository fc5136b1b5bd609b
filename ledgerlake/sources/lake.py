"""Day-partitioned tables: by path, and as catalog tables for SQL users."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.schemas import TABLES, Table
from ledgerlake.session import settings
from ledgerlake.sources.snapshots import SnapshotLog


# Parquet days hold times as one long each; Spark's older 12-byte form takes longer to write and has no statistics.
WRITE_CONF = {"spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS"}


def checked_day(dt: str) -> str:
    if date.fromisoformat(dt).isoformat() != dt:
        raise ValueError(f"day must be yyyy-MM-dd: {dt!r}")
    return dt


def conform(df: DataFrame, table: Table) -> DataFrame:
    """The table's columns, by name and in its types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in table.schema])


class Lake:
    """Tables below one root folder. A table's log names the folder that holds each day."""

    def __init__(self, spark: SparkSession, root: str, fmt: str = "orc"):
        self.spark = spark
        self.root = root.rstrip("/")
        self.fmt = fmt

    def path(self, name: str) -> str:
        table = TABLES[name]
        return f"{self.root}/{table.database}/{table.physical}"

    def log(self, name: str) -> SnapshotLog:
        return SnapshotLog(self.spark, self.path(name))

    def write_day(self, name: str, df: DataFrame, dt: str) -> None:
        """Replace exactly one day, also by nothing; other days stay as they are.

        The new rows go to a folder of their own, and the day is theirs when the
        log says so: a reader has the old day or the new one, and a failed write
        leaves the day as it was. The old folder stays for readers at work until ``vacuum``.
        No shuffle of its own: a projection keeps the scan's splits, and what
        comes from a shuffle has the partition sizes that adaptive execution gave it.
        """
        table, log = TABLES[name], self.log(name)
        folder = log.fresh(f"dt={checked_day(dt)}")
        with settings(self.spark, WRITE_CONF):
            (
                conform(df, table).write.format(self.fmt)
                .option("compression", table.compression if self.fmt == "orc" else "snappy")
                .save(f"{log.root}/{folder}")
            )
        log.commit(lambda days: {dt: folder})

    def read_day(self, name: str, dt: str, missing_ok: bool = False, version: int | None = None) -> DataFrame:
        """One day. Lists that day's folder only. A day never written is an error, or empty with ``missing_ok``."""
        folder = self.log(name).state(version).get(checked_day(dt))
        return self._load(name, [folder] if folder else None, missing_ok, f"day {dt} of {name}")

    def read(
        self, name: str, start: str | None = None, end: str | None = None, missing_ok: bool = False, version: int | None = None
    ) -> DataFrame:
        """All days, or those from ``start`` to ``end``; other days' folders are not listed. ``version`` reads an older state of the log."""
        log = self.log(name)
        known = log.versions()
        days = log.state(version) if known else {}
        first, last = checked_day(start) if start else "", checked_day(end) if end else "9999-12-31"
        folders = [folder for dt, folder in sorted(days.items()) if first <= dt <= last]
        df = self._load(name, folders if known else None, missing_ok, name)
        return df.where(F.col("dt").between(first, last)) if start or end else df

    def days(self, name: str) -> list[str]:
        """The days written, in order; no folder of a day is listed."""
        return sorted(self.log(name).state())

    def drop_day(self, name: str, dt: str) -> bool:
        """Remove one day if it is there."""
        there = checked_day(dt) in self.log(name).state()
        if there:
            self.log(name).commit(lambda days: {dt: None})
        return there

    def has(self, name: str) -> bool:
        """Whether any day was ever written."""
        return bool(self.log(name).versions())

    def latest_day(self, name: str = "mgmt_kpi", default: str | None = None) -> DataFrame:
        """One row with the newest day, or the default when there is none."""
        days = self.days(name)
        return self.spark.createDataFrame([(days[-1] if days else default,)], "dt string")

    def vacuum(self, name: str, keep: int = 2, older_than: float = 86_400.0) -> int:
        """Removes folders of replaced and dropped days and of failed writes; see ``SnapshotLog.vacuum``."""
        return self.log(name).vacuum("dt=*/s-*", keep, older_than)

    def _load(self, name: str, folders: list[str] | None, missing_ok: bool, what: str) -> DataFrame:
        schema = TABLES[name].schema.add("dt", "string")
        if folders is None and not missing_ok:
            raise FileNotFoundError(f"{what} was never written below {self.path(name)}")
        if not folders:
            return self.spark.createDataFrame([], schema)
        paths = [f"{self.path(name)}/{folder}" for folder in folders]
        return self.spark.read.format(self.fmt).schema(schema).option("basePath", self.path(name)).load(paths)


def latest_day(df: DataFrame, default: str | None = None, column: str = "dt") -> DataFrame:
    """Newest value of the day column."""
    return df.agg(F.coalesce(F.max(column), F.lit(default)).alias(column))


def export_json(df: DataFrame, path: str) -> None:
    """Write rows as JSON lines, null fields kept."""
    df.write.mode("overwrite").json(path, ignoreNullFields=False)


# --- catalog tables -----------------------------------------------------------


def create_table_sql(table: Table, fmt: str = "orc", location: str | None = None) -> str:
    """Idempotent table definition. Bucket counts are the contract's; see ``Table.with_buckets`` for large data."""
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in table.schema)
    parts = [
        f"CREATE TABLE IF NOT EXISTS {table.qualified} ({columns}, dt string)",
        f"USING {fmt}",
        f"OPTIONS (compression '{table.compression if fmt == 'orc' else 'snappy'}')",
        "PARTITIONED BY (dt)",
    ]
    if table.buckets:
        parts.append(f"CLUSTERED BY ({table.bucket_by}) INTO {table.buckets} BUCKETS")
    if location:
        parts.append(f"LOCATION '{location}'")
    return " ".join(parts)


def create_tables(
    spark: SparkSession, tables: Iterable[Table] = tuple(TABLES.values()), root: str | None = None, fmt: str = "orc"
) -> None:
    """Create the databases and tables that are missing."""
    for table in tables:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {table.database}")
        location = f"{root.rstrip('/')}/{table.database}/{table.physical}" if root else None
        spark.sql(create_table_sql(table, fmt, location))


def insert_day(spark: SparkSession, table: Table, df: DataFrame, dt: str) -> None:
    """Replace one day of a catalog table.

    Rows of a bucketed table are gathered by bucket before the write, so that a
    bucket is one file; adaptive execution splits a bucket that a common key
    makes too large into several files.
    """
    rows = conform(df, table)
    if table.buckets:
        rows = rows.hint("rebalance", table.buckets, table.bucket_by)
    names = ", ".join(f.name for f in table.schema)
    spark.sql(
        f"INSERT OVERWRITE TABLE {table.qualified} PARTITION (dt = '{checked_day(dt)}') "
        f"SELECT {names} FROM {{rows}}",
        rows=rows,
    )


def publish_tables(lake: Lake, names: Iterable[str] = tuple(TABLES)) -> None:
    """Make the lake's days readable by SQL under the tables' own names, as the logs have them now.

    Each day is a partition at the folder that the log names; days dropped since go. The
    catalog does not list the table's folders itself.
    """
    names = list(names)
    plain = [TABLES[name].with_buckets(0) for name in names]
    create_tables(lake.spark, plain, lake.root, lake.fmt)
    for name, table in zip(names, plain):
        known = {row[0].removeprefix("dt=") for row in lake.spark.sql(f"SHOW PARTITIONS {table.qualified}").collect()}
        days = {dt: f"{lake.path(name)}/{folder}" for dt, folder in lake.log(name).state().items()}
        part = "PARTITION (dt = '{}')".format
        if new := [f"{part(dt)} LOCATION '{days[dt]}'" for dt in sorted(days) if dt not in known]:
            lake.spark.sql(f"ALTER TABLE {table.qualified} ADD IF NOT EXISTS {' '.join(new)}")
        for dt in sorted(known):
            if dt in days:
                lake.spark.sql(f"ALTER TABLE {table.qualified} {part(dt)} SET LOCATION '{days[dt]}'")
        if gone := [part(dt) for dt in sorted(known - set(days))]:
            lake.spark.sql(f"ALTER TABLE {table.qualified} DROP IF EXISTS {', '.join(gone)}")
        lake.spark.catalog.refreshTable(table.qualified)


def drop_partition(spark: SparkSession, table: Table, dt: str) -> None:
    """Drop one day of a catalog table if it is there."""
    spark.sql(f"ALTER TABLE {table.qualified} DROP IF EXISTS PARTITION (dt = '{checked_day(dt)}')")
