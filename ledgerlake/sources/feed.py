"""The transaction topic: JSON rows and change envelopes on one feed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StructField, StructType, TimestampType

from ledgerlake.schemas import CHANGE_ENVELOPE, CHANGE_ROW, STREAM_ROW, STREAM_TOPIC


def kafka_source(
    spark: SparkSession, servers: str, topic: str = STREAM_TOPIC, starting: str = "latest", **options: str
) -> DataFrame:
    """Raw topic as a stream; needs Spark's Kafka connector on the class path."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .options(**options)
        .load()
    )


def file_source(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """A folder of JSON-line files as a stream with the topic's ``value`` column."""
    reader = spark.readStream.schema("value string")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(path)


def _parsed(value: str, schema: StructType, keep: Callable[[Column], Column]) -> Column:
    """Fields of the parsed text, for the rows worth keeping.

    The test sits inside the expression: as a filter it would be pushed below
    the parse and parse each text again for every field it looks at.
    """
    row = F.from_json(F.col(value).cast("string"), schema, {"mode": "PERMISSIVE"})
    return F.inline(F.filter(F.array(row), keep))


def decode_rows(feed: DataFrame, value: str = "value") -> DataFrame:
    """Transaction rows of the feed. A missing or bad field is null; bad text and change envelopes are skipped."""

    def any_field(row: Column) -> Column:
        return F.coalesce(*[row[name].cast("string") for name in STREAM_ROW.names]).isNotNull()

    return feed.select(_parsed(value, STREAM_ROW, any_field))


def decode_changes(
    feed: DataFrame, value: str = "value", table: str = "t_transaction", database: str = "bank_source", key: str = "trans_id"
) -> DataFrame:
    """Changed rows of one table's envelopes, typed, with operation, commit time and place.

    An update that changes the key is two changes: a delete of the old key, taken
    from the envelope's ``old`` values, and the new row.
    """

    def is_change(envelope: Column) -> Column:
        return (
            envelope["type"].isin("INSERT", "UPDATE", "DELETE")
            & (envelope["table"] == table) & (envelope["database"] == database)
        )

    envelopes = feed.select(_parsed(value, CHANGE_ENVELOPE, is_change))
    rows = envelopes.select(
        F.col("type").alias("op"), "es", F.col("id").alias("batch"), F.col("old").alias("before"),
        F.posexplode("data").alias("pos", "row"),
    ).withColumn("before", F.get("before", F.col("pos"))[key])
    moved = (F.col("op") == "UPDATE") & F.col("before").isNotNull() & (F.col("before") != F.col(f"row.{key}"))
    typed = {
        "trans_amt": F.col("row.trans_amt").try_cast("decimal(18,2)"),
        "trans_time": F.col("row.trans_time").try_cast("timestamp"),
    }
    fields = [typed.get(name, F.col(f"row.{name}")).alias(name) for name in CHANGE_ROW.names]
    row = F.struct("op", "es", "batch", "pos", *fields)
    gone = F.struct(
        F.lit("DELETE").alias("op"), "es", "batch", "pos",
        *[(F.col("before") if f.name == key else F.lit(None).cast(f.dataType)).alias(f.name) for f in _change_fields()],
    )
    both = F.when(F.coalesce(moved, F.lit(False)), F.array(gone, row)).otherwise(F.array(row))
    return rows.select(F.inline(both))


def _change_fields():
    kinds = {"trans_amt": DecimalType(18, 2), "trans_time": TimestampType()}
    return [StructField(f.name, kinds.get(f.name, f.dataType)) for f in CHANGE_ROW]
