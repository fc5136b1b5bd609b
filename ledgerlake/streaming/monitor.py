"""Live monitoring of the transaction stream.

Every transform takes and returns a DataFrame and works on a batch frame too,
which is how the streams are checked. The ``start_*`` functions add a sink.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerlake.functions.predicates import HIGH_AMOUNT, LARGE_AMOUNT, is_large
from ledgerlake.sources.snapshots import Edits, SnapshotLog

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
WATERMARK = "10 seconds"
WINDOW = "10 seconds"


def with_event_time(rows: DataFrame, delay: str = WATERMARK) -> DataFrame:
    """Event time from the row's time text, with its watermark; rows without a readable time are dropped."""
    timed = rows.withColumn("txn_ts", F.try_to_timestamp("trans_time", F.lit(TIME_FORMAT)))
    return timed.where(F.col("txn_ts").isNotNull()).withWatermark("txn_ts", delay)


def split_future(rows: DataFrame, arrival: str = "timestamp", tolerance: str = "1 minute") -> tuple[DataFrame, DataFrame]:
    """Rows in time, and rows dated further ahead of their arrival than tolerated.

    One row from the future would move the watermark and make good rows late;
    apply this before ``with_event_time``.
    """
    time = F.try_to_timestamp("trans_time", F.lit(TIME_FORMAT))
    ahead = F.coalesce(time > F.col(arrival) + F.expr(f"INTERVAL {tolerance}"), F.lit(False))
    return rows.where(~ahead), rows.where(ahead)


def account_windows(rows: DataFrame, width: str = WINDOW) -> DataFrame:
    """Count and amount per window, channel and account."""
    return rows.groupBy(F.window("txn_ts", width), "channel", "account_no").agg(
        F.count(F.lit(1)).alias("txn_cnt"), F.sum("trans_amt").alias("txn_amt")
    )


def roll_up_accounts(windows: DataFrame, *group: str) -> DataFrame:
    """Account windows to channel windows; each account is one row, so counting rows counts it once."""
    return windows.groupBy(*group).agg(
        F.sum("txn_cnt").alias("txn_cnt"),
        F.sum("txn_amt").alias("txn_amt"),
        F.count("account_no").alias("active_accounts"),
    )


def channel_windows(rows: DataFrame, width: str = WINDOW) -> DataFrame:
    """Count, amount and exact distinct accounts per window and channel; append mode.

    Two aggregates instead of one set of accounts per channel: the state is
    one small row per account, spread over all partitions, however busy a
    channel is.
    """
    stats = roll_up_accounts(account_windows(rows, width), "window", "channel")
    return stats.select(
        F.col("window.start").alias("window_start"), "channel", "txn_cnt", "txn_amt", "active_accounts"
    )


def channel_success(rows: DataFrame, width: str = "5 minutes", failed: tuple[str, ...] = ("REVERSAL",)) -> DataFrame:
    """Count and count of non-reversals per window and channel."""
    return (
        rows.groupBy(F.window("txn_ts", width), "channel")
        .agg(
            F.count(F.lit(1)).alias("total_cnt"),
            F.count_if(~F.col("trans_type").isin(*failed)).alias("success_cnt"),
        )
        .select(F.col("window.start").alias("window_start"), "channel", "total_cnt", "success_cnt")
    )


def large_amount_alerts(rows: DataFrame, large: Decimal = LARGE_AMOUNT, high: Decimal = HIGH_AMOUNT) -> DataFrame:
    """Rows above the threshold, with their level; stateless."""
    amount = F.col("trans_amt")
    return rows.where(is_large(amount, large)).select(
        "trans_id", "trans_time", "account_no", "trans_amt", "channel",
        F.lit("LARGE_AMOUNT").alias("alert_type"),
        F.when(amount > F.lit(high), "HIGH").otherwise("MEDIUM").alias("risk_level"),
    )


# --- sinks ------------------------------------------------------------------------


def start_append(
    stream: DataFrame, path: str, checkpoint: str, finite: bool = False, fmt: str = "parquet"
) -> StreamingQuery:
    """Append finished rows to files; exactly once through the checkpoint."""
    writer = stream.writeStream.outputMode("append").format(fmt).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if finite else writer).start(path)


_UPDATES = (
    "window struct<start: timestamp, end: timestamp>, channel string, account_no string, txn_cnt long, txn_amt decimal(28,2), "
    "batch_id long, dt date"
)


def start_account_windows(
    rows: DataFrame, path: str, checkpoint: str, width: str = WINDOW, finite: bool = False, files: int = 16
) -> StreamingQuery:
    """Keep account windows up to date in files, open windows included.

    Update mode: each batch writes the new totals of the windows it touched to
    folders of its own, one for each day, and then publishes them in the path's log, all at once: a reader has a
    batch wholly or not at all, and a retried batch takes the place of its first try. A day whose
    windows are closed is rolled up by ``compact_days``. ``files`` is the
    number of files per day and batch; without it every state partition would
    write one for every day.

    Batch numbers start anew with a new checkpoint, and totals with them. So a
    path that already holds batches is refused unless the checkpoint has them too.
    """
    spark = rows.sparkSession
    if SnapshotLog(spark, path).versions() and not _children(spark, f"{checkpoint.rstrip('/')}/commits", "*"):
        raise ValueError(f"{path} holds batches that the checkpoint {checkpoint} does not know; take a new path")

    def write(batch: DataFrame, batch_id: int) -> None:
        log = SnapshotLog(batch.sparkSession, path)
        folder, piece = log.fresh(), F.pmod(F.xxhash64("channel", "account_no", "window.start"), F.lit(files))
        (
            batch.withColumns({"dt": F.to_date("window.start"), "batch_id": F.lit(batch_id).cast("long"), "day": F.to_date("window.start")})
            .repartition("dt", piece).write.partitionBy("day").parquet(f"{log.root}/{folder}")
        )
        days = _children(batch.sparkSession, f"{log.root}/{folder}", "day=*")
        new = {f"{day.removeprefix('day=')}/{batch_id}": f"{folder}/{day}" for day in days}

        def edit(now: dict[str, str]) -> Edits:
            again = {name: None for name in now if name.endswith(f"/{batch_id}")}
            return {**again, **new}

        log.commit(edit)

    writer = (
        account_windows(rows, width).writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint).foreachBatch(write)
    )
    return (writer.trigger(availableNow=True) if finite else writer).start()


def _children(spark: SparkSession, path: str, pattern: str) -> list[str]:
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{pattern}")
    found = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(folder) or []
    return [entry.getPath().getName() for entry in found]


def _read(log: SnapshotLog, folders: list[str]) -> DataFrame:
    # folders' names say nothing that the rows don't
    return log.spark.read.schema(_UPDATES).option("recursiveFileLookup", True).parquet(*log.located(folders))


def compact_days(spark: SparkSession, path: str, compacted: str, before: str) -> list[str]:
    """Rolls up each day earlier than ``before``, whose windows must be closed; returns the days.

    A day's newest totals go to ``compacted``, and then the path's log forgets its
    batches. A day is read from ``compacted`` as soon as its log has it, so this can
    be repeated after a failure. ``vacuum_windows`` removes the folders.
    """
    source, target = SnapshotLog(spark, path), SnapshotLog(spark, compacted)
    state = source.state()
    done = sorted({name.partition("/")[0] for name in state if name < before})
    for dt in done:
        batches = {name: folder for name, folder in state.items() if name.startswith(f"{dt}/")}
        if dt not in target.state():
            folder = target.fresh(f"dt={dt}")
            totals = _newest(_read(source, list(batches.values())))
            totals.withColumns({"batch_id": F.lit(0).cast("long"), "dt": F.to_date("window.start")}).write.parquet(f"{target.root}/{folder}")
            target.commit(lambda now, dt=dt, folder=folder: {dt: folder})
        source.commit(lambda now, batches=batches: {name: None for name in batches})
    return done


def vacuum_windows(spark: SparkSession, path: str, keep: int = 2, older_than: float = 86_400.0) -> int:
    """Removes folders of retried, failed and compacted batches; see ``SnapshotLog.vacuum``."""
    return SnapshotLog(spark, path).vacuum("data/s-*/day=*", keep, older_than)


def _newest(updates: DataFrame) -> DataFrame:
    newest = updates.groupBy("window", "channel", "account_no").agg(
        F.max_by(F.struct("txn_cnt", "txn_amt"), "batch_id").alias("newest")
    )
    return newest.select("window", "channel", "account_no", "newest.*")


def read_channel_windows(
    spark: SparkSession, path: str, since: str | None = None, compacted: str | None = None
) -> DataFrame:
    """Channel windows from the files of ``start_account_windows``: newest total per account window, rolled up.

    ``since`` is the first day to read; earlier folders are not opened. Days in
    ``compacted`` are read from there.
    """
    log = SnapshotLog(spark, path)
    rolled = SnapshotLog(spark, compacted) if compacted else None
    days = {dt: folder for dt, folder in (rolled.state() if rolled else {}).items()}
    if not log.versions() and not days:
        raise FileNotFoundError(f"no batches at {path}")
    batches = [
        folder for name, folder in log.state().items()
        if (dt := name.partition("/")[0]) not in days and (not since or dt >= since)
    ]
    closed = [folder for dt, folder in days.items() if not since or dt >= since]
    totals = _newest(_read(log, batches) if batches else spark.createDataFrame([], _UPDATES))
    if closed:
        totals = totals.unionByName(_read(rolled, closed).select(*totals.columns))
    return roll_up_accounts(totals, "window", "channel").select(
        F.col("window.start").alias("window_start"), "channel", "txn_cnt", "txn_amt", "active_accounts"
    )


# --- sketches ---------------------------------------------------------------------

#: Registers of a sketch, as a power of two: its relative standard error is about 1.04 / sqrt(2 ** SKETCH).
SKETCH = 12


def sketch_windows(rows: DataFrame, width: str = WINDOW, precision: int = SKETCH) -> DataFrame:
    """Count, amount and a sketch of the accounts per window and channel.

    State is one sketch for each window and channel, of a few kilobytes however many
    accounts there are; sketches of a busy channel are merged before the shuffle.
    """
    return (
        rows.groupBy(F.window("txn_ts", width), "channel")
        .agg(
            F.count(F.lit(1)).alias("txn_cnt"), F.sum("trans_amt").alias("txn_amt"),
            F.hll_sketch_agg("account_no", F.lit(precision)).alias("accounts"),
        )
        .select(F.col("window.start").alias("window_start"), "channel", "txn_cnt", "txn_amt", "accounts")
    )


def roll_up_sketches(windows: DataFrame, width: str, *group: str) -> DataFrame:
    """Sketch windows of a smaller width to ``width``, by ``group`` ("channel" by default); accounts of several are counted once.

    Nothing but the windows is read: an hour or a day needs no transactions. ``width`` must be a
    multiple of theirs.
    """
    keys = group or ("channel",)
    return (
        windows.groupBy(F.window("window_start", width), *keys)
        .agg(F.sum("txn_cnt").alias("txn_cnt"), F.sum("txn_amt").alias("txn_amt"), F.hll_union_agg("accounts").alias("accounts"))
        .select(F.col("window.start").alias("window_start"), *keys, "txn_cnt", "txn_amt", "accounts")
    )


def estimated(windows: DataFrame) -> DataFrame:
    """Sketch windows with ``active_accounts``, the estimated number of accounts, in the sketch's place."""
    return windows.withColumn("active_accounts", F.hll_sketch_estimate("accounts")).drop("accounts")


def error_bound(exact: Column, precision: int = SKETCH, deviations: float = 4.0) -> Column:
    """How far an estimate may lie from the exact count: ``deviations`` standard errors, and one for rounding."""
    return exact * F.lit(deviations * 1.04 / 2 ** (precision / 2)) + 1
