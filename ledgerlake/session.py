"""Session settings the library expects, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark import SparkContext
from pyspark.sql import SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"

# Runtime SQL settings; cluster sizing (executors, memory, shuffle partitions) stays with the submitter.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",  # hour() of a zone-less text time must not depend on the host
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.bucketing.coalesceBucketsInJoin.enabled": "true",  # 32-bucket vault against 16-bucket summary
}

# Long-running streams only: keeps state off the executor heap. Must be set before the first start of a query.
STREAM_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a running session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def settings(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """These settings for a while; afterwards the session's own hold again."""
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def local_session(cores: int | str = "*", app: str = "ledgerlake", **conf: str) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="ledgerlake-")


@cache
def _owned(application: str, folder: str) -> str:
    """The application's own folder below the scratch folder, removed when its JVM ends."""
    context = SparkContext.getOrCreate()
    path = context._jvm.org.apache.hadoop.fs.Path(f"{folder}/{application}")
    files = path.getFileSystem(context._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return path.toString()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared checkpoint folder the session names.

    Every executor must see it, so a machine-local folder serves only a local
    master that names none. Its owner, the application, removes it when it ends.
    """
    root = spark.conf.get(CHECKPOINT_SETTING, None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"set {CHECKPOINT_SETTING} to a folder shared by all executors")
        root = _local_root()
    folder = f"{root.rstrip('/')}/ledgerlake"
    if isinstance(spark, SparkSession):
        folder = _owned(spark.sparkContext.applicationId, folder)
    return f"{folder}/{label}-{uuid.uuid4().hex}"
