import glob
import json

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from ledgerlake.operators.vault import HUBS, build_hub
from ledgerlake.schemas import SOURCES, TABLES
from ledgerlake.session import scratch_dir
from ledgerlake.sources.delimited import type_rows
from ledgerlake.sources.lake import (
    Lake, create_table_sql, create_tables, drop_partition, export_json, insert_day,
    latest_day, publish_tables,
)

D1, D2 = "2026-06-13", "2026-06-14"


def hub(spark, dt, *ids):
    rows = spark.createDataFrame([(i,) for i in ids], "customer_id string")
    return build_hub(rows, HUBS["hub_customer"], dt)


def _time_types(path):
    files = glob.glob(path + "/**/*.parquet", recursive=True)
    schemas = [pq.read_metadata(f).schema for f in files]
    return {(c.name, c.physical_type) for schema in schemas for c in schema if c.name in ("ingest_time", "create_time", "complete_time")}


def test_times_of_a_parquet_day_are_longs(spark, tmp_path):
    """Days in the older form and in the new one are read together, and the session's own setting stays."""
    lake = Lake(spark, str(tmp_path), "parquet")
    times = ["0001-01-01 00:00:00", "1899-12-31 23:59:59.999999", "2026-06-14 10:00:00.000001", "9999-12-31 23:59:59.999999", None]
    rows = type_rows(spark.createDataFrame([(f"P{i}", t) for i, t in enumerate(times)], "pay_id string, create_time string")
                     .select("*", *[F.lit(None).cast("string").alias(n) for n in SOURCES["payment"].schema.names
                                    if n not in ("pay_id", "create_time")]), "payment", D1)
    own = spark.conf.get("spark.sql.parquet.outputTimestampType")
    lake.write_day("ods_payment", rows, D2)
    assert _time_types(lake.path("ods_payment")) == {(n, "INT64") for n in ("ingest_time", "create_time", "complete_time")}
    assert spark.conf.get("spark.sql.parquet.outputTimestampType") == own
    log = lake.log("ods_payment")
    old = log.fresh(f"dt={D1}")
    spark.conf.set("spark.sql.parquet.outputTimestampType", "INT96")
    try:
        rows.write.parquet(f"{log.root}/{old}")
    finally:
        spark.conf.set("spark.sql.parquet.outputTimestampType", own)
    log.commit(lambda days: {D1: old})
    for dt in (D1, D2):
        got = lake.read("ods_payment", dt, dt).orderBy("pay_id").select(F.col("create_time").cast("string")).collect()
        assert [r[0] for r in got] == times, dt


def ids(df):
    return sorted((r.dt, r.customer_id) for r in df.collect())


@pytest.mark.parametrize("fmt", ["orc", "parquet"])
def test_a_day_is_replaced_and_others_stay(spark, tmp_path, fmt):
    lake = Lake(spark, str(tmp_path), fmt)
    lake.write_day("hub_customer", hub(spark, D1, "a"), D1)
    lake.write_day("hub_customer", hub(spark, D2, "b", "c"), D2)
    lake.write_day("hub_customer", hub(spark, D2, "d"), D2)
    lake.write_day("hub_customer", hub(spark, D2, "d"), D2)
    assert ids(lake.read("hub_customer")) == [(D1, "a"), (D2, "d")]
    assert ids(lake.read_day("hub_customer", D1)) == [(D1, "a")]
    assert ids(lake.read("hub_customer", start=D2)) == [(D2, "d")]
    lake.write_day("hub_customer", hub(spark, D2, "x").limit(0), D2)
    assert ids(lake.read("hub_customer")) == [(D1, "a")]


def test_missing_days_and_drops(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    for read in (lambda **kw: lake.read_day("hub_customer", D1, **kw), lambda **kw: lake.read("hub_customer", **kw)):
        with pytest.raises(FileNotFoundError):
            read()
        assert read(missing_ok=True).count() == 0
        assert read(missing_ok=True).columns == [*TABLES["hub_customer"].schema.names, "dt"]
    assert not lake.drop_day("hub_customer", D1)
    lake.write_day("hub_customer", hub(spark, D1, "a"), D1)
    assert lake.drop_day("hub_customer", D1)
    assert lake.read("hub_customer").count() == 0
    with pytest.raises(ValueError):
        lake.read_day("hub_customer", "14/06/2026")


def test_a_failed_write_leaves_the_day_as_it_was(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    lake.write_day("hub_customer", hub(spark, D1, "a"), D1)
    bad = hub(spark, D1, "b").withColumn("customer_id", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception, match="broken"):
        lake.write_day("hub_customer", bad, D1)
    assert ids(lake.read_day("hub_customer", D1)) == [(D1, "a")] and lake.days("hub_customer") == [D1]
    assert ids(lake.read("hub_customer")) == [(D1, "a")]


def test_latest_day(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    assert lake.latest_day("hub_customer", default=D1).first().dt == D1
    for day in (D2, D1):
        lake.write_day("hub_customer", hub(spark, day, "a"), day)
    assert lake.latest_day("hub_customer").first().dt == D2
    assert latest_day(lake.read("hub_customer")).first().dt == D2


def test_range_reads_prune_partitions(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    for day in (D1, D2):
        lake.write_day("hub_customer", hub(spark, day, "a"), day)
    df = lake.read("hub_customer", D2, D2).where("customer_id = 'a'").select("customer_id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan and "PushedFilters: [IsNotNull(customer_id)" in plan
    assert len(df.inputFiles()) >= 1 and all(f"dt={D2}" in f for f in lake.read_day("hub_customer", D2).inputFiles())


def test_json_lines_keep_nulls_and_decimals(spark, tmp_path):
    out = str(tmp_path / "json")
    export_json(spark.createDataFrame([("总", None, "1.50")], "a string, b string, c string").withColumn(
        "c", F.col("c").cast("decimal(18,2)")), out)
    lines = [line for f in glob.glob(out + "/*.json") for line in open(f, encoding="utf-8")]
    assert [json.loads(x) for x in lines] == [{"a": "总", "b": None, "c": 1.5}]


def test_catalog_tables(spark, tmp_path):
    for table in TABLES.values():
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {table.database}")
        spark.sql(f"DROP TABLE IF EXISTS {table.qualified}")
    create_tables(spark, root=str(tmp_path))
    create_tables(spark, root=str(tmp_path))
    assert len(TABLES) == 21
    for table in TABLES.values():
        stored = spark.table(table.qualified).schema
        assert [(f.name, f.dataType) for f in stored] == [(f.name, f.dataType) for f in table.schema.add("dt", "string")]
    table = TABLES["hub_customer"]
    insert_day(spark, table, hub(spark, D1, "a"), D1)
    insert_day(spark, table, hub(spark, D2, "b"), D2)
    insert_day(spark, table, hub(spark, D2, "c", "d"), D2)
    assert ids(spark.table(table.qualified)) == [(D1, "a"), (D2, "c"), (D2, "d")]
    drop_partition(spark, table, D1)
    drop_partition(spark, table, D1)
    assert {r.dt for r in spark.table(table.qualified).collect()} == {D2}


def test_bucketed_tables_join_and_count_without_a_shuffle(spark, tmp_path):
    names = ("hub_account", "sat_balance")
    tables = [TABLES[n].with_buckets(4) for n in names]
    for table in tables:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {table.database}")
        spark.sql(f"DROP TABLE IF EXISTS {table.qualified}")
    create_tables(spark, tables, str(tmp_path / "bucketed"))
    keys = spark.range(200).select(F.md5(F.col("id").cast("string")).alias("account_hash_key"))
    for table in tables:
        insert_day(spark, table, keys.select(
            *[F.col(f.name) if f.name == "account_hash_key" else F.lit(None).alias(f.name) for f in table.schema]), D1)
    left, right = (spark.table(t.qualified).where(f"dt = '{D1}'") for t in tables)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = left.join(right, "account_hash_key").groupBy("account_hash_key").count()
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 200
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_common_key_does_not_leave_its_bucket(spark, tmp_path):
    table = TABLES["sat_transaction"].with_buckets(4)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {table.database}")
    spark.sql(f"DROP TABLE IF EXISTS {table.qualified}")
    create_tables(spark, [table], str(tmp_path / "hot"))
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("transaction_hash_key"),
        *[F.lit(None).alias(f.name) for f in table.schema if f.name != "transaction_hash_key"])
    insert_day(spark, table, rows, D1)
    stored = spark.table(table.qualified)
    assert stored.count() == 3000 and stored.where("transaction_hash_key = 'hot'").count() == 1000
    assert stored.groupBy("transaction_hash_key").count().count() == 2001  # counted bucket by bucket
    spark.sql(f"DROP TABLE {table.qualified}")


def test_published_folders_answer_sql(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    for name in ("hub_customer", "hub_org"):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {TABLES[name].database}")
        spark.sql(f"DROP TABLE IF EXISTS {TABLES[name].qualified}")
    lake.write_day("hub_customer", hub(spark, D1, "a", "b"), D1)
    publish_tables(lake, ["hub_customer", "hub_org"])
    lake.write_day("hub_customer", hub(spark, D2, "c"), D2)
    publish_tables(lake, ["hub_customer", "hub_org"])
    got = spark.sql("SELECT dt, COUNT(1) AS n FROM bank_dwd.dwd_hub_customer GROUP BY dt ORDER BY dt").collect()
    assert [tuple(r) for r in got] == [(D1, 2), (D2, 1)]
    assert spark.sql("SELECT MAX(dt) FROM bank_dwd.dwd_hub_org").first()[0] is None
    for name in ("hub_customer", "hub_org"):
        spark.sql(f"DROP TABLE {TABLES[name].qualified}")


def test_table_text():
    text = create_table_sql(TABLES["cust_daily_summary"])
    assert "CLUSTERED BY (customer_hash_key) INTO 16 BUCKETS" in text
    assert "CLUSTERED" not in create_table_sql(TABLES["ods_loan"])
    assert "compression 'snappy'" in create_table_sql(TABLES["ods_loan"])
    assert "INTO 4096 BUCKETS" in create_table_sql(TABLES["sat_transaction"].with_buckets(4096))


class Named:
    """Stands for a session: only its settings are asked."""

    def __init__(self, **settings):
        self.conf = self
        self.settings = {k.replace("_", "."): v for k, v in settings.items()}

    def get(self, key, default=None):
        return self.settings.get(key, default)


def test_scratch_follows_the_session():
    cluster = Named(spark_master="yarn", spark_checkpoint_dir="s3://shared/cp/")
    first, second = scratch_dir(cluster, "x"), scratch_dir(cluster, "x")
    assert first != second and first.startswith("s3://shared/cp/ledgerlake/x-")
    with pytest.raises(ValueError):
        scratch_dir(Named(spark_master="yarn"), "x")
    assert "/ledgerlake-" in scratch_dir(Named(spark_master="local[2]"), "x")
