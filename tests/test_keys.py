from hashlib import md5

from pyspark.sql import functions as F

from ledgerlake.functions import keys


def one(spark, column, **cells):
    return spark.createDataFrame([tuple(cells.values())], ", ".join(f"{c} string" for c in cells)).select(column).first()[0]


def test_fixed_vectors(spark):
    key = keys.hub_key("CORE", "id", keys.HUB_CUSTOMER)
    assert one(spark, key, id="C1") == "2c421fa635a556d688d4dbd7e3174015"
    assert one(spark, key, id=None) == "3e5761f6bedb32b1887279bdaeb94695"


def test_null_empty_and_padded_ids_hash_alike(spark):
    key = keys.hub_key("CORE", "id", keys.HUB_ACCOUNT)
    assert one(spark, key, id=None) == one(spark, key, id="") == one(spark, key, id="   ")
    assert one(spark, key, id=" A1 ") == one(spark, key, id="A1")


def test_link_key(spark):
    key = keys.link_key(F.col("a"), F.col("b"), "PRIMARY", "LINK_CUST_ACCT")
    assert one(spark, key, a="x", b="y") == md5(b"x|y|PRIMARY|LINK_CUST_ACCT").hexdigest()


def test_hash_diff_covers_the_tracked_attributes_only(spark):
    row = {a: a for a in keys.TRACKED_ATTRIBUTES} | {"address": "here"}
    before = one(spark, keys.hash_diff(), **row)
    assert before == md5("|".join(keys.TRACKED_ATTRIBUTES).encode()).hexdigest()
    assert one(spark, keys.hash_diff(), **row | {"address": "there"}) == before
    for name in keys.TRACKED_ATTRIBUTES:
        assert one(spark, keys.hash_diff(), **row | {name: "other"}) != before
        assert one(spark, keys.hash_diff(), **row | {name: None}) != before
    wider = keys.hash_diff([*keys.TRACKED_ATTRIBUTES, "address"])
    assert one(spark, wider, **row) != one(spark, wider, **row | {"address": "there"})
