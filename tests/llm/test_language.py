import zlib

from pyspark.sql import functions as F

from ledgerlake.llm.language import identify, predict
from ledgerlake.llm.queries import QUERIES


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang").collect()}
    rows = QUERIES["op7_language"](spark, folder).collect()
    assert {r.doc_id for r in rows} == set(truth)
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    # calibrated: the mean score is near the accuracy
    assert abs(sum(r.score for r in held) / len(held) - sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held)) < 0.05


def test_only_text_and_the_other_folds_decide(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    blind = docs.withColumn("lang", F.when(fold != 2, F.col("lang"))).withColumn("source", F.lit(None).cast("string"))
    assert sorted(identify(docs).collect()) == sorted(identify(blind).collect())


def test_edges(edge_docs, no_docs):
    rows = identify(edge_docs).collect()
    assert len(rows) == 12 and {r.lang_pred for r in rows if r.doc_id in (1, 2, 3, 10)} == {"und"}
    assert {r.score for r in rows if r.lang_pred == "und"} == {0.0}
    assert all(r.lang_pred in ("en", "de", "fr") for r in rows if r.doc_id in (4, 5, 6, 8, 9))
    assert identify(no_docs).count() == 0
    assert {r.lang_pred for r in predict(edge_docs, None, None).collect()} == {"und"}
    assert predict(edge_docs, None, None).columns == [*[c for c in edge_docs.columns if c != "score"], "lang_pred", "score"]
