import re
from collections import defaultdict

from ledgerlake.llm.mixing import mix_documents
from ledgerlake.llm.queries import QUERIES


def targets(sizes, weights, epochs=3):
    fixed = set()
    while True:
        free = [s for s in sizes if s not in fixed]
        total = sum(weights[s] for s in free)
        rest = sum(sizes.values()) - sum(epochs * sizes[s] for s in fixed)
        out = {s: epochs * sizes[s] if s in fixed else rest * weights[s] / total for s in sizes}
        above = {s for s in free if out[s] > epochs * sizes[s] + 1e-9}
        if not above:
            return out
        fixed |= above


def check(rows, sources):
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r, source in zip(rows, sources):
        sizes[source] += r["size"]
        taken[source] += r.taken
        target[source] = r.target
        assert 0 <= r.taken <= 3 * r["size"]
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    expected = targets(sizes, {s: k % 3 + 1 for k, s in enumerate(order)})
    for s in order:
        assert abs(target[s] - expected[s]) < 1e-6
        assert abs(taken[s] - target[s]) <= max(0.02 * target[s], 5), s


def test_query(spark, sf_dir):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op8_mixing"](spark, sf_dir).collect()
    assert {r.doc_id: r["size"] for r in rows} == {k: len(re.findall(r"[^\x20\x09-\x0D]+", d.text)) for k, d in docs.items()}
    total = sum(r["size"] for r in rows)
    assert abs(sum(r.taken for r in rows) - total) < 0.05 * total
    assert sorted(rows) == sorted(QUERIES["op8_mixing"](spark, sf_dir).collect())


def test_capped(spark):
    rows = [(k, "w " * (k % 7 + 1), s) for s, n in (("a", 400), ("b", 30), ("c", 30), (None, 20)) for k in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mix_documents(docs).collect()
    check(got, [r.source for r in got])


def test_edges(edge_docs, no_docs):
    rows = mix_documents(edge_docs).collect()
    assert len(rows) == 12 and all(r.taken == r.copies * r["size"] for r in rows)
    assert max(r.copies for r in rows if r.doc_id == 5) - min(r.copies for r in rows if r.doc_id == 5) <= 1
    assert mix_documents(no_docs).count() == 0


def test_repeated_rows_come_near_the_target(spark):
    """A source of equal rows alone, one in which they are most, and one in which they are few."""
    rows = [(1, "four words stand here", "a")] * 1000 + [(2, "two words", "b")] * 700 + [(k, "w " * (k % 5 + 1), "b") for k in range(10, 60)]
    rows += [(k, "w " * (k % 9 + 1), "c") for k in range(100, 500)] + [(100, "w " * 2, "c")] * 30 + [(7, "", "d")] * 50
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(6)
    got = mix_documents(docs).collect()
    check(got, [r.source for r in got])
    sums = defaultdict(int)
    for r in got:
        sums[r.source] += r.taken
    target = {r.source: r.target for r in got}
    assert abs(sums["a"] - target["a"]) <= 4
    again = mix_documents(docs).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
