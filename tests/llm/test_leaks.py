"""Decontamination: exact passages and spans against brute force, no Python in the plan, and edges."""

import random
import re
from hashlib import sha256

from ledgerlake.llm import leaks
from ledgerlake.llm.leaks import decontaminate, near_passages

SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(SMALL))


def by_hand(docs, tests, n=10):
    passages = {}
    for item, text in tests:
        w = words(text)
        for k in range(max(len(w) - n + 1, 1) if w and item is not None else 0):
            passages.setdefault(tuple(w[k : k + n]), set()).add(str(item))
    out = []
    for doc, text in docs:
        w, hit, items = words(text), set(), set()
        for length in {len(p) for p in passages}:
            for k in range(len(w) - length + 1):
                named = passages.get(tuple(w[k : k + length]))
                if named:
                    hit.update(range(k, k + length))
                    items |= named
        digest = sha256(",".join(sorted(items, key=str.encode)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(items), digest, bool(hit)))
    return sorted(out, key=str)


def shown(df):
    return sorted((tuple(r) for r in df.drop("items").collect()), key=str)


def planted(seed):
    rng = random.Random(seed)
    vocabulary = ["the", "of", "a"] * 8 + [f"w{k}" for k in range(60)] + ["Äpfel", "äpfel", "naïve", "x1", "日本"]
    line = lambda n: rng.choices(vocabulary, k=n)
    common = line(12)  # a passage of several tests and many documents
    tests = [line(rng.randint(11, 30)) for _ in range(12)] + [common + line(3), line(2) + common, ["w1", "w2", "w3"], line(10)]
    docs = []
    for k in range(150):
        text = line(rng.randint(0, 120))
        for _ in range(rng.randint(0, 2)):
            source = rng.choice(tests)
            at = rng.randint(0, max(0, len(source) - 4))
            cut = source[at : at + rng.randint(5, 25)]
            where = rng.randint(0, len(text))
            text[where:where] = cut
        if k % 3 == 0:
            text += common
        joint = rng.choice([" ", ", ", "\n", " - "])
        docs.append((k, joint.join(w.upper() if rng.random() < 0.2 and w.isascii() else w for w in text)))
    return docs, [(k, " ".join(t).title() if k % 2 else " ".join(t)) for k, t in enumerate(tests)]


def test_passages_equal_brute_force(spark):
    for seed in range(3):
        docs, tests = planted(seed)
        docs += [(1000 + k, docs[0][1]) for k in range(40)]  # equal texts are judged each
        found = shown(decontaminate(spark.createDataFrame(docs, "doc_id long, text string").repartition(6), spark.createDataFrame(tests, "item_id long, text string")))
        assert found == by_hand(docs, tests)
        assert any(r[-1] for r in found) and not all(r[-1] for r in found)


def test_shuffled_joins_give_the_same(spark, monkeypatch):
    docs, tests = planted(7)
    monkeypatch.setattr(leaks, "BROADCAST_ROWS", 0)
    found = decontaminate(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(tests, "item_id long, text string"), rarest=2)
    assert shown(found) == by_hand(docs, tests)


def test_edges(spark, edge_docs, no_docs):
    tests = spark.createDataFrame([(1, "the same text here"), (None, "Zwei Wörter"), (3, None), (4, " -- "), (1, "one"), (6, "word1 sits1 word2 sits2 word3 sits3 word4 sits4 word5 sits5 word6")], "item_id long, text string")
    rows = decontaminate(edge_docs, tests).collect()
    assert len(rows) == edge_docs.count()
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, []).append(r)
    assert [(r.n_hit, r.items) for r in by_id[5]] == [(4, ["1"])] * 2 and by_id[8][0].items == ["1"]
    assert by_id[1][0].n_words == by_id[2][0].n_words == by_id[3][0].n_words == 0
    assert not by_id[9][0].contaminated and by_id[4][0].contaminated and by_id[4][0].n_words == 120_000
    assert decontaminate(no_docs, tests).count() == 0
    clean = decontaminate(edge_docs, tests.limit(0)).collect()
    assert len(clean) == len(rows) and not any(r.contaminated for r in clean)


def spans_by_hand(docs, tests, slack, n=10, rarest=3):
    times = {}
    for _, text in docs:
        for w in words(text):
            times[w] = times.get(w, 0) + 1
    passages = {}
    for item, text in tests:
        w = words(text)
        for k in range(max(len(w) - n + 1, 1) if w else 0):
            passages.setdefault(tuple(w[k : k + n]), set()).add(str(item))
    out = set()
    for passage, items in passages.items():
        if any(t not in times for t in passage):
            continue
        order = sorted(range(len(passage)), key=lambda i: (times[passage[i]], i))[:rarest]
        terms = {passage[i] for i in order}
        for doc, text in docs:
            last = {}
            for at, w in enumerate(words(text)):
                if w in terms:
                    last[w] = at
                    if len(last) == len(terms) and at - min(last.values()) < len(passage) + slack:
                        out |= {(doc, item, min(last.values()), at) for item in items}
    return sorted(out)


def test_spans_equal_brute_force(spark):
    docs, tests = planted(4)
    docs, tests = docs[:60], tests[:8]
    found = near_passages(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(tests, "item_id long, text string"), slack=3)
    assert sorted(tuple(r) for r in found.collect()) == spans_by_hand(docs, tests, 3)


def test_no_python_in_plans(spark, sf_dir):
    docs, tests = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    for df in (decontaminate(docs, tests), near_passages(docs, tests)):
        plan = df._jdf.queryExecution().toString()
        assert not [x for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop") if x in plan]
