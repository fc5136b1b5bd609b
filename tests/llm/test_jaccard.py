import random
import re
from fractions import Fraction

import pytest

from ledgerlake.llm import jaccard
from ledgerlake.llm.components import components
from ledgerlake.llm.jaccard import jaccard_components, keep_first


def by_hand(rows, n, t):
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set()))
    group = list(range(len(rows)))

    def top(x):
        while group[x] != x:
            x = group[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and len(a & sets[j]) * t.denominator >= t.numerator * len(a | sets[j]):
                x, y = sorted((top(i), top(j)))
                group[y] = x
    least = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            least[top(i)] = min(k, least.get(top(i), k))
    return sorted(((k, len(sets[i]), least.get(top(i)) if sets[i] else k) for i, (k, _) in enumerate(rows)), key=str)


def near_copies(seed, bases, copies, edits):
    """Texts in groups: a base and copies with up to `edits` words changed, some exact, some in other case."""
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    shared = rng.choices(vocabulary, k=40)  # a passage that many documents share
    texts = []
    for _ in range(bases):
        base = rng.choices(vocabulary, k=rng.randint(30, 90)) + (shared if rng.random() < 0.5 else [])
        for _ in range(copies):
            words = list(base)
            for _ in range(rng.randint(0, edits)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            texts.append(" ".join(words).upper() if rng.random() < 0.1 else " ".join(words))
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("n, t, short", [(5, Fraction(4, 5), 64), (3, Fraction(9, 10), 4), (2, Fraction(1, 2), 8)])
def test_components_equal_brute_force(spark, monkeypatch, n, t, short):
    monkeypatch.setattr(jaccard, "SHORT", short)  # the long lists' way as well
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    rows = near_copies(n, 6, 30, 6) + [(1000 + k, x) for k, x in enumerate([None, "", " \n", "one", "One", "one two", "one two three"])]
    rows += [(3, rows[3][1]), (3, "another text of a repeated id"), (None, rows[5][1]), (None, None)]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, n int, tk int")
    found = jaccard_components(docs, n, t)
    assert sorted((tuple(r) for r in found.collect()), key=str) == by_hand(rows, n, t)


@pytest.mark.parametrize("n, t, short", [(5, Fraction(4, 5), 16), (3, Fraction(9, 10), 4), (2, Fraction(1, 2), 8)])
def test_links_equal_brute_force(spark, monkeypatch, n, t, short):
    monkeypatch.setattr(jaccard, "SHORT", short)
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    rows = near_copies(n, 4, 40, 4) + [(1000 + k, x) for k, x in enumerate([None, "", "one", "One", "one two"])]
    found = {r.doc_id: r for r in jaccard.jaccard_links(spark.createDataFrame(rows, "doc_id long, text string"), n, t).collect()}
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in found.values()} == set(by_hand(rows, n, t))
    links = dict.fromkeys(found, 0)
    for i, a in enumerate(rows):
        for b in rows[:i]:
            if by_hand([(0, a[1]), (1, b[1])], n, t)[1][2] == 0:
                links[a[0]] += 1
                links[b[0]] += 1
    assert max(links.values()) > short // 2 and {k: r.n_links for k, r in found.items()} == links


def test_keep_first(spark):
    rows = near_copies(9, 5, 8, 3) + [(900, None), (901, ""), (901, ""), (3, None)]
    rows.append(rows[2])
    docs = spark.createDataFrame([(k, x, f"s{i}") for i, (k, x) in enumerate(rows)], "doc_id long, text string, source string")
    expected = by_hand(rows, 5, Fraction(4, 5))
    kept = keep_first(docs).collect()
    assert sorted(r.doc_id for r in kept if r.text and r.text.strip()) == sorted({c for _, n, c in expected if n})
    assert len([r for r in kept if not r.text]) == 4


def test_edges(spark, edge_docs, no_docs):
    found = {(r.doc_id, r.component_id) for r in jaccard_components(edge_docs).collect()}
    assert {(5, 5), (6, 5), (1, 1), (2, 2), (3, 3), (8, 8), (None, None)} <= found
    assert jaccard_components(no_docs).count() == 0 and keep_first(no_docs).count() == 0
    assert keep_first(edge_docs).columns == edge_docs.columns


def test_long_paths(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(60)] + [(100, 101), (101, 100), (7, 7)], "a long, b long")
    got = {r.node: r.component for r in components(links).collect()}
    assert got == {k: 0 for k in range(61)} | {100: 100, 101: 100}
    assert components(links.limit(0)).count() == 0


def test_bitmaps_never_drop_a_link():
    import numpy as np

    from ledgerlake.llm.common import mix
    from ledgerlake.llm.jaccard import _fold, _sketched

    levels, t = np.zeros(1 << jaccard.SKETCH_BITS, dtype=np.uint8), Fraction(4, 5)
    for n in (10, 900, 1020, 1030, 2050, 5000):
        a = np.sort(mix(np.arange(n, dtype=np.uint64)))
        b = np.sort(np.concatenate([a[: int(n * 0.9)], mix(np.arange(10**6, 10**6 + n // 50, dtype=np.uint64))]))
        x, y = (_sketched(s, levels, t)[1].view(np.uint64)[None, :] for s in (a, b))
        words = min(x.shape[1], y.shape[1])
        common = len(np.intersect1d(a, b))
        assert np.bitwise_count(_fold(x, words) ^ _fold(y, words)).sum() <= len(a) + len(b) - 2 * common


@pytest.mark.parametrize("foreign", [1, 40])
def test_rows_of_a_long_list_are_copied_for_its_smaller_components_only(spark, monkeypatch, foreign):
    monkeypatch.setattr(jaccard, "BLOCK", 50)
    long = spark.range(4000).selectExpr(
        "7 as list", "id", "100 as n", "0 as pos", "cast(null as long) as prev", f"if(id < {foreign}, id, 9999) as component"
    )
    nodes = spark.range(4000).selectExpr("id", "array(id) as bits")
    rows = jaccard._blocks(long.union(long.filter(f"id >= {foreign}").selectExpr("8", "id", "n", "pos", "prev", "component")), nodes)
    # every row once, and the foreign ones for each of 80 blocks; the list of one component not at all
    assert rows.count() == 4000 + 80 * foreign and rows.filter("list != 7").isEmpty()


def test_all_pairs_of_different_components_meet_once(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 20)
    long = spark.range(200).selectExpr("7 as list", "id", "100 as n", "0 as pos", "cast(null as long) as prev", "if(id < 90, 1000, id div 3) as component")
    met = {}
    for _, part in jaccard._blocks(long, spark.range(200).selectExpr("id", "array(0L) as bits")).toPandas().groupby(["i", "j"]):
        a, b = jaccard._block_matches(part[part.asks], part[~part.asks], Fraction(1, 2), False)
        for x, y in zip(a.tolist(), b.tolist()):
            pair = min(x, y), max(x, y)
            met[pair] = met.get(pair, 0) + 1
    component = lambda k: 1000 if k < 90 else k // 3
    assert met == {(x, y): 1 for y in range(200) for x in range(y) if component(x) != component(y)}


@pytest.mark.parametrize("nearest", [True, False])
def test_blocks_hold_bitmaps_of_a_length_that_no_partner_has(nearest):
    import numpy as np
    import pandas as pd

    def block(*rows):
        maps = [np.ones(jaccard.BITMAP * wide, np.int64) for _, _, wide in rows]
        return pd.DataFrame({"id": [r[0] for r in rows], "n": [r[1] for r in rows], "bits": maps}).assign(
            component=lambda f: f["id"], prev=lambda f: f["id"], pos=0, once=False
        )

    right = block((1, 1000, 1), (2, 1030, 2), (3, 5000, 8), (4, 300, 1))
    for (row, n, wide), partner in {(1, 1000, 1): 2, (9, 1200, 2): 2, (8, 310, 1): 4, (7, 5100, 8): 3, (6, 9000, 16): None}.items():
        a, b = jaccard._block_matches(block((row, n, wide)), right, Fraction(9, 10) if row != 9 else Fraction(17, 20), nearest)
        assert (a.tolist(), b.tolist()) == (([row], [partner]) if partner else ([], []))


def test_keep_first_where_long_lists_hold_small_and_large_sets(spark, monkeypatch):
    import numpy as np

    monkeypatch.setattr(jaccard, "SHORT", 4)
    # as on large tables, where every place of the sketch is taken by many n-grams
    monkeypatch.setattr(jaccard, "frequency_levels", lambda texts, n: np.zeros(1 << jaccard.SKETCH_BITS, np.uint8))
    rng = random.Random(4)
    words = lambda k: [f"w{rng.randrange(10**9)}" for _ in range(k)]
    passage = words(700)
    texts = [passage + words(280)] + [passage + words(340 + k) for k in range(8)]  # sets of 976 n-grams, and of 1036 and more
    texts += [[*texts[4], *words(9)], [*texts[4], *words(20)]]  # links
    rows = list(enumerate(" ".join(x) for x in texts))
    expected = by_hand(rows, 5, Fraction(4, 5))
    assert {n > jaccard.BITMAP_SET for _, n, _ in expected} == {True, False} and len({c for _, _, c in expected}) == 9
    kept = keep_first(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r.doc_id for r in kept) == sorted({c for _, _, c in expected})
