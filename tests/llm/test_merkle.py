"""Merkle manifest: against a plain tree in Python, tampered rows, and edges."""

import random
from hashlib import sha256
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from ledgerlake.llm.merkle import BLOCK, GrowingTree, fold, merkle_manifest

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def plain_tree(leaves):
    """Root, and for each leaf its (left, right) siblings by level."""
    paths, level, where = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(level) > 1:
        for k, at in enumerate(where):
            run = level[at // 3 * 3 : at // 3 * 3 + 3]
            paths[k].append(("".join(run[: at % 3]), "".join(run[at % 3 + 1 :])))
        level = [h(*level[i : i + 3]) for i in range(0, len(level), 3)]
        where = [at // 3 for at in where]
    return level[0], paths


def leaf(row):
    return h(*("-" if row[c] is None else f"{len(str(row[c]).encode())}:{row[c]}" for c in COLUMNS))


def by_hand(rows, today):
    trees = {}
    for row, now in zip(rows, today):
        trees.setdefault(row["source"], []).append((row["doc_id"] is not None, row["doc_id"] or 0, leaf(row), leaf(now), row["doc_id"]))
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    built = {s: plain_tree([x[2] for x in sorted(trees[s])]) for s in order}
    top, tops = plain_tree([built[s][0] for s in order])
    out = []
    for s, above in zip(order, tops):
        subroot, paths = built[s]
        for (_, _, was, now, doc_id), path in zip(sorted(trees[s]), paths):
            sides = path + above
            folded = now
            for left, right in sides:
                folded = h(left, folded, right)
            out.append((doc_id, was, subroot, top, h(*(x for side in sides for x in side)), folded, folded == top))
    return sorted(out, key=str)


def shown(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 28, BLOCK, BLOCK + 1, 3 * BLOCK + 2])
def test_growing_tree_equals_the_plain_one(n):
    leaves = [h(str(k)) for k in range(n)]
    tree = GrowingTree()
    for x in leaves:
        tree.append(x)
    root, paths = plain_tree(leaves)
    assert tree.close() == root
    for k in range(n):
        left, right = tree.witness(k)
        assert list(zip(left, right)) == paths[k] and fold(leaves[k], left, right) == root


def test_manifest_equals_plain_trees(spark):
    rng = random.Random(5)
    sizes = {"a": 1, "ß": 2, "z": 3 * BLOCK + 7, None: 5, "": 4, "B": BLOCK, "C": 30}
    rows = []
    for source, n in sizes.items():
        for _ in range(n):
            k = len(rows)
            rows.append({"doc_id": k * 7 % 5003, "source": source, "lang": rng.choice(["en", None]), "n_chars": rng.choice([None, k]),
                         "text": rng.choice([None, "", "one\ntwo é", "plain"])})
    hit = [crc32(str(r["doc_id"]).encode()) % 2 == 0 for r in rows]
    today = [{**r, "text": r["text"].replace("\n", "")} if x and r["text"] else r for r, x in zip(rows, hit)]
    docs = spark.createDataFrame([tuple(r[c] for c in COLUMNS) for r in rows], "doc_id long, source string, lang string, n_chars long, text string").repartition(7)
    now = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    found = shown(merkle_manifest(docs, now={"text": now}))
    assert found == by_hand(rows, today)
    assert 0 < sum(not r[-1] for r in found) < len(rows)


def test_edges(spark, edge_docs, no_docs):
    columns = ("doc_id", "source", "lang", "text")
    found = merkle_manifest(edge_docs, columns, witnesses=True)
    rows = found.collect()
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "left", "right", "proof_sha256", "folded_root", "verified"]
    assert len(rows) == edge_docs.count() and all(r.verified for r in rows) and len({r.root for r in rows}) == 1
    assert all(fold(r.leaf, r.left, r.right) == r.root for r in rows)
    same = [r for r in rows if r.doc_id == 5]
    assert len(same) == 2 and same[0].leaf == same[1].leaf and same[0].proof_sha256 != same[1].proof_sha256 or same[0].subroot
    assert merkle_manifest(no_docs, columns).count() == 0
    one = merkle_manifest(edge_docs.filter("doc_id = 9"), columns).collect()[0]
    assert one.leaf == one.subroot == one.root == one.folded_root and one.proof_sha256 == h("")


def test_a_changed_value_is_noticed(spark, edge_docs):
    columns = ("doc_id", "source", "lang", "text")
    changed = F.when(F.col("doc_id") == 2, F.lit(None)).otherwise(F.col("text"))  # an empty text is not a missing one
    rows = merkle_manifest(edge_docs, columns, now={"text": changed}).collect()
    assert {r.doc_id for r in rows if not r.verified} == {2}
