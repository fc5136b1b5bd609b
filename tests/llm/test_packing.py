import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerlake.llm.packing import _word_ids, best_fit_plan, pack_documents
from ledgerlake.llm.queries import QUERIES, TOKENIZER


def one_by_one(lengths, capacity):
    bins = []
    for n in sorted(lengths, reverse=True):
        fits = [b for b in bins if b[0] >= n]
        best = min(fits) if fits else None
        if best is None:
            bins.append([capacity - n])
        else:
            best[0] -= n
    return sorted(b[0] for b in bins)


@settings(max_examples=80, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 60), max_size=12), st.integers(40, 50))
def test_plan_equals_placing_one_by_one(counts, capacity):
    plan = best_fit_plan(counts, capacity)
    used: dict[int, list] = {}
    rows = {n: plan[plan[:, 0] == n] for n in counts}
    for n, c in counts.items():
        for j in range(c):
            _, piece, first, each, offset = rows[n][rows[n][:, 1] <= j][-1]
            used.setdefault(first + (j - piece) // each, []).append((offset + (j - piece) % each * n, n))
    for places in used.values():  # gapless from 0
        places.sort()
        assert places[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(places, places[1:]))
    left = sorted(capacity - sum(n for _, n in places) for places in used.values())
    assert left == one_by_one([n for n, c in counts.items() for _ in range(c)], capacity)


def test_word_ids_are_the_tokenizer_s():
    texts = ["", " a\x1cb ", "Don't İstanbul it's 's'", "x\u00a0y\u2003z", "e\u0301 É ÉCOLE!!", "<|endoftext|> <|ENDOFTEXT|>", "ab.cd, ,,. ...", "日本 ｶﾞ", "a" * 500]
    plain = Tokenizer.from_file(TOKENIZER)
    for text, ids in zip(texts, _word_ids(TOKENIZER)([t.encode() for t in texts])):
        assert np.frombuffer(ids, "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, text


def test_round_trip(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    plain, found = Tokenizer.from_file(TOKENIZER), {}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = pack_documents(docs, TOKENIZER, capacity=512).collect()
    for r in sorted(rows, key=lambda r: (r.doc_id, r.piece)):
        ids = found.setdefault(r.doc_id, [])
        assert r.start == len(ids) and r.ids_crc32 == zlib.crc32(r.ids) and r.length == len(r.ids) // 4 <= 512
        ids += np.frombuffer(r.ids, "<u4").tolist()
    for doc_id, text in texts.items():
        assert found[doc_id] == [*plain.encode(text, add_special_tokens=False).ids, 1]
    assert len({r.sequence_id for r in rows}) == len(one_by_one([r.length for r in rows], 512))


def test_query_and_edges(spark, sf_dir, edge_docs, no_docs):
    rows = QUERIES["op9_packing"](spark, sf_dir).collect()
    assert all(r.offset + r.length <= 4096 for r in rows)
    rows = pack_documents(edge_docs, TOKENIZER, capacity=4096).collect()
    assert sorted(r.length for r in rows if r.doc_id in (1, 2, 3)) == [1, 1, 1]
    assert len([r for r in rows if r.doc_id == 5]) == 2 and len([r for r in rows if r.doc_id is None]) == 2
    assert {r.length for r in rows if r.doc_id == 4 and r.piece < max(x.piece for x in rows if x.doc_id == 4)} == {4096}
    assert pack_documents(no_docs, TOKENIZER).count() == 0
