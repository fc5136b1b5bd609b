import heapq
from collections import Counter, defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlake.llm.queries import QUERIES
from ledgerlake.llm.sharding import lpt_plan, shard_documents


def by_hand(sizes, n):
    heap = [(0, k) for k in range(n)]
    for s in sorted(sizes, reverse=True):
        load, k = heapq.heappop(heap)
        heapq.heappush(heap, (load + s, k))
    return sorted(load for load, _ in heap)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 30), st.integers(1, 300)), max_size=12, unique_by=lambda x: x[0]), st.integers(1, 7))
def test_plan_equals_the_heap(sizes, n):
    loads = [0] * n
    for size, shards, ends in lpt_plan(sizes, n):
        assert (ends[-1] if ends else 0) == dict(sizes)[size]
        for k, a, b in zip(shards, [0, *ends], ends):
            loads[k] += size * (b - a)
    assert sorted(loads) == by_hand([s for s, c in sizes for _ in range(c)], n)


def test_query(spark, sf_dir):
    rows = QUERIES["op1_sharding"](spark, sf_dir).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    loads, shards, slots = Counter(), defaultdict(set), defaultdict(list)
    for r in rows:
        assert r["size"] == len(texts[r.doc_id].encode()) + 16
        loads[r.shard] += r["size"]
        shards[texts[r.doc_id]].add(r.shard)
        slots[r.shard].append(r.slot)
    assert len(rows) == len(texts) and all(len(s) == 1 for s in shards.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    groups = Counter()
    for r in rows:
        groups[texts[r.doc_id]] += r["size"]
    assert sorted(loads.values()) == [x for x in by_hand(groups.values(), 40) if x]


def test_edges(edge_docs, no_docs):
    rows = shard_documents(edge_docs, 3).collect()
    assert len(rows) == 12 and {r["size"] for r in rows if r.doc_id in (1, 2)} == {16}
    assert len({r.shard for r in rows if r["size"] == 16 + 18}) == 1
    assert shard_documents(no_docs, 3).count() == 0
