import collections

import pytest

from halyard.llm import sharding as S


def test_table_is_balanced_and_moves_little():
    names = [f"s{i}" for i in range(20)]
    a = S.lookup_table(names, 4099)
    counts = collections.Counter(a)
    assert len(counts) == 20 and max(counts.values()) - min(counts.values()) <= 1
    b = S.lookup_table(names[:-1], 4099)
    moved = sum(x != y for x, y in zip(a, b, strict=True) if x != 19)
    assert moved < 0.1 * 4099
    for bad in (([], 5), (["a", "a"], 5), (["a"], 6), (["a", "b", "c"], 2)):
        with pytest.raises(ValueError):
            S.lookup_table(*bad)


def brute(names, size):
    import hashlib

    order = []
    for n in names:
        d = hashlib.sha256(n.encode()).digest()
        o, k = int.from_bytes(d[:8], "big") % size, int.from_bytes(d[8:16], "big") % (size - 1) + 1
        order.append([(o + j * k) % size for j in range(size)])
    owner, turn = {}, 0
    while len(owner) < size:
        s = turn % len(names)
        owner[next(x for x in order[s] if x not in owner)] = s
        turn += 1
    return [owner[i] for i in range(size)]


def test_table_against_brute_force():
    names = [f"shard-{i}" for i in range(5)]
    assert S.lookup_table(names, 211) == brute(names, 211)


def test_rows(spark, odd_docs):
    docs = odd_docs.withColumnRenamed("rank", "slot").withColumnRenamed("size", "shard").withColumnRenamed("fp", "a.b").withColumnRenamed("score", "_place")
    out = S.assign_shards(docs, "doc_id", ["a", "b", "c"], 101)
    assert out.count() == docs.count() and out.columns.count("slot") == 1
    assert {"a.b", "_place"} < set(out.columns) and {r["a.b"] for r in out.collect()} == {"fp"}
    by = collections.defaultdict(set)
    for r in out.collect():
        by[r.doc_id].add((r.slot, r.shard))
    assert all(len(v) == 1 for v in by.values()) and None in by
    assert S.assign_shards(docs.limit(0), "doc_id").count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Cartesian" not in plan
