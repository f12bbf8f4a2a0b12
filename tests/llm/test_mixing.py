import math
import re
from collections import Counter, defaultdict

from halyard.llm import mixing as M


def words(t):
    return len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


def brute_targets(sizes):
    """Water filling by rounds: a target over its cap stops there, the excess is shared again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    full, total = {}, sum(sizes.values())
    while True:
        rest, left = [s for s in names if s not in full], total - sum(full.values())
        share = {s: left * weight[s] / max(1, sum(weight[x] for x in rest)) for s in rest}
        over = [s for s in rest if share[s] > 3 * sizes[s] or 3 * sizes[s] == 0]
        if not over:
            return full | share
        full |= {s: 3.0 * sizes[s] for s in over}


def check(docs):
    rows = docs.collect()
    out = M.mixing_query(docs).collect()
    assert len(out) == len(rows)
    sizes = defaultdict(int)
    for r in rows:
        sizes[r.source] += words(r.text)
    assert Counter((r.doc_id, r.size) for r in out) == Counter((r.doc_id, words(r.text)) for r in rows)
    want, sources = brute_targets(sizes), {r.doc_id: r.source for r in rows}
    taken, largest = Counter(), Counter()
    for r in out:
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.copies * r.size
        s = sources[r.doc_id]
        if list(sources.values()).count(s) and r.doc_id is not None:
            assert math.isclose(r.target, want[s], rel_tol=1e-9, abs_tol=1e-9)
        taken[s] += r.taken
        largest[s] = max(largest[s], r.size)
    return taken, largest, want


def test_against_brute_force(documents):
    taken, largest, want = check(documents)
    for s, goal in want.items():
        assert abs(taken[s] - goal) <= largest[s] + 1
    assert sorted(map(tuple, M.mixing_query(documents).collect())) == sorted(map(tuple, M.mixing_query(documents.repartition(7)).collect()))


def test_caps_nulls_and_empty(spark):
    rows = [(i, "w " * 10, "big") for i in range(60)] + [(100, "a b c", "small"), (101, None, None), (102, "x y", None), (103, "", "none")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken, largest, want = check(docs)
    assert want["small"] == 9 and want[None] == 6 and want["none"] == 0 and taken["small"] == 9
    assert abs(taken["big"] - want["big"]) <= 10
    assert M.mixing_query(docs.limit(0)).count() == 0


def test_emit_keeps_columns(odd_docs):
    out = M.emit(M.mix(odd_docs))
    assert out.columns == odd_docs.columns
    copies = M.mix(odd_docs).groupBy("row.doc_id").sum("copies").collect()
    got = Counter(r.doc_id for r in out.collect())
    assert got == Counter({r.doc_id: r[1] for r in copies if r[1]})
