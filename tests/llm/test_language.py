from collections import Counter
import zlib

import numpy as np

from halyard.llm import language as L


def brute_grams(text):
    """n-grams of one to three letters, by plain loops."""
    line = " " + "".join(c if c.isalpha() else " " for c in text.lower()) + " "
    while "  " in line:
        line = line.replace("  ", " ")
    if not line.strip():
        return Counter()
    out = Counter(c for c in line if c != " ")
    out.update(line[i : i + 2] for i in range(len(line) - 1))
    out.update(line[i : i + 3] for i in range(len(line) - 2) if line[i + 1] != " ")
    return out


def name(key):
    return "".join("" if (c := key >> s & (1 << 21) - 1) == 0 else chr(c) for s in (42, 21, 0))


def test_counts_against_loops():
    for text in ("", "12 !?", "a", "Hello, world", "été ÉTÉ 中文 \U0001d400x", "x" * 50, "a b " * 400, "İstanbul ǆ ß"):
        keys, counts = L.gram_counts(text)
        assert dict(zip(map(name, keys.tolist()), counts.tolist(), strict=True)) == brute_grams(text)
        assert (np.diff(keys) > 0).all()


def test_long_texts_are_counted_in_parts(monkeypatch):
    texts = ["der Hund und die Katze, " * 30, "x" * 500, "ab1 " * 50 + "!" * 40 + " yz", "  " * 30 + "ends here" + " " * 30, "ΟΔΥΣΣΕΥΣ ΟΔΟΣ " * 9, "!" * 100]
    want = [L.gram_counts(t) for t in texts]
    for part in (1, 2, 7, 10):
        monkeypatch.setattr(L, "PART", part)
        for t, w in zip(texts, want, strict=True):
            got = L.gram_counts(t)
            assert all(np.array_equal(a, b) for a, b in zip(got, w, strict=True))
            assert dict(zip(map(name, got[0].tolist()), got[1].tolist(), strict=True)) == brute_grams(t)


def test_more_languages_than_a_task_holds(documents, monkeypatch):
    want = sorted(map(tuple, L.identify(documents, 100).collect()))
    kept = sorted(r.doc_id for r in L.keep_identified(documents, 100).collect())
    monkeypatch.setattr(L, "MAX_LANGUAGES", 2)
    assert len(L.learn(documents, 100)) > 1
    assert sorted(map(tuple, L.identify(documents, 100).collect())) == want
    assert sorted(r.doc_id for r in L.keep_identified(documents, 100).collect()) == kept


def brute_profiles(rows, size):
    total = {}
    for text, lang in rows:
        total.setdefault(lang, Counter()).update(brute_grams(text))
    rank = lambda c: sorted(c, key=lambda g: (-c[g], [0] * (3 - len(g)) + [ord(x) for x in g]))
    return {k: {g: i for i, g in enumerate(rank(c)[:size])} for k, c in sorted(total.items())}, rank


def test_predictions_against_brute_force(spark, documents):
    rows = documents.collect()
    held = {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in rows}
    # Words are counted by document: no n-gram spans two.
    profiles, rank = brute_profiles([(r.text, r.lang) for r in rows if not held[r.doc_id] and r.lang and r.text], 100)
    got = {r.doc_id: r for r in L.identify(documents, 100).collect()}
    assert {d: r.held_out for d, r in got.items()} == held
    for r in rows[:60]:
        top = rank(brute_grams(r.text))[:100]
        far = {k: sum(abs(p[g] - i) if g in p else 100 for i, g in enumerate(top)) for k, p in profiles.items()}
        best = min(far, key=lambda k: (far[k], k))
        assert got[r.doc_id].lang_pred == best
        assert abs(got[r.doc_id].score - (1 - far[best] / (100 * len(top)))) < 1e-12
    right = [got[r.doc_id].lang_pred == r.lang for r in rows if held[r.doc_id]]
    assert sum(right) / len(right) > 0.95


def test_odd_documents(spark, odd_docs):
    got = sorted(map(tuple, L.identify(odd_docs).collect()), key=str)
    assert len(got) == odd_docs.count()
    by = {r[0]: r for r in got}
    assert all(by[i][2:] == ("und", 0.0) for i in (2, 3, 4, 7))
    assert by[8][2:] == by[9][2:] and by[None][1] is False and 0 < by[5][3] <= 1
    assert L.identify(odd_docs.limit(0)).count() == 0
    assert {r.lang_pred for r in L.identify(odd_docs.withColumn("lang", odd_docs.lang.substr(9, 1).try_cast("int").cast("string"))).collect()} == {"und"}


def test_prediction_sees_only_the_text(spark, documents):
    a = {r.doc_id: (r.lang_pred, r.score) for r in L.identify(documents).collect()}
    other = documents.selectExpr("doc_id", "text", "CASE WHEN crc32(CAST(doc_id AS STRING)) % 4 = 2 THEN 'xx' ELSE lang END AS lang", "source")
    assert a == {r.doc_id: (r.lang_pred, r.score) for r in L.identify(other).collect()}


def test_stage_keeps_clean_documents(spark, documents):
    kept = L.keep_identified(documents)
    assert kept.columns == documents.columns and kept.count() >= 0.99 * documents.count()
    wrong = documents.limit(1).selectExpr("doc_id + 1000000 AS doc_id", "text", "CASE lang WHEN 'en' THEN 'fr' ELSE 'en' END AS lang", "source", "n_chars")
    none = documents.limit(1).selectExpr("doc_id + 2000000 AS doc_id", "'123 !!' AS text", "lang", "source", "n_chars")
    assert L.keep_identified(documents.union(wrong).union(none)).filter("doc_id >= 1000000").isEmpty()


def test_stage_rejects_texts_in_no_learned_language(spark, documents):
    texts = [
        "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью.",
        "人人生而自由在尊严和权利上一律平等",
        "Привет",
        "xqzv kjwq zzxk qvjh wkpt xgfd bqnz jjkq vwxz qpzk tgbx kkqj",
        "Sva ljudska bića rađaju se slobodna i jednaka u dostojanstvu i pravima. Ona su obdarena razumom i sviješću i trebaju jedna prema drugima postupati u duhu bratstva.",
    ]
    rows = [(1_000_000 + 10 * i + k, t, lang, "s", len(t)) for i, t in enumerate(texts) for k, lang in enumerate((None, "en"))]
    short = documents.filter("lang IS NOT NULL AND size(split(text, ' ')) > 40").limit(20).selectExpr("doc_id + 2000000 AS doc_id", "array_join(slice(split(text, ' '), 1, 12), ' ') AS text", "IF(doc_id % 2 = 0, NULL, lang) AS lang", "source", "n_chars")
    n = short.count()
    kept = L.keep_identified(documents.union(spark.createDataFrame(rows, documents.schema)).union(short))
    assert kept.filter("doc_id BETWEEN 1000000 AND 1999999").isEmpty()
    assert kept.filter("doc_id >= 2000000").count() >= n - 1
    assert kept.filter("doc_id < 1000000").count() >= 0.99 * documents.count()
