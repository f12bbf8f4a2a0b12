import hashlib

import numpy as np

from halyard.llm import fingerprint as K


def brute(rows):
    """(doc_id, edited text, next text) by one global sort."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    out = []
    for i, (d, t) in enumerate(order):
        n = order[(i + 1) % len(order)][1]
        half = len(t) // 2
        out.append((d, t, t[: len(t) - half] + n[:half], n))
    return out


def brute_sketch(text):
    """Hashes below an eighth of the space, with plain numbers and sets; else the smallest."""
    top = 1 << 64
    words = (text or "").encode().translate(bytes(c + 32 if 65 <= c <= 90 else c for c in range(256)))
    words = [w for w in words.translate(bytes(32 if c in b"\t\n\v\f\r" else c for c in range(256))).split(b" ") if w]
    number = [int.from_bytes(hashlib.blake2b(w, digest_size=8).digest(), "little") for w in words]
    out = set()
    for i in range(max(1, len(words) - 4) if words else 0):
        h, own = 0, number[i : i + 5]
        for x in own:
            h = (h * 0x9E3779B97F4A7C15 + x) % top
        h = (h + len(own)) % top
        h = (h ^ h >> 30) * 0xBF58476D1CE4E5B9 % top
        h = (h ^ h >> 27) * 0x94D049BB133111EB % top
        out.add(h ^ h >> 31)
    kept = {h for h in out if h < top // 8}
    return kept or {min(out)} if out else set()


def brute_likeness(a, b):
    x, y = ({h for h in s if h < (1 << 64) // 8} for s in (a, b))
    return len(x & y) / len(x | y) if x | y else float(a == b)


def check(docs, **kw):
    rows = [(r.doc_id, r.text or "") for r in docs.collect()]
    got = sorted((r for r in K.fingerprints(docs, **kw).collect()), key=lambda r: str((r.doc_id, r.n_chars, r.edited_sha256)))
    want = sorted(brute(rows), key=lambda x: str((x[0], len(x[1]), hashlib.sha256(x[2].encode()).hexdigest())))
    assert len(got) == len(want)
    for r, (d, t, e, n) in zip(got, want, strict=True):
        s, se, sn = (brute_sketch(x) for x in (t, e, n))
        text = lambda hashes: "".join(f"{h:016x}" for h in sorted(hashes))
        assert (r.doc_id, r.n_chars, r.edited_sha256) == (d, len(t), hashlib.sha256(e.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (text(s), text(se))
        assert (r.near_edited, r.near_next) == (brute_likeness(s, se), brute_likeness(s, sn))
        assert 0 <= r.near_edited <= 1 and 0 <= r.contained_next <= 1


def test_query_against_a_global_sort(documents):
    check(documents)
    check(documents.repartition(3), buckets=2)


def test_odd_documents(odd_docs):
    check(odd_docs)
    check(odd_docs.filter("doc_id = 8"))
    check(odd_docs.filter("doc_id IS NULL"))
    assert K.fingerprints(odd_docs.limit(0)).count() == 0


def test_estimates():
    rng = np.random.default_rng(1)
    a = [f"w{x}" for x in rng.integers(0, 10**6, 4000)]
    b = a[:2000] + [f"v{x}" for x in rng.integers(0, 10**6, 2000)]
    sa, sb, small = (K.sketch(K.shingle_hashes(" ".join(x))) for x in (a, b, a[:200]))
    assert abs(K.compare(sa, sb)[0] - 1 / 3) < 0.08
    near, of_a, of_small = K.compare(sa, small)
    assert of_small > 0.9 and near < 0.15  # all of the short text is in the long one
    whole = K.sketch(np.union1d(K.shingle_hashes(" ".join(a)), K.shingle_hashes(" ".join(b))))
    assert np.array_equal(K.merge(sa, sb), whole) and np.array_equal(K.decode(K.encode(sa)), sa)
    short = [K.sketch(K.shingle_hashes(f"only {i}")) for i in range(60)]
    assert all(len(x) == 1 and K.compare(x, x)[0] == 1 for x in short) and all(K.compare(x, y)[0] == 0 for x in short for y in short if x is not y)
    assert np.array_equal(K.merge(short[0], sa), K.sketch(np.union1d(short[0], sa)))
    empty = K.sketch(K.shingle_hashes(""))
    assert K.compare(empty, empty)[0] == 1 and K.compare(empty, sa)[0] == 0
    assert K.encode(K.sketch(K.shingle_hashes("A b  c"))) == K.encode(K.sketch(K.shingle_hashes("a B\nC")))
