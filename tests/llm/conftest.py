import pytest

#: doc_id null, text null, empty, blank, long, repeated rows, ties, and columns whose names clash with results.
EXTRA = "doc_id long, text string, lang string, source string, n_chars long, score double, size long, fp string, target double, rank int"


@pytest.fixture(scope="session")
def odd_docs(spark):
    long = " ".join(f"Wort{i % 997} und" for i in range(30_000))
    plain = "The quick brown fox jumps over the lazy dog. It was a fine day, and the birds were singing in the trees."
    rows = [(1, plain), (1, plain), (2, None), (3, ""), (4, " \t\n "), (5, long), (None, plain), (6, "x"), (7, "12345 !!! ???"), (8, "Zu Hause ist es am besten, sagt die alte Frau und lacht."), (9, "Zu Hause ist es am besten, sagt die alte Frau und lacht.")]
    full = [(i, t, ("de" if t and t[0] in "ZW" else "en") if t else None, (None, "a", "b")[k % 3], len(t or ""), 0.5, 7, "fp", 1.0, 3) for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, EXTRA)


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
