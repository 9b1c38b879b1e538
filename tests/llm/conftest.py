import pytest

#: Column names that the operators use within themselves.
CLASHING = ("keep_id", "salt", "body", "digest", "fp", "chunk", "rest", "ids", "n_symbols", "N_removed", "component_id", "score", "held_out", "gone_id", "sampled_id", "piece", "hit_spans", "label", "node", "spans")
LONG = " ".join(f"w{k % 977}" for k in range(60_000))
TEXTS = [
    (1, "One two three.\nFour five six.\nSeven eight nine.\nTen eleven twelve."),
    (2, "One two three.\nFour five six.\nSeven eight nine.\nTen eleven twelve."),
    (3, "One  two\tthree.\nFour five six.\nSeven eight nine.\nTen eleven twelve."),
    (4, ""),
    (5, None),
    (6, " \n\t\x0b "),
    (7, LONG),
    (8, "mail a@b.example.com or +1 (234) 555-6789 from 10.0.0.1, card 4111 1111 1111 1111"),
    (None, "no id at all"),
    (None, None),
    (9, "ÀÉÎ ñandú 日本語 test"),
    (9, "ÀÉÎ ñandú 日本語 test"),
    (10, "JUNK!! JUNK!! JUNK!!\nJUNK!! JUNK!! JUNK!!"),
    (11, LONG + " tail"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in any column, empty and very long texts, ties, repeated rows, clashing names."""
    rows = [(i, t, None if k % 3 else "en", None if k % 4 else "s", None if k % 2 else len(t or ""), *("x" if (k + j) % 2 else None for j in range(len(CLASHING)))) for k, (i, t) in enumerate(TEXTS)]
    names = ", ".join(f"{c} string" for c in CLASHING)
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {names}").repartition(3)


@pytest.fixture(scope="session")
def empty(odd):
    return odd.where("false")


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(4)


@pytest.fixture(scope="session")
def texts(docs):
    return {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
