import random

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Columns that clash with names used inside the operators.
CLASHING = ["_row", "_s", "_id", "_h", "_n", "_b", "_t", "key", "tie", "part", "guest", "class", "prefix", "n", "slot", "place", "band", "_lang", "declared", "host", "y", "stats", "_leaking", "_drop", "item_id"]


def odd_rows():
    """Nulls in every column, empty and very long texts, ties, repeated rows, equal keys."""
    rng = random.Random(11)
    words = ["alpha", "beta", "gamma", "delta", "épsilon", "zeta", "ñu", "theta", "iota", "kappa", "lambda", "mu"]
    text = lambda n: " ".join(rng.choice(words) + str(rng.randrange(9)) for _ in range(n))
    long_ = text(30_000)
    one = text(60)
    rows = [
        (1, one, "en", "a", 5), (2, one, "en", "a", 5), (3, one + " more", "en", "b", 6), (4, None, "en", "a", 0),
        (5, "", "fr", "a", 0), (6, "   \n\t", None, None, 5), (7, long_, "de", "a", 9), (8, long_[:-7], "de", "a", 9), (None, one, "en", "a", 1),
        (9, text(40), None, "c", None), (10, "x", "es", "c", 1), (11, "a" * 700, "es", "c", 700), (12, "\U0001f600 é́ ß <|endoftext|> don't A.B,C!!", "de", "a", 9),
        (12, "\U0001f600 é́ ß <|endoftext|> don't A.B,C!!", "de", "a", 9), (13, text(50), "en", "a", 1), (13, text(20), "en", "a", 1), (None, None, None, None, None),
    ]
    return rows + [(100 + i, text(rng.randrange(1, 90)), rng.choice(["en", "fr"]), rng.choice(["a", "a", "b"]), 1) for i in range(30)]


@pytest.fixture(scope="session")
def odd(spark):
    """The odd rows, with further columns whose names clash."""
    df = spark.createDataFrame(odd_rows(), DOCS).repartition(3)
    for c in CLASHING:
        df = df.selectExpr("*", f"'{c}' AS `{c}`")
    return df.cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(i, i % 2, (i // 2) % 2) for i in range(1, 14)] + [(1, None, None), (None, 1, 1), (2, 1, 0), (2, 0, 1), (999, 1, 1)]
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
