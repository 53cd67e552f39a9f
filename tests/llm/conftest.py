import pytest

LONG = "The quick brown fox jumps over the lazy dog and runs away. " * 6000

ROWS = [
    (1, "The cat sat on the mat and looked at the rain for a long while today.", "en", "a", "x"),
    (2, None, "en", "a", "x"),
    (3, "", None, "b", "x"),
    (4, " \n\t ", "de", None, "x"),
    (None, "The cat sat on the mat and looked at the rain for a long while today.", "en", "a", None),
    (5, LONG, "en", "a", "x"),
    (6, "Repeated rows say the same thing again and again, do they not?", "en", "b", "x"),
    (6, "Repeated rows say the same thing again and again, do they not?", "en", "b", "x"),
    (7, "12 34 ... !!", None, None, None),
    (8, "one", "en", "b", "x"),
]
SCHEMA = "doc_id long, text string, lang string, source string, {}"


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls, empty, blank, very long and repeated texts, and clashing column names."""
    clashes = ["id", "key", "n", "sig", "bucket", "guest", "tokens", "probability", "weight", "comp", "component_id",
               "kept", "held", "lang_pred", "score", "a", "b", "ids", "topic", "_source", "_kept", "item_id", "n_chars"]
    schema = SCHEMA.format(", ".join(f"{c} string" for c in clashes))
    return spark.createDataFrame([(*row, *row[4:] * (len(clashes) - 1)) for row in ROWS], schema)


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def given(spark):
    return lambda name, size="sf0.001": spark.read.parquet(f"/root/testdata/{size}/{name}.parquet")
