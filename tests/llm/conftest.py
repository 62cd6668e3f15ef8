import pytest
from pyspark.sql import functions as F

LONG = " ".join(f"word{i % 977} of{i}" for i in range(30_000))


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls in every column, empty, blank, short and very long texts, ties, repeated rows and columns with
    names that operators use themselves."""
    rows = [
        (1, "alpha beta gamma delta epsilon zeta eta theta", "en", "a", 45),
        (2, "alpha beta gamma delta epsilon zeta eta theta", "en", "a", 45),
        (2, "alpha beta gamma delta epsilon zeta eta theta", "en", "a", 45),
        (3, None, None, None, None),
        (4, "", "en", "b", 0),
        (5, " \n\t ", "en", "b", 4),
        (6, "two words", "en", None, 9),
        (7, LONG, "en", "a", len(LONG)),
        (8, "Ümläut 漢字 😀 text\nsecond line.\n\nthird", "de", "c", None),
        (None, "a row without id that is long enough to count", "en", "a", 45),
        (None, None, None, None, None),
    ]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for c in ("score", "label", "ids", "digest", "_key", "copy", "removed", "part", "class", "rank", "keys", "start"):
        df = df.withColumn(c, F.lit("clash"))
    return df


@pytest.fixture(scope="session")
def long_text():
    return LONG


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
