import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark):
    """Builds a documents table from (doc_id, text) or (doc_id, text, lang)."""
    def build(rows):
        full = [(i, t, lang[0] if lang else "en", "s", None if t is None else len(t))
                for i, t, *lang in rows]
        return spark.createDataFrame(full, SCHEMA)
    return build


LONG = " ".join(f"w{i * 7919 % 4001}" for i in range(60_000))


@pytest.fixture(scope="session")
def odd(spark, docs):
    """Nulls in every column, blank and very long texts, repeated rows, and extra columns that
    are called like results."""
    rows = docs([(1, None), (2, ""), (3, " \n\t"), (4, "a"), (5, LONG), (6, LONG), (7, "***"),
                 (8, "Hello there"), (8, "Hello there"), (None, "Hello there, null id"),
                 (None, None), (9, "日本語 текст été")])
    nulls = spark.createDataFrame([(None, None, None, None, None)], SCHEMA)
    return rows.union(nulls).selectExpr(
        "*", "1 AS score", "'x' AS fp", "2 AS shard", "true AS kept", "'y' AS held_out",
        "'z' AS lang_pred", "3 AS n_words", "'q' AS ids", "4 AS size", "5 AS row")


@pytest.fixture(scope="session")
def none(docs):
    return docs([])


@pytest.fixture
def rng():
    return random.Random(7)
