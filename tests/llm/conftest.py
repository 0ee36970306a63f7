import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def corpus(spark, data):
    return spark.read.parquet(f"{data}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows."""
    long = " ".join(f"word{i % 977}x{i % 13}" for i in range(30_000)) + "\n" + "q" * 70_000
    rows = [
        (1, "alpha beta gamma delta epsilon zeta eta", "en", "a", 39), (1, "alpha beta gamma delta epsilon zeta eta", "en", "a", 39),
        (2, "Alpha BETA gamma\tdelta  epsilon zeta eta", "en", None, 40), (3, "", None, "b", 0), (4, None, "en", "b", None),
        (None, "no id here at all", None, None, 17), (None, None, None, None, None), (5, " \n\t ", "de", "c", 4),
        (6, long, "en", "a", len(long)), (7, "eins\nzwei\ndrei", "de", "c", 14), (8, "drei\neins\nzwei", "de", "c", 14),
        (9, "123 !!! ...", "de", "b", 11), (10, "no spaces", "en", "a", 9), (10, "other text", "en", "a", 10),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def clashing(odd):
    """The same table with extra columns named like the operators' own."""
    from pyspark.sql import functions as F

    names = ["node", "col", "comp", "part", "_at", "_part", "size", "slot", "_key", "n", "score", "hash", "shard", "src"]
    return odd.select("*", *[F.lit(7).alias(x) for x in names])
