import os
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

LONG = "once upon a time there was a very long tale " * 3000
# (doc_id, text): nulls, empty, blank, very long, ties, repeats, other scripts.
EDGE = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "one"),
    (5, "One two"),
    (6, LONG),
    (7, LONG + "indeed"),
    (8, "The quick brown fox jumps over the lazy dog, again and again."),
    (9, "the QUICK brown fox jumps over the lazy dog, again and again."),
    (9, "the QUICK brown fox jumps over the lazy dog, again and again."),
    (10, "日本語 のテキスト　全角\x1cspace\x85x  \n\nÉté ñandú <|endoftext|> it's 'tis \U0001f600"),
    (None, "a row without an id that nobody can name"),
    (None, "a row without an id that nobody can name"),
    (11, "x" * 5000),
    (12, "é combining İ and İstanbul ẞ Ω ﬁ"),
]


def frame(spark, rows, **clashing):
    """Documents with extra columns whose names clash with the operators' own."""
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for name in ("id", "size", "fp", "score", "start", "part", "key", "range", "n", "label", "bin"):
        df = df.withColumn(name, F.lit("clash"))
    return df


@pytest.fixture(scope="session")
def edge(spark):
    return frame(spark, EDGE).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return frame(spark, [])


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def rows(docs):
    return [(r[0], r[1]) for r in docs.select("doc_id", "text").collect()]
