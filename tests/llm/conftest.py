from __future__ import annotations

import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def small(spark, sf_small):
    """The documents of the small scale factor."""
    return spark.read.parquet(f"{sf_small}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and columns
    whose names clash with the operators' own."""
    long = "word " * 40_000 + "x" * 100_000
    rows = [
        (1, "the cat sat on the mat and then the dog came by to see it", "en", "a", 10),
        (1, "the cat sat on the mat and then the dog came by to see it", "en", "a", 10),
        (2, None, "en", "a", None), (3, "", "en", None, 0), (4, "   \n\t ", None, "a", 5),
        (None, "der hund und die katze sind nicht im haus mit dem mann", "de", "a", 3),
        (None, "der hund und die katze sind nicht im haus mit dem mann", "de", "a", 3),
        (5, long, "en", "b", len(long)), (6, "1234 !!! ... ###", None, None, 1),
        (7, "the cat sat on the mat and then the dog came by to see it", "en", "b", 10),
        (8, "ñandú çà é à \U0001F600 über straße", "es", "b", 8),
    ]
    extra = {n: F.lit("clash") for n in ("fp", "key", "x", "n", "label", "score", "text_hash", "hash", "w", "word",
                                         "uid", "part", "kept", "hot", "redacted", "rules_kept", "learn",
                                         "raw_", "gaps_", "hit_id_", "hit_key_", "hit_spans", "text_hash")}
    return spark.createDataFrame(rows, SCHEMA).withColumns(extra)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}
