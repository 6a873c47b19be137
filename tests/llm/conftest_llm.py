"""Plain helpers of the tests in this folder."""

from __future__ import annotations


def texts_of(spark, sf_dir: str) -> list[str]:
    return [r[0] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
