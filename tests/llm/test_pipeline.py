"""The corpus pipeline's stages, each against a plain check on its own input."""

from __future__ import annotations

import os

import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from test_corpus_operators import brute_components, brute_contamination, brute_fingerprint, check_packing


@pytest.fixture(scope="module")
def stages(spark, sf_small, tmp_path_factory):
    folder = tmp_path_factory.mktemp("pipeline")
    docs = [spark.read.parquet(f"{sf_small}/documents.parquet")]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs[-1], sf_small).write.parquet(f"{folder}/{k}")
        docs.append(spark.read.parquet(f"{folder}/{k}"))
    return docs


def test_columns_stay(stages):
    assert all(d.dtypes == stages[0].dtypes for d in stages[1:-1])


def test_rules_keep_clean_documents(spark, sf_small, stages):
    labels = spark.read.parquet(f"{sf_small}/labels.parquet")
    gone = stages[0].join(stages[1], "doc_id", "left_anti").join(labels, "doc_id")
    assert gone.where("quality = 1 and size(split(trim(text), '\\\\s+')) >= 10").where(
        "text not rlike '(?s)(\\\\S+ \\\\S+ \\\\S+ \\\\S+ \\\\S+).*\\\\1'").count() == 0
    assert gone.where("quality = 0").count() > 0


def test_one_of_each_group_stays(stages):
    before = {r["doc_id"]: brute_fingerprint(r["text"]) for r in stages[1].collect()}
    roots = brute_components(list(before.values()))
    low: dict = {}
    for i, p in before.items():
        low[roots[p]] = min(i, low.get(roots[p], i))
    assert sorted(r["doc_id"] for r in stages[2].collect()) == sorted(low.values())


def test_contaminated_go(spark, sf_small, stages):
    items = [tuple(r) for r in spark.read.parquet(f"{sf_small}/benchmark.parquet").select("item_id", "text").collect()]
    bad = brute_contamination([(r["doc_id"], r["text"]) for r in stages[2].collect()], items)
    assert sorted(r["doc_id"] for r in stages[3].collect()) == sorted(i for i, v in bad.items() if not v[4])


def test_secrets_are_masked_and_nothing_else_changes(stages):
    secret = "AKIA[A-Z0-9]{16}|password=[0-9a-f]{18}|token = \"[0-9a-f]{40}\""
    assert stages[4].count() == stages[3].count()
    assert stages[4].where(F.col("text").rlike(secret)).count() == 0
    both = stages[3].alias("a").join(stages[4].alias("b"), "doc_id")
    assert both.where("a.text <> b.text").where(~F.col("a.text").rlike(secret)).count() == 0
    assert stages[4].where("n_chars <> length(text)").count() == stages[3].where("n_chars <> length(text)").count()


def test_packed_pieces(stages):
    rows = stages[5].toPandas()
    check_packing(rows, 2048)
    assert set(rows["doc_id"]) == {r["doc_id"] for r in stages[4].collect()}


def test_run_and_odd_rows(spark, sf_small, stages, odd, none):
    out = corpus_pipeline.run(spark, sf_small)
    assert out.count() == stages[5].count()
    folders = {os.path.dirname(os.path.dirname(f)) for f in out.inputFiles()}
    own = [os.listdir(f.removeprefix("file://")) for f in folders]
    assert own == [["4-best_fit_packing"]]  # its predecessors' copies are gone
    for docs in (odd, none):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, docs, sf_small).columns == docs.columns
