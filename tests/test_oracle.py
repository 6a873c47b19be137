"""Every registered query against its DuckDB oracle (row count, column
names and an order-insensitive value hash), on the small scale factor."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from oracle import compare, duck, explain_mismatch, type_families

QUERIES = entry.queries()
ORACLE = entry.oracle_sql()


def test_every_query_has_an_oracle():
    from tidemark.plans import registry

    assert set(registry.REGISTRY) == set(registry.ORACLE)
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, sf_small, name):
    built = QUERIES[name](spark, sf_small)
    s, d, s_full, d_full = compare(spark, sf_small, lambda *_: built, ORACLE[name])
    if s != d:
        cols, only_s, only_d = explain_mismatch(s_full, d_full)
        pytest.fail(f"{name}: spark={s[:2]} duck={d[:2]}\ncols={cols}\nspark-only={only_s}\nduck-only={only_d}")
    assert type_families(built.schema, duck(sf_small).sql(ORACLE[name])) == {}, name


def test_entry_smoke(spark):
    df = entry.entry(spark)
    first = df.schema
    assert df.count() >= 0
    assert entry.entry(spark).schema == first
