"""Build the marts in dependency order, each written as a table with its
layout, downstream models reading the written upstream tables (IO2, IO10,
IO12) — the way the source project materialises its models.

Dependency spine: banned users -> finished coupons -> daily financial;
user attribution -> daily acquisition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans import marts
from tidemark.sources.files import held_tables, materialize, stage_table

# Clustering keys of the materialised marts.
COUPONS_CLUSTER_BY = ("gamemode", "coupon_id", "user_id", "external_match_id")
FINANCIAL_CLUSTER_BY = ("gamemode", "reference_date")


def build_financial_marts(spark: SparkSession, inputs: dict, out_dir: str, *,
                          league_since: str = "2024-01-01",
                          subscription_users_since: str = "2023-10-11") -> dict[str, str]:
    """Write ``banned_users``, ``coupons_finished`` and ``financial_daily``
    under ``out_dir``; returns the path of each. ``inputs`` holds the
    source frames by name (see :mod:`tidemark.plans.marts`). Tables between them are written to the
    shared folder and go once the mart made of them stands, so the disk holds the marts and the step at hand."""
    out = out_dir.rstrip("/")
    paths = {}
    banned = marts.banned_users(inputs["blocklist"], inputs["user_notes"], inputs["payouts"],
                                inputs["gateway_transactions"], inputs["accounts"])
    paths["banned_users"] = materialize(banned, f"{out}/banned_users")
    with held_tables(spark) as held:
        # the interleaved layout reads its rows three times (bounds, counts, rows): the joins run once
        with held_tables(spark) as part:
            coupons = held(marts.coupons_finished(
                inputs["coupons"], inputs["grouped_challenges"], spark.read.parquet(paths["banned_users"]),
                inputs["transactions"], inputs["transaction_items"], inputs["wallets"], inputs["accounts"],
                inputs["super_tips"], inputs["coupon_items"], inputs.get("reputations"), inputs.get("match_players"),
                inputs.get("players"), part), "coupons_finished")
        paths["coupons_finished"] = materialize(coupons, f"{out}/coupons_finished", cluster_by=COUPONS_CLUSTER_BY,
                                                interleave=True)
    with held_tables(spark) as held:
        financial = marts.financial_daily(
            inputs["transactions_finished"], spark.read.parquet(paths["coupons_finished"]), inputs["league_points"],
            inputs["coupon_items"], inputs["challenges"], inputs["users"], league_since=league_since,
            subscription_users_since=subscription_users_since,
            staged=lambda rows: held(rows, "ledger_rows", ["feed"]),
            staged_modes=lambda modes: held(modes, "league_modes"))
        paths["financial_daily"] = materialize(financial, f"{out}/financial_daily", cluster_by=FINANCIAL_CLUSTER_BY)
    return paths


def build_attribution_marts(spark: SparkSession, inputs: dict, out_dir: str, as_of, spine: DataFrame,
                            ads_cost: DataFrame) -> dict[str, str]:
    """Write ``user_attribution`` then ``acquisition_daily`` (which reads the
    written attribution table)."""
    out = out_dir.rstrip("/")
    paths = {}
    att = marts.user_attribution(**inputs, as_of=as_of, staged=lambda act: stage_table(act, "attribution_base"))
    paths["user_attribution"] = materialize(att, f"{out}/user_attribution", cluster_by=("created_at",))
    acq = marts.acquisition_daily(spark.read.parquet(paths["user_attribution"]), ads_cost, spine)
    paths["acquisition_daily"] = materialize(acq, f"{out}/acquisition_daily", cluster_by=("_date",))
    return paths
