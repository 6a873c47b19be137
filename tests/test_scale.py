"""How often whole rows travel: once, where the work can be told from a few columns."""

from __future__ import annotations

import time
from collections import defaultdict
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from test_ledger import _inputs, _row

from tidemark.operators import stage
from tidemark.plans import build, marts
from tidemark.session import checkpoint_dir
from tidemark.sources import files, layout


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _same(a, b) -> bool:
    return sorted(map(str, a.select(b.columns).collect())) == sorted(map(str, b.collect()))


def _exports(spark):
    df = spark.range(6_000).select(F.when(F.col("id") % 3 > 0, F.col("id") % 400).alias("k"), (F.col("id") % 7).alias("t"),
                                   F.concat(F.lit("text "), F.col("id") % 50).alias("text"))
    return df.where("t < 4"), df.where("t >= 4")


def test_ranked_rows_travel_once(spark):
    new, old = _exports(spark)
    out = stage.unify_ranked(new, old, ["k"], "t")
    assert _plan(out).count("Exchange hashpartitioning") == 1 and "ExistingRDD" not in _plan(out)
    assert _same(out, stage.unify_ranked(new, old, ["k"], "t", skew_safe=False))


@pytest.mark.parametrize("limit", [10, 1000])
def test_hot_keys_are_ranked_by_range(spark, monkeypatch, limit):
    monkeypatch.setattr(stage, "HOT_KEY_ROWS", limit)  # all keys are hot, or the null key alone
    new, old = _exports(spark)
    out = stage.unify_ranked(new, old, ["k"], "t")
    assert "ExistingRDD" in _plan(out)
    assert _same(out, stage.unify_ranked(new, old, ["k"], "t", skew_safe=False))


@pytest.mark.parametrize("limit", ["-1", "10485760"])
def test_legacy_rows_stay_where_few_are_kept(spark, limit):
    primary = spark.createDataFrame([(1, "p"), (1, "q"), (None, "p"), (5, "p")], "k int, v string")
    legacy = spark.createDataFrame([(1, "l"), (2, "l"), (2, "l"), (3, None), (None, "l")], "k int, v string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        out = stage.unify_prefer_primary(primary, legacy, "k")
        assert ("SortMergeJoin" in _plan(out)) == (limit == "-1")
        want = [(1, "p"), (1, "q"), (None, "p"), (5, "p"), (2, "l"), (2, "l"), (3, None)]
        assert sorted(map(tuple, out.collect()), key=str) == sorted(want, key=str)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_marts_join_the_coupons_once(spark, tmp_path, monkeypatch):
    made = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def counted(x):
        made.add(1)
        return x

    rows = spark.range(500).select(F.lit("CS").alias("gamemode"), counted("id").alias("coupon_id"),
                                   (F.col("id") % 9).alias("user_id"), "id")
    rows = rows.withColumn("external_match_id", F.col("coupon_id") + 1)
    days = spark.range(3).select(F.lit("CS").alias("gamemode"), F.col("id").alias("reference_date"))
    monkeypatch.setattr(marts, "banned_users", lambda *a: spark.range(2))
    monkeypatch.setattr(marts, "coupons_finished", lambda *a: rows)
    monkeypatch.setattr(marts, "financial_daily", lambda *a, **kw: days)
    paths = build.build_financial_marts(spark, defaultdict(lambda: None), str(tmp_path))
    assert made.value == 500
    assert sorted(r["coupon_id"] for r in spark.read.parquet(paths["coupons_finished"]).collect()) == list(range(500))


def test_interleaved_rows_travel_once(spark):
    df = spark.range(2_000).select("id", (F.col("id") % 11).alias("a"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = layout.z_ordered(df, ["id", "a"], files=4)
        assert "Join" not in _plan(out) and _same(out, df)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_ledger_rows_are_not_summed_by_key(spark):
    given = _inputs(spark, [_row(1, "PAYIN", None, None, user=5), _row(2, "PAYIN", None, None, user=5),
                            _row(3, "PAYOUT", None, None, user=5)])
    plans = []

    def staged(df):
        plans.append(_plan(df))
        return df

    out = marts.financial_daily(**given, staged=staged)
    assert len(plans) == 1 and "Exchange" not in plans[0]
    got = {r["gamemode"]: (int(r["payin"]), int(r["payout"]), int(r["payin_payout_balance"])) for r in out.collect()
           if r["reference_date"] is not None and (r["payin"] or r["payout"])}
    one = got["GENERAL"]
    assert one[0] > 0 and one[1] == -one[0] // 2 and one[2] == one[0] + one[1] and set(got) > {"GENERAL"}


def _coupon_inputs(spark):
    def frame(rows, schema):
        return spark.createDataFrame(rows, schema)

    # coupon 1 stands for two users and a repeated row, match 100 has player 8 twice, 300 has a player without reputation
    coupons = [(1, 7, 5, "WON"), (1, 8, 5, "LOST"), (1, 8, 5, "LOST"), (2, 7, 6, "WON"), (3, None, 5, "WON"), (None, 7, 5, "WON"),
               (4, 7, None, "REFUND"), (5, 9, 5, "WON"), (6, 7, 5, "OPEN")]
    return dict(
        coupons=frame([(*r, 2.0, 3.0, "NORMAL", None, "x", 0) for r in coupons],
                      "coupon_id long, user_id long, grouped_challenge_id long, coupon_status string, amount double, odd double, "
                      "type string, rollover_id long, origin string, created_at long"),
        grouped_challenges=frame([(5, "five", None, "LOL"), (6, "six", "CS", "ARAM")],
                                 "grouped_challenge_id long, name string, gamemode string, external_gamemode string"),
        banned=frame([(7,)], "user_id long"), transactions=frame([(1, "COUPON", 1)], "transaction_id long, type string, coupon_id long"),
        transaction_items=frame([(1, 1, "CREDIT")], "transaction_id long, wallet_id long, status string"),
        wallets=frame([(1, 1, "BRL")], "wallet_id long, account_id long, currency string"),
        accounts=frame([(1, "PLAYER_ACCOUNT")], "account_id long, type string"), super_tips=frame([(2,)], "coupon_id long"),
        coupon_items=frame([(1, 100, 1), (1, 200, 2), (2, 100, 1), (3, 100, 1), (4, 100, 1), (5, 300, 1), (None, 100, 1)],
                           "coupon_id long, external_match_id long, created_at long"),
        reputations=frame([(70, 1.5, "a"), (80, 2.5, "b"), (81, 3.5, "c"), (81, 4.5, "d"), (None, 9.0, "z")],
                          "external_match_player_id long, max_amount double, metadata string"),
        match_players=frame([(70, 100, 17), (80, 100, 18), (81, 100, 18), (90, 300, 19), (None, 100, 17), (91, 200, 17)],
                            "external_match_player_id long, external_match_id long, external_player_id long"),
        players=frame([(17, 7, "LOL"), (18, 8, "LOL"), (19, 9, "LOL"), (20, None, "LOL")],
                      "external_player_id long, user_id long, external_gamemode string"))


def test_reputations_of_repeated_coupons(spark):
    out = marts.coupons_finished(**_coupon_inputs(spark)).select("coupon_id", "user_id", "max_amount", "reputation_metadata")
    want = [(1, 7, 1.5, "a"), (1, 7, None, None), *[(1, 8, m, r) for m, r in ((2.5, "b"), (3.5, "c"), (4.5, "d"))] * 2,
            (2, 7, None, None), (3, None, None, None), (None, 7, None, None), (4, 7, None, None), (5, 9, None, None)]
    assert sorted(map(tuple, out.collect()), key=str) == sorted(want, key=str)


def test_whole_coupons_do_not_travel_by_match(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = marts.coupons_finished(**_coupon_inputs(spark))
        text = spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
        travel = [b for b in text.split("\n\n") if ") Exchange" in b and "hashpartitioning(external_match" in b]
        assert travel and not any("origin" in b for b in travel)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_league_is_one_row_in_its_aggregate(spark):
    # 70 modes; league 1 has a repeated challenge, one without a mode, one that does not exist and a match without items
    challenges = spark.createDataFrame([(i, f"m{i:02}") for i in range(70)] + [(5, "m69"), (99, None)],
                                       "challenge_id long, external_gamemode string")
    points = [(1, "a"), (1, "b"), (1, "none"), (2, "a"), (3, None), (4, "none"), (None, "b"), (5, "c"), (6, "d")]
    items = [("a", 5), ("a", 5), ("a", 64), ("b", 0), ("b", 99), ("b", 1000), ("c", 99), ("d", None), *(("d", i) for i in range(70))]
    given = (spark.createDataFrame(points, "league_id long, external_match_id string"),
             spark.createDataFrame(items, "external_match_id string, challenge_id long"), challenges)
    got = marts._league_modes(*given)
    plain = (given[0].join(given[1], "external_match_id", "left").join(challenges, "challenge_id", "left")
             .selectExpr("league_id", "external_gamemode AS gamemode").distinct())
    assert _same(got, plain)
    want = {(1, m) for m in ("m05", "m69", "m64", "m00", None)} | {(2, m) for m in ("m05", "m69", "m64")} | {
        (3, None), (4, None), (5, None), (None, "m00"), (None, None), (6, None)} | {(6, f"m{i:02}") for i in range(70)}
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    held = [a for a in _plan(got).splitlines() if "HashAggregate(keys=[league_id" in a]
    assert held and not any("gamemode" in a for a in held)
    assert _same(marts._league_modes(*given[:2], challenges.limit(0)), given[0].selectExpr("league_id", "CAST(NULL AS STRING) AS gamemode").distinct())


def _shuffle_files(spark) -> set:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(k).getName() for k in range(files.size()))
    return {n for n in names if n.startswith("shuffle_") and n.endswith(".data")}


def test_marts_leave_only_themselves_on_disk(spark, tmp_path, monkeypatch):
    given = _coupon_inputs(spark) | {k: _inputs(spark, [_row(1, "PAYIN", None, None, user=7), _row(2, "PAYOUT", None, None, user=5)])[k]
                                     for k in ("tf", "users")}
    given |= dict(
        coupons=given["coupons"].withColumn("created_at", F.timestamp_seconds(F.lit(1_700_000_000))),
        coupon_items=given["coupon_items"].withColumn("challenge_id", F.lit(11).cast("long")),
        challenges=spark.createDataFrame([(11, "ARAM")], "challenge_id long, external_gamemode string"),
        league_points=spark.createDataFrame([(1, 100)], "league_id long, external_match_id long"),
        transactions_finished=given["tf"])
    monkeypatch.setattr(marts, "banned_users", lambda *a: given["banned"])
    setting, limit = (f"spark.sql.{x}" for x in ("classic.shuffleDependency.fileCleanup.enabled", "autoBroadcastJoinThreshold"))
    value, before = spark.conf.get(setting), spark.conf.get(limit)
    tables = Path(checkpoint_dir(spark).removeprefix("file:")) / "tables"
    stood = set(tables.glob("*"))
    spark.conf.set(limit, "-1")
    try:
        seen = _shuffle_files(spark)
        paths = build.build_financial_marts(spark, defaultdict(lambda: None, given), str(tmp_path))
        deadline = time.time() + 10  # executors remove the files when they hear of it
        while _shuffle_files(spark) - seen and time.time() < deadline:
            time.sleep(0.1)
        assert not _shuffle_files(spark) - seen
        assert set(tables.glob("*")) == stood and spark.conf.get(setting) == value
        names = ("coupons", "grouped_challenges", "banned", "transactions", "transaction_items", "wallets", "accounts",
                 "super_tips", "coupon_items", "reputations", "match_players", "players")
        coupons = marts.coupons_finished(**{n: given[n] for n in names})
        assert _same(spark.read.parquet(paths["coupons_finished"]), coupons)
        plain = marts.financial_daily(given["tf"], coupons, *(given[n] for n in ("league_points", "coupon_items", "challenges", "users")))
        assert plain.count() > 3 and _same(spark.read.parquet(paths["financial_daily"]), plain)
    finally:
        spark.conf.set(limit, before)


def test_held_tables_go_when_a_step_fails(spark):
    tables = Path(checkpoint_dir(spark).removeprefix("file:")) / "tables"
    stood = set(tables.glob("*"))
    with pytest.raises(ValueError, match="later"), files.held_tables(spark) as held:
        assert held(spark.range(5), "five").count() == 5 and len(set(tables.glob("*")) - stood) == 1
        raise ValueError("later")
    assert set(tables.glob("*")) == stood
