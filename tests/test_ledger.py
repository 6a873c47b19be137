"""The typed ledger on rows without keys, and what it reads."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from tidemark.operators import joins
from tidemark.plans import marts

T = datetime(2024, 5, 1, 12)
LEDGER = ("transaction_id long, transaction_type string, debit_credit string, wallet_currency string, created_at timestamp, "
          "updated_at timestamp, league_id long, coupon_id long, user_id long, amount_rev decimal(18,4), "
          "absolut_amount decimal(18,4)")


def _inputs(spark, rows):
    return dict(
        tf=spark.createDataFrame(rows, LEDGER),
        coupons=spark.createDataFrame([(7, 70, "CS", 5.0, 4.0, "BRL", "WON", T), (8, 80, "TFT", 6.0, 3.0, "BONUS_BRL", "WON", T),
                                       (None, 90, "CS", 1.0, 1.0, "BRL", "LOST", T)],
                                      "coupon_id long, user_id long, gamemode string, bet_amount double, balance_amount double, "
                                      "currency string, coupon_status string, created_at timestamp"),
        league_points=spark.createDataFrame([(1, "m1"), (1, "m2"), (None, "m1")], "league_id long, external_match_id string"),
        coupon_items=spark.createDataFrame([("m1", 11), ("m2", 12)], "external_match_id string, challenge_id long"),
        challenges=spark.createDataFrame([(11, "ARAM"), (12, "CS")], "challenge_id long, external_gamemode string"),
        users=spark.createDataFrame([(70, T), (None, T), (80, datetime(2020, 1, 1))], "user_id long, created_at timestamp"))


def _row(i, kind, side, money, league=None, coupon=None, user=None):
    return (i, kind, side, money, T, T, league, coupon, user, Decimal(1), Decimal(2))


def test_rows_with_and_without_keys(spark):
    rows = [_row(1, "LEAGUE_TICKET", "CREDIT", "BRL", league=1, user=5), _row(2, "LEAGUE_TICKET", "CREDIT", "BRL", user=5),
            _row(3, "LEAGUE_TICKET", "CREDIT", "BRL", league=9, user=5), _row(4, "LEAGUE_TICKET", "CREDIT", "USD", league=1),
            _row(5, "COUPON", "ARTIFICIAL", "BRL", coupon=7, user=5), _row(6, "COUPON", None, "BRL", coupon=99, user=5),
            _row(7, "COUPON_REFUND", "DEBIT", "BRL", user=5), _row(8, "COUPON_REFUND", "DEBIT", "BONUS_BRL", coupon=7, user=5),
            _row(9, "SUBSCRIPTION_OLD_USER", "CREDIT", "BRL", user=70), _row(10, "SUBSCRIPTION_OLD_USER", "CREDIT", "BRL", user=80),
            _row(11, "SUBSCRIPTION_OLD_USER", "CREDIT", "BRL"), _row(12, "PAYIN", None, None), _row(13, "OTHER", None, None),
            _row(None, "LEAGUE_TICKET", "CREDIT", "BRL")]
    got = marts.typed_ledger(**_inputs(spark, rows)).select(
        "feed", "transaction_id", "type", "user_id", "gamemode", "coupon_id", "bet_amount", "amount").collect()
    want = [("league", 1, "LEAGUE_ENTRANCE", 5, "ARAM", None, None, 2), ("league", 1, "LEAGUE_ENTRANCE", 5, "CS", None, None, 2),
            ("league", 2, "LEAGUE_ENTRANCE", 5, "LOL1V1", None, None, 2),
            ("league", 3, "LEAGUE_ENTRANCE", 5, "LOL1V1", None, None, 2),
            ("league", None, "LEAGUE_ENTRANCE", None, "LOL1V1", None, None, 2),
            ("coupon", 5, "RECOVERED_REVENUE", 70, "CS", "7", 5.0, 1), ("coupon", 6, None, None, None, "99", None, 1),
            ("coupon", 7, "COUPON_REFUND", None, None, None, None, 1), ("bonus", 8, "BONUS", 5, None, None, None, 2),
            ("subscription", 9, "SUBSCRIPTION_OLD_USER", 70, None, None, None, 2), ("pay", 12, "PAYIN", None, None, None, None, 2),
            ("converted", None, "BONUS_CONVERTED", 80, "TFT", "8", 6.0, 3)]
    assert sorted(((*r[:-1], int(r[-1])) for r in got), key=str) == sorted(want, key=str)


def test_ledger_is_scanned_once(spark, tmp_path):
    given = _inputs(spark, [_row(1, "PAYIN", None, None, user=5)])
    given["tf"].write.parquet(f"{tmp_path}/ledger")
    given["tf"] = spark.read.parquet(f"{tmp_path}/ledger")
    assert given["tf"].count() == 1
    for frame in (marts.typed_ledger(**given), marts.ledger_totals(given["tf"])):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan parquet") == 1


def test_fan_out_over_sets_of_segments(spark):
    rows = spark.createDataFrame([(1, 10), (1, 20), (2, 30), (3, 40), (None, 50)], "user_id long, v long")
    pairs = spark.createDataFrame([(1, "B"), (1, "A"), (1, "B"), (2, None), (2, "A"), (2, None), (2, "X"), (None, "A"), (9, "A")],
                                  "user_id long, mode string")
    sets = joins.with_segments(rows, pairs, "user_id", "mode", "X", "modes")
    # the null segment of user 2 is one more default beside its own
    assert {(r["v"], tuple(r["modes"])) for r in sets.collect()} == {
        (10, ("A", "B")), (20, ("A", "B")), (30, ("A", "X", "X")), (40, ("X",)), (50, ("X",))}
    fanned = joins.fan_out(rows.selectExpr("*", "'old' AS mode"), pairs, "user_id", "mode", "X")
    assert sorted((r["v"], r["mode"]) for r in fanned.collect()) == [
        (10, "A"), (10, "B"), (20, "A"), (20, "B"), (30, "A"), (30, "X"), (30, "X"), (40, "X"), (50, "X")]
    # the same as the join with the distinct pairs
    plain = rows.join(pairs.distinct(), "user_id", "left").selectExpr("v", "coalesce(mode, 'X') AS mode")
    assert sorted(map(tuple, plain.collect())) == sorted((r["v"], r["mode"]) for r in fanned.collect())
    assert joins.fan_out(rows, pairs.limit(0), "user_id", "mode", "X").select("mode").distinct().collect() == [("X",)]
