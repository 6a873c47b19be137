"""Hand-made frames pinning the semantic traps and the edge
cases of FIXTURES.md §3."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tidemark.functions import regex_first, to_local, try_number, text_to_date, within_days
from tidemark.operators import aggs, attribution, checks, joins, reshape, stage
from tidemark.plans import marts
from tidemark.sources import jdbc


def ts(s):
    return dt.datetime.fromisoformat(s)


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()] if order else [tuple(r) for r in df.collect()]


# T1 — PostgreSQL null order in DISTINCT ON; tie-break makes it deterministic.
def test_distinct_on_pg_null_order(spark):
    df = spark.createDataFrame(
        [(1, None, ts("2024-01-01 00:00:00")), (1, "b", ts("2024-01-02 00:00:00")),
         (2, "a", ts("2024-01-01 00:00:00")), (2, "c", ts("2024-01-01 00:00:00"))],
        "k int, m string, t timestamp")
    desc = stage.distinct_on(df, ["k"], [("m", "desc")])
    assert rows(desc.select("k", "m"), "k") == [(1, None), (2, "c")]   # nulls first descending
    asc = stage.distinct_on(df, ["k"], [("m", "asc")])
    assert rows(asc.select("k", "m"), "k") == [(1, "b"), (2, "a")]     # nulls last ascending


def test_priority_attribution_null_medium_last_and_mgm_first(spark):
    t = spark.createDataFrame(
        [(1, ts("2024-01-05 00:00:00"), None, "s", None, None, None, None, None, Decimal("0")),
         (1, ts("2024-01-01 00:00:00"), "direct", "direct", None, None, None, None, None, Decimal("0")),
         (2, ts("2024-01-01 00:00:00"), "referral", "x", None, None, None, None, None, Decimal("0")),
         (2, ts("2024-01-03 00:00:00"), "mgm", "a@b", None, None, None, None, None, Decimal("5")),
         (2, ts("2024-01-04 00:00:00"), "cpv", "y", None, None, None, None, None, Decimal("0")),
         (3, ts("2024-01-01 00:00:00"), "newsletter", "n", None, None, None, None, None, Decimal("0")),
         (3, ts("2024-01-02 00:00:00"), "search-brand", "g", None, None, None, None, None, Decimal("0"))],
        "user_id int, timestamp timestamp, medium string, source string, path string, referrer string, "
        "campaign string, content string, term string, mgm_cost decimal(20,5)")
    out = attribution.attribute_by_priority(t)
    assert rows(out.select("user_id", "medium"), "user_id") == [(1, "direct"), (2, "mgm"), (3, "newsletter")]


# T2 — day distance is an integer; negative and null distances.
def test_within_days_flags(spark):
    df = spark.createDataFrame(
        [(1, dt.date(2024, 1, 10), dt.date(2024, 1, 9)), (2, dt.date(2024, 1, 10), dt.date(2024, 1, 10)),
         (3, dt.date(2024, 1, 10), dt.date(2024, 1, 17)), (4, dt.date(2024, 1, 10), dt.date(2024, 1, 18)),
         (5, dt.date(2024, 1, 10), None)], "u int, signup date, login date")
    out = df.select("u", within_days("signup", "login", 7).alias("f"))
    assert rows(out, "u") == [(1, 1), (2, 1), (3, 1), (4, 0), (5, 0)]


# T4 — the source pattern without '|' between the lists.
def test_classify_visits_source_regex_trap(spark):
    v = spark.createDataFrame(
        [(1, None, None, None, None, None, "/a", "https://duckduckgo.com/?q=x"),
         (2, None, None, None, None, None, "/a", "https://www.google.com/search"),
         (3, None, None, None, None, None, "/blog/post", "https://x.org"),
         (4, None, None, None, None, None, "/a", None),
         (5, None, None, None, None, None, "/a", "https://unknown.example"),
         (6, "influencer", None, "camp", None, None, "/a", None),
         (7, None, "paid-media", "c1", None, None, "/a", "https://youtube.com/v")],
        "id int, campaign_source string, campaign_medium string, campaign_name string, campaign_content string, "
        "campaign_term string, path string, referrer string")
    dim = spark.createDataFrame([("camp", "Famous")], "source_name string, influencer string")
    out = attribution.classify_visits(v, dim).select("id", "medium", "source", "campaign")
    got = {r[0]: r[1:] for r in out.collect()}
    assert got[1] == ("search-brand", "https://duckduckgo.com/?q=x", None)  # lone duckduckgo misses the joined pattern
    assert got[2] == ("search-brand", "google.com", None)
    assert got[3] == ("search-blog", "/blog/post", "/blog/post")
    assert got[4] == ("direct", "direct", None)
    assert got[5] == ("referral", "https://unknown.example", None)
    assert got[6] == ("influencer", "Famous", "camp")
    assert got[7] == ("paid-media", "https://youtube.com/v", "c1")  # youtube is merged with duckduckgo too (T4)
    fixed = attribution.classify_visits(v, dim, fix_join=True).where("id = 1").select("source").first()[0]
    assert fixed == "duckduckgo.com"


def test_regex_first_null_on_no_match(spark):
    df = spark.createDataFrame([("abc",), ("xyz",), (None,)], "s string")
    assert [r[0] for r in df.select(regex_first("s", "(b)")).collect()] == ["b", None, None]


# T6/T7 — cohort sums: no qualifying row gives null; net value coalesces to 0.
def test_cohort_sums_null_and_net_value(spark):
    led = spark.createDataFrame(
        [(1, 3, "PAYMENT", Decimal("10.00")), (1, 5, "BONUS_USE", Decimal("4.00")),
         (1, 20, "PAYMENT", Decimal("1.00")), (2, 3, "GAIN", Decimal("7.00"))],
        "user_id int, days_since_user_creation int, type string, value decimal(18,2)")
    out = {r["user_id"]: r for r in attribution.cohort_sums(led).collect()}
    assert out[1]["value_spent_7d"] == Decimal("10.00")
    assert out[1]["total_engagement_7d"] == Decimal("14.00")
    assert out[1]["total_engagement_30d"] == Decimal("11.00")  # PAYMENT only (T6)
    assert out[1]["value_received_7d"] is None
    assert out[2]["value_spent_7d"] is None


# T10/T11 — signed settlement, refund signs, unknown currency list.
def test_signed_settlement(spark):
    df = spark.createDataFrame(
        [("WON", "BRL", Decimal("10.00"), Decimal("2.00")), ("LOST", "BRL", Decimal("10.00"), Decimal("2.00")),
         ("REFUND", "BRL", Decimal("10.00"), Decimal("2.00")), ("WON", "BONUS_BRL", Decimal("10.00"), Decimal("1.50")),
         ("LOST", "BONUS_BRL", Decimal("10.00"), Decimal("2.00")), ("WON", "BONUS_BRL, BRL", Decimal("10.00"), Decimal("2.00"))],
        "coupon_status string, currency string, amount decimal(18,2), odd decimal(18,2)")
    out = [tuple(float(x) if x is not None else None for x in r) for r in marts.signed_settlement(df).select(
        "balance_amount", "user_balance_amount", "balance_amount_bonus", "user_balance_amount_bonus").collect()]
    assert out[0] == (-10.0, 10.0, -10.0, 10.0)
    assert out[1] == (10.0, -10.0, 10.0, -10.0)
    assert out[2] == (10.0, -10.0, -10.0, -10.0)   # REFUND: +amount plain, -amount bonus-aware (T10)
    assert out[3] == (-5.0, 5.0, -5.0, 5.0)
    assert out[4] == (10.0, -10.0, 0.0, 0.0)
    assert out[5][2] is None and out[5][3] is None  # two currencies hit no branch (T11)


def test_concat_values_sorted_and_all_null(spark):
    df = spark.createDataFrame([(1, "BRL"), (1, "BONUS_BRL"), (1, "BRL"), (2, None)], "k int, c string")
    out = dict(rows(aggs.concat_values(df, ["k"], "c")))
    assert out == {1: "BONUS_BRL, BRL, BRL", 2: ""}


# T15 — a null key in the primary does not empty the legacy branch.
def test_unify_prefer_primary_null_key(spark):
    prim = spark.createDataFrame([(1, "p"), (None, "p")], "id int, src string")
    leg = spark.createDataFrame([(1, "l"), (2, "l"), (None, "l")], "id int, src string")
    out = rows(stage.unify_prefer_primary(prim, leg, "id"), "src", "id")
    assert sorted(out, key=str) == sorted([(1, "p"), (None, "p"), (2, "l")], key=str)


def test_unify_latest_and_ranked(spark):
    new = spark.createDataFrame([(1, ts("2024-01-02 00:00:00"), "d")], "id int, t timestamp, received_date string")
    old = spark.createDataFrame([(1, ts("2024-01-01 00:00:00")), (2, ts("2024-01-01 00:00:00"))], "id int, t timestamp")
    latest = rows(stage.unify_latest(new, old, ["id"], "t").select("id", "received_date"), "id")
    assert latest == [(1, "d"), (2, None)]
    ranked = rows(stage.unify_ranked(new, old, ["id"], "t", skew_safe=False).select("id", "rn"), "id", "rn")
    assert ranked == [(1, 1), (1, 2), (2, 1)]
    safe = rows(stage.unify_ranked(new, old, ["id"], "t", skew_safe=True).select("id", "rn"), "id", "rn")
    assert safe == ranked


def test_skew_safe_rank_hot_key(spark):
    df = spark.range(0, 5000).select((F.when(F.col("id") < 4000, F.lit(1)).otherwise(F.col("id"))).alias("k"),
                                     F.col("id").alias("t"))
    a = stage.unify_ranked(df, df.limit(0), ["k"], "t", skew_safe=True)
    b = stage.unify_ranked(df, df.limit(0), ["k"], "t", skew_safe=False)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


# P4/P5/R1/R2 — decimal-comma parsing, bad dates, unpivot keeping nulls.
def test_sheet_parsing_and_unpivot(spark):
    sheet = spark.createDataFrame([("2024-01-01", "12,5", "1.234,56", "x"), ("bad", "", None, "y")],
                                  "_ string, a string, b string, _airbyte_raw_id string")
    parsed = reshape.parse_measure_columns(sheet)
    assert parsed.columns == ["reference_date", "a", "b"]
    assert rows(parsed, "a") == [(None, None, None), (dt.date(2024, 1, 1), 12.5, None)]
    long = reshape.unpivot_measures(parsed, "reference_date")
    assert long.count() == 4 and long.where("cost IS NULL").count() == 3
    one = spark.createDataFrame([("12,5",), ("1.234,56",), ("",)], "s string")
    assert [r[0] for r in one.select(try_number("s")).collect()] == [12.5, None, None]
    assert spark.createDataFrame([("nope",)], "s string").select(text_to_date("s")).first()[0] is None


# R5 — missing day takes its week's mean; a week without data stays null.
def test_fill_from_week(spark):
    rates = spark.createDataFrame([(dt.date(2024, 1, 1), Decimal("5.00")), (dt.date(2024, 1, 3), Decimal("6.00"))],
                                  "reference_date date, exchange decimal(18,2)")
    spine = reshape.date_spine(spark, "2024-01-01", "2024-01-08")
    out = dict(rows(reshape.fill_from_week(spine, rates, "reference_date", "exchange")))
    assert float(out[dt.date(2024, 1, 2)]) == 5.5
    assert float(out[dt.date(2024, 1, 3)]) == 6.0
    assert out[dt.date(2024, 1, 8)] is None   # next Monday: no data that week


# M13/T18 — newest ban; expiry equal to as_of is not active.
def test_ban_status(spark):
    bl = spark.createDataFrame(
        [(1, ts("2024-01-01 00:00:00"), ts("2024-12-31 00:00:00")), (1, ts("2024-02-01 00:00:00"), ts("2024-06-01 00:00:00")),
         (2, ts("2024-01-01 00:00:00"), ts("2024-06-01 00:00:00")), (3, ts("2024-01-01 00:00:00"), None)],
        "user_id int, created_at timestamp, expiry timestamp")
    out = dict(rows(attribution.ban_status(bl, "2024-06-01")))
    assert out == {1: False, 2: False, 3: False}
    out = dict(rows(attribution.ban_status(bl, "2024-05-31")))
    assert out == {1: True, 2: True, 3: False}


# J6 — 14-day window, both ends inclusive, and bucket boundaries.
def test_lookback_edges(spark):
    anchors = spark.createDataFrame([(1, 10, ts("2024-03-15 12:00:00"))], "block_id int, user_id int, t timestamp")
    ev = spark.createDataFrame(
        [(10, 1, ts("2024-03-01 12:00:00"), Decimal("1.00")),      # exactly 14 days before: in
         (10, 2, ts("2024-03-01 11:59:59.999999"), Decimal("2.00")),  # 14 days + 1 µs: out
         (10, 3, ts("2024-03-15 12:00:00"), Decimal("4.00")),      # same instant: in
         (10, 4, ts("2024-03-15 12:00:00.000001"), Decimal("8.00")),  # after: out
         (11, 5, ts("2024-03-10 00:00:00"), Decimal("16.00"))],   # other user
        "user_id int, tx int, paid_at timestamp, amount decimal(18,2)")
    for bucket in (1, 3, 7, 30):
        out = joins.lookback_agg(anchors, ev, "user_id", "t", "paid_at", 14, ["block_id"],
                                 {"n": F.countDistinct("tx"), "amt": aggs.sum_or_zero("amount")}, bucket_days=bucket)
        r = out.first()
        assert (r["n"], float(r["amt"])) == (2, 5.0), bucket
    none = joins.lookback_agg(anchors.withColumn("user_id", F.lit(99)), ev, "user_id", "t", "paid_at", 14,
                              ["block_id"], {"n": F.countDistinct("tx"), "amt": aggs.sum_or_zero("amount")}).first()
    assert (none["n"], float(none["amt"])) == (0, 0.0)


# T8/T9 — activations without a registration cell are lost; ban filter on registrations only.
def test_acquisition_traps(spark):
    cols = {c: (0.0 if c.endswith("_cost") else 0) for c in marts.ATTRIBUTION_COLUMNS}
    base = dict(cols, medium_agg="paid-media", source="adwords", campaign_agg="c", cpl_cost=1.0,
                first_coupon_gamemode="LOL", lol_activated=1)
    recs = [dict(base, user_id=1, ban_status="Not Banned", created_at=dt.date(2024, 1, 1), first_coupon_at=dt.date(2024, 1, 1)),
            dict(base, user_id=2, ban_status="Banned", created_at=dt.date(2024, 1, 1), first_coupon_at=dt.date(2024, 1, 1)),
            dict(base, user_id=3, ban_status="Not Banned", created_at=dt.date(2024, 1, 1), first_coupon_at=dt.date(2024, 1, 2),
                 campaign_agg="other")]
    schema = ", ".join(f"{c} {'date' if c in ('created_at', 'first_coupon_at') else 'double' if c.endswith('_cost') else 'string' if c in ('ban_status', 'medium', 'medium_agg', 'source', 'referrer', 'page_path', 'campaign', 'campaign_agg', 'content', 'term', 'first_coupon_gamemode', 'original_gamemode') else 'int'}"
                       for c in marts.ATTRIBUTION_COLUMNS)
    att = spark.createDataFrame([tuple(r[c] for c in marts.ATTRIBUTION_COLUMNS) for r in recs], schema)
    costs = spark.createDataFrame([], "reference_date date, font string, cost decimal(18,2)")
    spine = reshape.date_spine(spark, "2024-01-01", "2024-01-02")
    out = marts.acquisition_daily(att, costs, spine)
    day1 = out.where("_date = '2024-01-01' AND campaign_agg = 'c'").first()
    assert day1["new_users"] == 1                 # banned user 2 not registered (T8)
    assert day1["activated_on_date"] == 2         # but counted as activation (T8)
    assert out.where("_date = '2024-01-02'").first()["medium_agg"] is None   # empty day: null keys
    assert out.where("campaign_agg = 'other'").count() == 1                  # day-2 activation lost (T9)


# IO7/IO8 — window planning and the type map.
def test_plan_windows_and_types():
    w = jdbc.plan_windows(ts("2024-01-01 00:00:00"), ts("2024-01-02 05:00:00"), 12)
    assert w == [(ts("2024-01-01 00:00:00"), ts("2024-01-01 12:00:00")),
                 (ts("2024-01-01 12:00:00"), ts("2024-01-02 00:00:00")),
                 (ts("2024-01-02 00:00:00"), ts("2024-01-02 05:00:00"))]
    assert jdbc.plan_windows(ts("2024-01-02 00:00:00"), ts("2024-01-01 00:00:00"), 1) == []
    assert jdbc.spark_type_for("int4").simpleString() == "int"
    assert jdbc.spark_type_for("numeric").simpleString() == "decimal(38,18)"
    assert jdbc.spark_type_for("at").simpleString() == "string"   # exact names, no substring match
    assert jdbc.spark_type_for("jsonb").simpleString() == "string"
    assert jdbc.spark_type_for("geometry").simpleString() == "string"


# Q1/Q2/Q3 — checks.
def test_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (2, None)], "id int, v string")
    assert checks.check_not_null(df, "id").count() == 1
    assert rows(checks.check_unique(df, "id")) == [(1, 2)]
    res = {(r["column_name"], r["test"]): r["failures"] for r in
           checks.run_checks({"t": df}, {"t": {"not_null": ["id", "v"], "unique": ["id"]}}).collect()}
    assert res == {("id", "not_null"): 1, ("v", "not_null"): 1, ("id", "unique"): 1}


# S16 — two-argument time-zone shift semantics (02:00 UTC on 1 Jan -> 23:00 on 31 Dec).
def test_to_local(spark):
    df = spark.createDataFrame([(ts("2024-01-01 02:00:00"),)], "t timestamp_ntz")
    assert df.select(to_local("t")).first()[0] == ts("2023-12-31 23:00:00")


# A4/A5/A9/A10/P8 — generic helpers not used by a registered query.
def test_generic_aggregate_helpers(spark):
    df = spark.createDataFrame(
        [(1, "PAYIN", Decimal("10.00")), (1, "PAYOUT", Decimal("4.00")), (2, "PAYIN", Decimal("1.005"))],
        "k int, type string, amount decimal(18,3)")
    t = F.col("type")
    piv = dict((r[0], r[1:]) for r in aggs.pivot_sums(df, ["k"], {
        "payin": (t == "PAYIN", "amount"),
        "balance": aggs.cond_sum(t == "PAYIN", "amount") - aggs.cond_sum(t == "PAYOUT", "amount"),
    }).collect())
    assert piv[1] == (Decimal("10.00"), Decimal("6.00")) and piv[2][0] == Decimal("1.01")  # half up
    by_type = dict((r[0], r[1:]) for r in aggs.pivot_by_type(df, ["k"], "type", "amount", {
        "payin": (("PAYIN",), "value"), "payout": (("PAYOUT",), "neg")},
        {"balance": (("PAYIN",), ("PAYOUT",))}).collect())
    assert by_type[1] == (Decimal("10.00"), Decimal("-4.00"), Decimal("6.00"))
    ws = dict((r[0], r[1]) for r in aggs.window_sums(df, ["k"], {"out": (t == "PAYOUT", "amount")}).collect())
    assert ws == {1: Decimal("4.000"), 2: None}
    m = df.groupBy("k").agg(aggs.mean_or_zero(F.when(t == "PAYOUT", F.col("amount"))).alias("m"))
    assert {r[0]: float(r[1]) for r in m.collect()} == {1: 4.0, 2: 0.0}
    c = stage.with_constants(df, {"gamemode": "GENERAL", "zero": 0})
    assert c.select("gamemode", "zero").distinct().collect()[0][:] == ("GENERAL", 0)
