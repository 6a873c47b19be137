"""Driver queries for the single operators, each beside the
DuckDB SQL that must give the same rows.

The driver's tables stand in for the pipelines' inputs: orders are coupons
or transactions, customers are users, events are visits/bans/payouts, pages
are page views. Money is carried as DECIMAL(18,2) so sums are exact in both
engines; every computed column is aliased identically on both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import (
    case_label,
    days_before,
    days_between,
    flag,
    keep,
    keep_in,
    keep_like,
    keep_not_null,
    local_date,
    money,
    month_start,
    regex_first,
    replace_text,
    to_local,
    week_start,
)
from tidemark.functions import predicates
from tidemark.operators import aggs, checks, joins, reshape, stage
from tidemark.sources.files import Tables

REGISTRY: dict[str, object] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None):
    def deco(fn):
        REGISTRY[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ----------------------------------------------------------------- staging
@register("stage_rename_cast", """
SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS name, c_mktsegment,
       CAST(c_acctbal AS DECIMAL(18,2)) AS acctbal, c_nationkey, 'tpch' AS source
FROM customer
""")
def stage_rename_cast(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    return stage.stage(t.customer, [("c_custkey", "customer_id"), ("c_name", "name"), "c_mktsegment",
                                    ("c_acctbal", "acctbal"), "c_nationkey"],
                       casts={"customer_id": "string", "acctbal": "decimal(18,2)"},
                       constants={"source": "tpch"})


@register("scalar_expressions", r"""
SELECT o_orderkey,
  coalesce(nullif(o_orderpriority, '5-LOW'), 'none') AS s1_coalesce,
  coalesce(CAST(o_totalprice AS DECIMAL(18,2)) - CAST(NULLIF(o_orderstatus, 'P') IS NOT NULL AS INTEGER) * 100, 0) AS s2_diff,
  CASE WHEN o_orderstatus = 'F' THEN 'done' WHEN o_orderstatus = 'O' THEN 'open' END AS s3_case,
  CASE WHEN o_totalprice > 100000 THEN 1 ELSE 0 END AS s4_flag,
  replace(o_orderpriority, '-', ' ') AS s5_replace,
  concat(o_orderstatus, '/', o_orderpriority) AS s6_concat,
  array_to_string([o_orderstatus, o_orderpriority], '|') AS s7_concat_ws,
  o_orderpriority LIKE '%URGENT%' AS s8_like,
  CASE WHEN regexp_matches(o_orderpriority, '^([0-9])-') THEN regexp_extract(o_orderpriority, '^([0-9])-', 1) END AS s9_regex,
  CAST(date_trunc('week', o_orderdate) AS DATE) AS s10_week,
  CAST(date_trunc('month', o_orderdate) AS DATE) AS s10_month,
  CAST(o_orderdate AS DATE) AS s11_date,
  CAST('2001-01-01' AS DATE) AS s12_to_date,
  CAST(date_diff('day', DATE '2000-01-01', CAST(o_orderdate AS DATE)) AS INTEGER) AS s14_days,
  o_orderdate - INTERVAL 14 DAY AS s15_shift,
  round(CAST(o_totalprice AS DECIMAL(18,2)) * 1.1, 1) AS s18_round,
  abs(CAST(o_totalprice AS DECIMAL(18,2)) - 200000) AS s19_abs,
  -(CAST(o_totalprice AS DECIMAL(18,2)) * (CAST(1.5 AS DECIMAL(4,2)) - 1)) AS s20_arith,
  CAST(CAST(o_totalprice AS DECIMAL(18,2)) / 1000000 AS DECIMAL(18,8)) AS s21_micros,
  CAST(o_orderkey AS VARCHAR) AS s22_cast,
  o_totalprice BETWEEN 50000 AND 150000 AS s23_between
FROM orders
""")
def scalar_expressions(spark: SparkSession, sf: str) -> DataFrame:
    o = Tables(spark, sf).orders
    price = money("o_totalprice")
    return o.select(
        "o_orderkey",
        F.coalesce(F.nullif("o_orderpriority", F.lit("5-LOW")), F.lit("none")).alias("s1_coalesce"),
        F.coalesce(price - F.nullif("o_orderstatus", F.lit("P")).isNotNull().cast("int") * 100,
                   F.lit(0)).alias("s2_diff"),
        case_label([(F.col("o_orderstatus") == "F", "done"), (F.col("o_orderstatus") == "O", "open")]).alias("s3_case"),
        flag(F.col("o_totalprice") > 100000).alias("s4_flag"),
        replace_text("o_orderpriority", "-", " ").alias("s5_replace"),
        F.concat("o_orderstatus", F.lit("/"), "o_orderpriority").alias("s6_concat"),
        F.concat_ws("|", F.array("o_orderstatus", "o_orderpriority")).alias("s7_concat_ws"),
        F.col("o_orderpriority").like("%URGENT%").alias("s8_like"),
        regex_first("o_orderpriority", "^([0-9])-").alias("s9_regex"),
        week_start("o_orderdate").alias("s10_week"),
        month_start("o_orderdate").alias("s10_month"),
        F.to_date("o_orderdate").alias("s11_date"),
        F.to_date(F.lit("2001-01-01")).alias("s12_to_date"),
        days_between("o_orderdate", F.lit("2000-01-01")).alias("s14_days"),
        days_before("o_orderdate", 14).alias("s15_shift"),
        F.round(price * F.lit(1.1).cast("decimal(2,1)"), 1).alias("s18_round"),
        F.abs(price - F.lit(200000)).alias("s19_abs"),
        (-(price * (F.lit(1.5).cast("decimal(4,2)") - 1))).alias("s20_arith"),
        (price / F.lit(1000000)).cast("decimal(18,8)").alias("s21_micros"),
        F.col("o_orderkey").cast("string").alias("s22_cast"),
        F.col("o_totalprice").between(50000, 150000).alias("s23_between"),
    )


@register("filter_predicates", """
SELECT o_orderkey, o_orderstatus, o_orderpriority, o_totalprice
FROM orders
WHERE o_orderstatus IN ('F', 'O')
  AND o_orderpriority NOT IN ('5-LOW')
  AND o_totalprice BETWEEN 50000 AND 300000
  AND o_orderpriority LIKE '%-%'
  AND coalesce(nullif(o_orderpriority, '1-URGENT'), '') NOT LIKE '2%'
  AND nullif(o_orderstatus, 'O') IS NOT NULL
""")
def filter_predicates(spark: SparkSession, sf: str) -> DataFrame:
    o = Tables(spark, sf).orders.select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    o = keep_in(o, "o_orderstatus", ["F", "O"])
    o = keep_in(o, "o_orderpriority", ["5-LOW"], negate=True)
    o = keep(o, F.col("o_totalprice").between(50000, 300000))
    o = keep_like(o, "o_orderpriority", "%-%")
    o = keep_like(o, F.nullif("o_orderpriority", F.lit("1-URGENT")), "2%", negate=True, null_as="")
    return keep_not_null(o, F.nullif("o_orderstatus", F.lit("O")))


# ------------------------------------------------------------------ dedup
@register("latest_per_key", """
SELECT event_id, user_id, ts, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
""")
def latest_per_key(spark: SparkSession, sf: str) -> DataFrame:
    ev = Tables(spark, sf).events.select("event_id", "user_id", "ts", "event_type", "value")
    return stage.latest_per_key(ev, ["user_id"], "ts", tiebreak=[("event_id", "desc")])


@register("first_per_key", """
SELECT o_custkey, o_orderkey, o_orderdate, o_orderstatus FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate ASC, o_orderkey ASC) = 1
""")
def first_per_key(spark: SparkSession, sf: str) -> DataFrame:
    o = Tables(spark, sf).orders.select("o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus")
    return stage.first_per_key(o, ["o_custkey"], "o_orderdate", tiebreak=[("o_orderkey", "asc")])


@register("distinct_on_pg_nulls", """
SELECT user_id, event_id, ts, nullif(event_type, 'error') AS etype FROM events
QUALIFY row_number() OVER (PARTITION BY user_id
    ORDER BY nullif(event_type, 'error') DESC NULLS FIRST, ts ASC NULLS LAST, event_id ASC NULLS LAST) = 1
""")
def distinct_on_pg_nulls(spark: SparkSession, sf: str) -> DataFrame:
    ev = Tables(spark, sf).events.select("user_id", "event_id", "ts",
                                         F.nullif("event_type", F.lit("error")).alias("etype"))
    return stage.distinct_on(ev, ["user_id"], [("etype", "desc"), ("ts", "asc"), ("event_id", "asc")])


_UNIFY_SQL = """
WITH cur AS (
  SELECT event_id, ts, user_id, event_type, props, CAST(ts AS DATE) AS received_date, 'new' AS export FROM events),
old AS (
  SELECT event_id, ts + to_seconds(CAST(2 * floor(value) - 99 AS BIGINT) * 60) AS ts, user_id, event_type,
         CAST(NULL AS VARCHAR) AS props, CAST(NULL AS DATE) AS received_date, 'old' AS export FROM events),
both_ AS (SELECT * FROM cur UNION ALL SELECT * FROM old)
"""


def _exports(spark: SparkSession, sf: str):
    ev = Tables(spark, sf).events
    cur = ev.select("event_id", "ts", "user_id", "event_type", "props",
                    F.to_date("ts").alias("received_date"), F.lit("new").alias("export"))
    shift = F.make_dt_interval(F.lit(0), F.lit(0), (2 * F.floor("value") - 99).cast("int"))
    old = ev.select("event_id", (F.col("ts") + shift).alias("ts"), "user_id", "event_type",
                    F.lit("old").alias("export"))
    return cur, old


@register("unify_latest", _UNIFY_SQL + """
SELECT * FROM both_ QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ts DESC) = 1
""")
def unify_latest(spark: SparkSession, sf: str) -> DataFrame:
    cur, old = _exports(spark, sf)
    return stage.unify_latest(cur, old, ["event_id"], "ts")


@register("unify_ranked", _UNIFY_SQL + """
SELECT *, CAST(row_number() OVER (PARTITION BY event_id ORDER BY ts DESC) AS INTEGER) AS rn FROM both_
""")
def unify_ranked(spark: SparkSession, sf: str) -> DataFrame:
    cur, old = _exports(spark, sf)
    return stage.unify_ranked(cur, old, ["event_id"], "ts")


@register("unify_ranked_skew_safe", _UNIFY_SQL + """
SELECT *, CAST(row_number() OVER (PARTITION BY event_id ORDER BY ts DESC) AS INTEGER) AS rn FROM both_
""")
def unify_ranked_skew_safe(spark: SparkSession, sf: str) -> DataFrame:
    cur, old = _exports(spark, sf)
    return stage.unify_ranked(cur, old, ["event_id"], "ts", skew_safe=True)


@register("unify_ranked_ties", """
WITH both_ AS (
  SELECT event_type, user_id, CAST(ts AS DATE) AS day, event_id, 'new' AS export FROM events UNION ALL
  SELECT event_type, user_id, CAST(ts AS DATE), event_id, 'old' FROM events)
SELECT *, CAST(row_number() OVER (PARTITION BY event_type ORDER BY day DESC NULLS LAST, export, user_id NULLS FIRST,
  event_id) AS INTEGER) AS rn FROM both_
""")
def unify_ranked_ties(spark: SparkSession, sf: str) -> DataFrame:
    """D5 with hot keys and hundreds of rows of one time: the tie-break ranks them alike on every run."""
    ev = Tables(spark, sf).events.select("event_type", "user_id", F.to_date("ts").alias("day"), "event_id")
    return stage.unify_ranked(ev.withColumn("export", F.lit("new")), ev.withColumn("export", F.lit("old")),
                              ["event_type"], "day", tiebreak=[("export", "asc"), ("user_id", "asc"), ("event_id", "asc")])


@register("unify_prefer_primary", """
WITH prim AS (
  SELECT CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'O' THEN NULL ELSE o_orderkey END AS k,
         o_orderstatus, 'primary' AS export
  FROM orders WHERE o_orderstatus IN ('F', 'O')),
leg AS (SELECT o_orderkey AS k, o_orderstatus, 'legacy' AS export FROM orders)
SELECT * FROM prim
UNION ALL
SELECT * FROM leg WHERE k IS NOT NULL AND NOT EXISTS (SELECT 1 FROM prim WHERE prim.k = leg.k)
""")
def unify_prefer_primary(spark: SparkSession, sf: str) -> DataFrame:
    o = Tables(spark, sf).orders
    prim = o.where(F.col("o_orderstatus").isin("F", "O")).select(
        F.when((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "O"), F.lit(None))
        .otherwise(F.col("o_orderkey")).alias("k"), "o_orderstatus", F.lit("primary").alias("export"))
    leg = o.select(F.col("o_orderkey").alias("k"), "o_orderstatus", F.lit("legacy").alias("export"))
    return stage.unify_prefer_primary(prim, leg, "k")


@register("distinct_pairs", "SELECT DISTINCT user_id, event_type FROM events")
def distinct_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return stage.distinct_rows(Tables(spark, sf).events, ["user_id", "event_type"])


# ------------------------------------------------------------------ joins
@register("left_join_composite", """
WITH li AS (SELECT l_orderkey, l_linenumber, l_partkey, nullif(l_suppkey, 7) AS l_suppkey FROM lineitem),
ps AS (SELECT l_partkey, l_suppkey, count(*) AS ps_lines FROM li GROUP BY 1, 2)
SELECT li.l_orderkey, li.l_linenumber, li.l_partkey, li.l_suppkey, o.o_orderstatus, p.p_type, s.s_name, ps.ps_lines
FROM li
JOIN orders o ON o.o_orderkey = li.l_orderkey
LEFT JOIN part p ON p.p_partkey = li.l_partkey
LEFT JOIN supplier s ON s.s_suppkey = li.l_suppkey
LEFT JOIN ps ON ps.l_partkey = li.l_partkey AND ps.l_suppkey = li.l_suppkey
WHERE o.o_orderstatus IS NOT NULL
""")
def left_join_composite(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey",
                           F.nullif("l_suppkey", F.lit(7)).alias("l_suppkey"))
    ps = li.groupBy("l_partkey", "l_suppkey").agg(F.count(F.lit(1)).alias("ps_lines"))
    orders = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus")
    part = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_type")
    supp = t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    out = joins.star(li, [(orders, "l_orderkey", "inner"), (part, "l_partkey"), (supp, "l_suppkey"),
                          (ps, ["l_partkey", "l_suppkey"])])
    return out.where(F.col("o_orderstatus").isNotNull()).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "o_orderstatus", "p_type", "s_name", "ps_lines")


@register("join_on_constant_side", """
SELECT o.o_orderkey, o.o_orderstatus, c.c_name AS finished_by, b.c_mktsegment AS building_segment
FROM orders o
LEFT JOIN customer c ON c.c_custkey = o.o_custkey AND o.o_orderstatus = 'F'
JOIN (SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment = 'BUILDING') b ON b.c_custkey = o.o_custkey
""")
def join_on_constant_side(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    o = t.orders.select("o_orderkey", "o_orderstatus", "o_custkey")
    cust = t.customer.select("c_custkey", F.col("c_name").alias("finished_by"))
    out = joins.lookup_if(o, cust, [("o_custkey", "c_custkey")], F.col("__l.o_orderstatus") == "F")
    b = t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("building_segment"))
    out = joins.join_where(out, b, "o_custkey", F.col("building_segment") == "BUILDING")
    return out.select("o_orderkey", "o_orderstatus", "finished_by", "building_segment")


@register("lookback_agg", """
SELECT b.event_id AS block_id, b.user_id, b.ts,
  count(DISTINCT p.event_id) AS payouts_14d,
  CAST(coalesce(sum(p.amount), 0) AS DECIMAL(18,2)) AS amount_14d,
  count(DISTINCT p.event_id) FILTER (WHERE p.ts >= b.ts - INTERVAL 3 DAY) AS payouts_3d,
  CAST(coalesce(sum(p.amount) FILTER (WHERE p.ts >= b.ts - INTERVAL 3 DAY), 0) AS DECIMAL(18,2)) AS amount_3d
FROM events b LEFT JOIN (SELECT event_id, user_id, ts, CAST(value AS DECIMAL(18,2)) AS amount FROM events
                         WHERE event_type = 'purchase') p
  ON p.user_id = b.user_id AND p.ts BETWEEN b.ts - INTERVAL 14 DAY AND b.ts
WHERE b.event_type = 'error' GROUP BY ALL
""")
def lookback_agg(spark: SparkSession, sf: str) -> DataFrame:
    ev = Tables(spark, sf).events
    bans = ev.where(F.col("event_type") == "error").select(F.col("event_id").alias("block_id"), "user_id", "ts")
    pay = ev.where(F.col("event_type") == "purchase").select(
        F.col("event_id").alias("transaction_id"), "user_id", F.col("ts").alias("paid_at"),
        money("value").alias("amount"))
    out = bans
    for days in (14, 3):
        agg = joins.lookback_agg(bans, pay, "user_id", "ts", "paid_at", days, ["block_id"], {
            f"payouts_{days}d": F.countDistinct("transaction_id"),
            f"amount_{days}d": aggs.sum_or_zero("amount").cast("decimal(18,2)"),
        })
        out = out.join(agg.drop("user_id", "ts"), on="block_id", how="inner")
    return out.select("block_id", "user_id", "ts", "payouts_14d", "amount_14d", "payouts_3d", "amount_3d")


@register("before_anchor", """
WITH last_buy AS (
  SELECT user_id, ts AS anchor_ts FROM events WHERE event_type = 'purchase'
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1)
SELECT e.event_id, e.user_id, e.ts, e.event_type, a.anchor_ts
FROM events e JOIN last_buy a ON a.user_id = e.user_id
WHERE e.ts BETWEEN a.anchor_ts - INTERVAL 7 DAY AND a.anchor_ts
""")
def before_anchor(spark: SparkSession, sf: str) -> DataFrame:
    ev = Tables(spark, sf).events.select("event_id", "user_id", "ts", "event_type")
    anchors = stage.latest_per_key(ev.where(F.col("event_type") == "purchase"), ["user_id"], "ts")
    anchors = anchors.select("user_id", F.col("ts").alias("anchor_ts"))
    out = joins.before_anchor(ev, anchors, "user_id", "ts", "anchor_ts", 7)
    return out.select("event_id", "user_id", "ts", "event_type", "anchor_ts")


@register("anti_untracked", """
SELECT p_partkey, p_name FROM part
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_partkey = part.p_partkey AND l.l_returnflag = 'R'
                  AND l.l_quantity >= 48)
""")
def anti_untracked(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    sold = t.lineitem.where((F.col("l_returnflag") == "R") & (F.col("l_quantity") >= 48)).select(F.col("l_partkey").alias("p_partkey"))
    return joins.without_match(t.part.select("p_partkey", "p_name"), sold, "p_partkey")


@register("flag_lookup", """
SELECT c_custkey,
  EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderpriority = '1-URGENT') AS has_urgent,
  EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_totalprice > 450000) AS has_big
FROM customer c
""")
def flag_lookup(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    c = t.customer.select("c_custkey")
    o = t.orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderpriority", "o_totalprice")
    c = joins.flag_match(c, o.where(F.col("o_orderpriority") == "1-URGENT"), "c_custkey", "has_urgent")
    return joins.flag_match(c, o.where(F.col("o_totalprice") > 450000), "c_custkey", "has_big")


# ------------------------------------------------------------- calendars
@register("spine_fill", """
WITH bounds AS (SELECT min(CAST(o_orderdate AS DATE)) AS lo, max(CAST(o_orderdate AS DATE)) AS hi FROM orders),
spine AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS _date FROM bounds),
daily AS (SELECT CAST(o_orderdate AS DATE) AS d, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS cost, 1 AS n_orders
          FROM orders)
SELECT s._date, daily.o_orderstatus, coalesce(sum(daily.cost), 0) AS cost, CAST(sum(daily.n_orders) AS BIGINT) AS n_orders
FROM spine s LEFT JOIN daily ON daily.d = s._date
GROUP BY 1, 2
""")
def spine_fill(spark: SparkSession, sf: str) -> DataFrame:
    o = Tables(spark, sf).orders
    daily = o.select(F.to_date("o_orderdate").alias("d"), "o_orderstatus", money("o_totalprice").alias("cost"),
                     F.lit(1).cast("long").alias("n_orders"))
    spine = reshape.spine_between(o, "o_orderdate")
    return reshape.fill_spine(spine, daily, "d", ["o_orderstatus"], ["cost"], ["n_orders"])


@register("weekly_fallback", """
WITH rate AS (SELECT CAST(o_orderdate AS DATE) AS day, CAST(min(o_totalprice) AS DECIMAL(18,2)) AS exchange
              FROM orders GROUP BY day)
SELECT CAST(d.day AS DATE) AS reference_date,
  CAST(round(if(rate.day IS NULL, (SELECT avg(w.exchange) FROM rate w
    WHERE yearweek(w.day) = yearweek(d.day)), rate.exchange), 4) AS DECIMAL(18,4)) AS exchange
FROM (SELECT unnest(range(min(day), max(day) + 1, INTERVAL 1 DAY)) AS day FROM rate) d
LEFT JOIN rate ON rate.day = d.day
""")
def weekly_fallback(spark: SparkSession, sf: str) -> DataFrame:
    o = Tables(spark, sf).orders
    rates = o.groupBy(F.to_date("o_orderdate").alias("reference_date")).agg(
        money(F.min("o_totalprice")).alias("exchange"))
    spine = reshape.spine_between(o, "o_orderdate")
    out = reshape.fill_from_week(spine, rates, "reference_date", "exchange")
    return out.withColumn("exchange", F.col("exchange").cast("decimal(18,4)"))


@register("monthly_active", """
WITH counted AS (
  SELECT CAST(ts AS DATE) AS reference_date, if(grouping(event_type) = 1, 'GENERAL', event_type) AS event_type,
    count(*) AS n_events
  FROM events GROUP BY GROUPING SETS ((CAST(ts AS DATE)), (CAST(ts AS DATE), event_type)))
SELECT c.*, (SELECT count(DISTINCT e.user_id) FROM events e
             WHERE year(e.ts) = year(c.reference_date) AND month(e.ts) = month(c.reference_date)
               AND c.event_type IN ('GENERAL', e.event_type)) AS monthly_users
FROM counted c
""")
def monthly_active(spark: SparkSession, sf: str) -> DataFrame:
    ev = Tables(spark, sf).events.select(F.to_date("ts").alias("reference_date"), "event_type", "user_id")
    general = ev.groupBy("reference_date").agg(F.count(F.lit(1)).alias("n_events"))
    per_type = ev.groupBy("reference_date", "event_type").agg(F.count(F.lit(1)).alias("n_events"))
    daily = aggs.with_general(general, per_type, "event_type")
    mu = aggs.monthly_active(ev, "reference_date", "user_id").withColumn("event_type", F.lit("GENERAL"))
    mug = aggs.monthly_active(ev, "reference_date", "user_id", segment="event_type")
    users = mu.select("month", "event_type", "monthly_users").unionByName(mug)
    daily = daily.withColumn("month", month_start("reference_date"))
    return daily.join(users, on=["month", "event_type"], how="left").select(
        "reference_date", "event_type", "n_events", "monthly_users")


@register("monthly_users_bitmap", """
SELECT CAST(date_trunc('month', ts) AS DATE) AS month, coalesce(event_type, 'GENERAL') AS event_type,
  count(DISTINCT user_id) AS monthly_users
FROM events GROUP BY GROUPING SETS ((1), (1, event_type))
""")
def monthly_users_bitmap(spark: SparkSession, sf: str) -> DataFrame:
    """Sets of users kept per day and type, merged to months and to all types (exact)."""
    ev = Tables(spark, sf).events.select(F.to_date("ts").alias("day"), "event_type", "user_id")
    days = aggs.user_bitmaps(ev, ["day", "event_type"], "user_id").withColumn("month", month_start("day"))
    months = aggs.merge_bitmaps(days, ["month", "event_type"])
    return aggs.with_general(aggs.bitmap_users(months, ["month"]), aggs.bitmap_users(months, ["month", "event_type"]),
                             "event_type").select("month", "event_type", "monthly_users")


# ------------------------------------------------------------ aggregates
@register("grouped_aggs", """
SELECT l_returnflag, l_linestatus, year(l_shipdate) AS ship_year,
  sum(CAST(l_quantity AS DECIMAL(18,2))) AS sum_qty,
  count(*) AS n_lines,
  count(DISTINCT l_orderkey) AS n_orders,
  min(l_discount) AS min_discount,
  max(l_extendedprice) AS max_price,
  avg(l_quantity) AS avg_qty
FROM lineitem GROUP BY 1, 2, 3
""")
def grouped_aggs(spark: SparkSession, sf: str) -> DataFrame:
    li = Tables(spark, sf).lineitem
    return aggs.grouped(li, {"l_returnflag": F.col("l_returnflag"), "l_linestatus": F.col("l_linestatus"),
                             "ship_year": F.year("l_shipdate").cast("long")}, {
        "sum_qty": F.sum(money("l_quantity")),
        "n_lines": F.count(F.lit(1)),
        "n_orders": F.countDistinct("l_orderkey"),
        "min_discount": F.min("l_discount"),
        "max_price": F.max("l_extendedprice"),
        "avg_qty": F.avg("l_quantity"),
    })


# Ledger typing of the daily pivot: order status -> movement type.
_PIVOT_TYPES = "CASE o_orderstatus WHEN 'F' THEN 'PAYIN' WHEN 'O' THEN 'PAYOUT' ELSE 'COUPON' END"
@register("conditional_pivot_sums", f"""
WITH cell AS (
  SELECT CAST(o_orderdate AS DATE) AS reference_date,
    if(grouping(c_mktsegment) = 1, 'GENERAL', c_mktsegment) AS segment, {_PIVOT_TYPES} AS type,
    sum(CAST(o_totalprice AS DECIMAL(18,2))) AS amount
  FROM customer JOIN orders ON o_custkey = c_custkey
  GROUP BY GROUPING SETS ((CAST(o_orderdate AS DATE), {_PIVOT_TYPES}),
                          (CAST(o_orderdate AS DATE), c_mktsegment, {_PIVOT_TYPES}))),
wide AS (PIVOT cell ON type IN ('COUPON', 'PAYIN', 'PAYOUT') USING coalesce(sum(amount), 0)
         GROUP BY reference_date, segment)
SELECT reference_date, segment, round("COUPON", 2) AS coupons, round("PAYIN", 2) AS payin,
  round("PAYOUT", 2) AS payout_abs, round(-"PAYOUT", 2) AS payout, round("PAYOUT", 2) AS payout_abs2,
  round("PAYIN" - "PAYOUT", 2) AS payin_payout_balance
FROM wide
""")
def conditional_pivot_sums(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    o = t.orders.select("o_custkey", "o_orderdate", "o_orderstatus", "o_totalprice")
    c = t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("segment"))
    ledger = joins.lookup(o, c, "o_custkey", how="inner").select(
        F.to_date("o_orderdate").alias("reference_date"), "segment",
        case_label([(F.col("o_orderstatus") == "F", "PAYIN"), (F.col("o_orderstatus") == "O", "PAYOUT")],
                   default="COUPON").alias("type"),
        money("o_totalprice").alias("amount"))
    rules = {
        "coupons": (("COUPON",), "value"),
        "payin": (("PAYIN",), "value"),
        "payout_abs": (("PAYOUT",), "value"),
        "payout": (("PAYOUT",), "neg"),
        "payout_abs2": (("PAYOUT",), "abs"),
    }
    derived = {"payin_payout_balance": (("PAYIN",), ("PAYOUT",))}
    general = aggs.pivot_by_type(ledger, ["reference_date"], "type", "amount", rules, derived)
    per_segment = aggs.pivot_by_type(ledger, ["reference_date", "segment"], "type", "amount", rules, derived)
    return aggs.with_general(general, per_segment, "segment")


@register("window_sums", """
WITH firsts AS (SELECT o_custkey, min(o_orderdate) AS first_at FROM orders GROUP BY 1),
ledger AS (
  SELECT o.o_custkey AS user_id,
         CAST(date_diff('day', CAST(f.first_at AS DATE), CAST(o.o_orderdate AS DATE)) AS INTEGER) AS days_since_user_creation,
         CASE o.o_orderstatus WHEN 'F' THEN 'PAYMENT' WHEN 'O' THEN 'GAIN' ELSE 'BONUS_USE' END AS type,
         CAST(o.o_totalprice AS DECIMAL(18,2)) AS value
  FROM orders o JOIN firsts f ON f.o_custkey = o.o_custkey)
SELECT user_id,
  sum(value) FILTER (WHERE type IN ('PAYMENT') AND days_since_user_creation <= 7) AS value_spent_7d,
  sum(value) FILTER (WHERE type IN ('GAIN') AND days_since_user_creation <= 7) AS value_received_7d,
  sum(value) FILTER (WHERE type IN ('PAYMENT', 'BONUS_USE') AND days_since_user_creation <= 7) AS total_engagement_7d,
  sum(value) FILTER (WHERE type IN ('PAYMENT') AND days_since_user_creation <= 30) AS value_spent_30d,
  sum(value) FILTER (WHERE type IN ('GAIN') AND days_since_user_creation <= 30) AS value_received_30d,
  sum(value) FILTER (WHERE type IN ('PAYMENT') AND days_since_user_creation <= 30) AS total_engagement_30d,
  sum(value) FILTER (WHERE type IN ('PAYMENT') AND days_since_user_creation <= 60) AS value_spent_60d,
  sum(value) FILTER (WHERE type IN ('GAIN') AND days_since_user_creation <= 60) AS value_received_60d,
  sum(value) FILTER (WHERE type IN ('PAYMENT') AND days_since_user_creation <= 90) AS value_spent_90d,
  sum(value) FILTER (WHERE type IN ('GAIN') AND days_since_user_creation <= 90) AS value_received_90d,
  max(CASE WHEN days_since_user_creation <= 7 AND days_since_user_creation > 0 THEN 1 ELSE 0 END) AS reordered_7d
FROM ledger GROUP BY 1
""")
def window_sums(spark: SparkSession, sf: str) -> DataFrame:
    from tidemark.functions import within_days
    from tidemark.operators.attribution import cohort_sums
    o = Tables(spark, sf).orders
    firsts = o.groupBy("o_custkey").agg(F.min("o_orderdate").alias("first_at"))
    ledger = o.join(firsts, on="o_custkey").select(
        F.col("o_custkey").alias("user_id"),
        days_between("o_orderdate", "first_at").alias("days_since_user_creation"),
        case_label([(F.col("o_orderstatus") == "F", "PAYMENT"), (F.col("o_orderstatus") == "O", "GAIN")],
                   default="BONUS_USE").alias("type"),
        money("o_totalprice").alias("value"),
        (within_days("first_at", "o_orderdate", 7) * flag(days_between("o_orderdate", "first_at") > 0)).alias("__r"))
    sums = cohort_sums(ledger)
    re = ledger.groupBy("user_id").agg(F.max("__r").alias("reordered_7d"))
    return sums.join(re, on="user_id")


@register("concat_values", """
SELECT o_custkey,
       coalesce(string_agg(nullif(o_orderstatus, 'P'), ', ' ORDER BY nullif(o_orderstatus, 'P')), '') AS statuses
FROM orders GROUP BY 1
""")
def concat_values(spark: SparkSession, sf: str) -> DataFrame:
    o = Tables(spark, sf).orders.select("o_custkey", F.nullif("o_orderstatus", F.lit("P")).alias("statuses"))
    return aggs.concat_values(o, ["o_custkey"], "statuses")


@register("ratio_two_level", """
WITH l1 AS (
  SELECT CAST(l_shipdate AS DATE) AS _date, l_suppkey, l_returnflag,
         count(DISTINCT l_orderkey) AS n_orders, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS cost
  FROM lineitem GROUP BY 1, 2, 3),
l2 AS (SELECT _date, l_returnflag, sum(n_orders) AS users, sum(cost) AS cost FROM l1 GROUP BY 1, 2)
SELECT _date, l_returnflag, CAST(users AS BIGINT) AS users, cost,
       CAST(cost AS DOUBLE) / CAST(users AS DOUBLE) AS cost_per_user
FROM l2
""")
def ratio_two_level(spark: SparkSession, sf: str) -> DataFrame:
    li = Tables(spark, sf).lineitem
    l1 = li.groupBy(F.to_date("l_shipdate").alias("_date"), "l_suppkey", "l_returnflag").agg(
        F.countDistinct("l_orderkey").alias("n_orders"), F.sum(money("l_extendedprice")).alias("cost"))
    l2 = l1.groupBy("_date", "l_returnflag").agg(F.sum("n_orders").alias("users"), F.sum("cost").alias("cost"))
    return l2.withColumn("cost_per_user", F.col("cost").cast("double") / F.col("users").cast("double"))


# ---------------------------------------------------------------- reshape
@register("unpivot_measures", """
SELECT p_partkey, font, cost FROM (
  SELECT p_partkey, p_retailprice AS retail, CAST(nullif(p_size, 1) AS DOUBLE) AS size_d FROM part)
UNPIVOT INCLUDE NULLS (cost FOR font IN (retail, size_d))
""")
def unpivot_measures(spark: SparkSession, sf: str) -> DataFrame:
    p = Tables(spark, sf).part.select("p_partkey", F.col("p_retailprice").alias("retail"),
                                      F.nullif("p_size", F.lit(1)).cast("double").alias("size_d"))
    return reshape.unpivot_measures(p, "p_partkey")


@register("parse_measures", r"""
WITH sheet AS (
  SELECT l_orderkey, l_linenumber,
    CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN 'not-a-date'
         ELSE CAST(CAST(l_shipdate AS DATE) AS VARCHAR) END AS _,
    CASE WHEN l_returnflag = 'R' THEN '1.234,56' ELSE replace(CAST(l_extendedprice AS VARCHAR), '.', ',') END AS price,
    CASE WHEN l_linestatus = 'F' THEN '' ELSE replace(CAST(l_tax AS VARCHAR), '.', ',') END AS tax
  FROM lineitem)
SELECT l_orderkey, l_linenumber, try_cast(_ AS DATE) AS reference_date,
       try_cast(replace(price, ',', '.') AS DOUBLE) AS price,
       try_cast(replace(tax, ',', '.') AS DOUBLE) AS tax
FROM sheet
""")
def parse_measures(spark: SparkSession, sf: str) -> DataFrame:
    li = Tables(spark, sf).lineitem
    sheet = li.select(
        "l_orderkey", "l_linenumber",
        F.when((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "O"), F.lit("not-a-date"))
        .otherwise(F.to_date("l_shipdate").cast("string")).alias("_"),
        F.when(F.col("l_returnflag") == "R", F.lit("1.234,56"))
        .otherwise(replace_text(F.col("l_extendedprice").cast("string"), ".", ",")).alias("price"),
        F.when(F.col("l_linestatus") == "F", F.lit(""))
        .otherwise(replace_text(F.col("l_tax").cast("string"), ".", ",")).alias("tax"),
    )
    return reshape.parse_measure_columns(sheet, keep=("l_orderkey", "l_linenumber"))


# -------------------------------------------------------------- time zone
@register("tz_shift", """
SELECT event_id,
  CAST((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/Sao_Paulo' AS TIMESTAMP) AS local_ts,
  CAST((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/Sao_Paulo' AS DATE) AS local_day
FROM events
""")
def tz_shift(spark: SparkSession, sf: str) -> DataFrame:
    ev = Tables(spark, sf).events
    return ev.select("event_id", to_local("ts").alias("local_ts"), local_date("ts").alias("local_day"))


# ----------------------------------------------------------------- checks
@register("null_checks", """
SELECT 'lineitem' AS table_name, column_name, 'not_null' AS test, failures FROM (
  SELECT 'l_orderkey' AS column_name, CAST(count(*) FILTER (WHERE l_orderkey IS NULL) AS BIGINT) AS failures FROM lineitem
  UNION ALL SELECT 'l_partkey', CAST(count(*) FILTER (WHERE l_partkey IS NULL) AS BIGINT) FROM lineitem
  UNION ALL SELECT 'l_suppkey', CAST(count(*) FILTER (WHERE l_suppkey IS NULL) AS BIGINT) FROM lineitem
  UNION ALL SELECT 'l_shipdate', CAST(count(*) FILTER (WHERE l_shipdate IS NULL) AS BIGINT) FROM lineitem)
UNION ALL
SELECT 'lineitem', 'l_orderkey,l_linenumber', 'unique',
       CAST(count(*) FILTER (WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL)
            - count(DISTINCT (l_orderkey, l_linenumber)) AS BIGINT) FROM lineitem
UNION ALL
SELECT 'orders', 'o_orderkey', 'unique', CAST(count(o_orderkey) - count(DISTINCT o_orderkey) AS BIGINT) FROM orders
UNION ALL
SELECT 'orders', 'o_orderkey', 'not_null', CAST(count(*) FILTER (WHERE o_orderkey IS NULL) AS BIGINT) FROM orders
""")
def null_checks(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    return checks.run_checks({"lineitem": t.lineitem, "orders": t.orders}, {
        "lineitem": {"not_null": ["l_orderkey", "l_partkey", "l_suppkey", "l_shipdate"],
                     "unique": [["l_orderkey", "l_linenumber"]]},
        "orders": {"not_null": ["o_orderkey"], "unique": ["o_orderkey"]},
    })


@register("unique_checks", """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
GROUP BY 1, 2 HAVING count(*) > 1
""")
def unique_checks(spark: SparkSession, sf: str) -> DataFrame:
    return checks.check_unique(Tables(spark, sf).lineitem, ["l_orderkey", "l_linenumber"])


@register("passthrough_staging", "SELECT vec_id AS id, embedding, label FROM embeddings")
def passthrough_staging(spark: SparkSession, sf: str) -> DataFrame:
    """Staging that carries nested columns (here an array) unchanged."""
    return stage.stage(Tables(spark, sf).embeddings, [("vec_id", "id"), "embedding", "label"])


@register("coalesced_lookup", """
SELECT e.event_id, coalesce(c1.c_name, c2.c_name) AS name,
       replace(coalesce(c1.c_name, c2.c_name), '#', ' ') AS label
FROM events e
LEFT JOIN customer c1 ON c1.c_custkey = CASE WHEN e.event_type IN ('click', 'view') THEN e.user_id END
LEFT JOIN customer c2 ON c2.c_custkey = e.user_id + 100
""")
def coalesced_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Two look-ups on one dimension, first hit wins — the customer by
    the event's own number for click/view events, else by a second key."""
    t = Tables(spark, sf)
    ev = t.events.select("event_id", "user_id", "event_type").withColumns({
        "k1": F.when(F.col("event_type").isin("click", "view"), F.col("user_id")),
        "k2": F.col("user_id") + 100})
    out = joins.coalesced_lookup(ev, t.customer, ["k1", "k2"], "c_custkey", "c_name", name="name")
    return out.select("event_id", "name", replace_text("name", "#", " ").alias("label"))


# P12 / A10 / O1
@register("null_filters", """
WITH o AS (SELECT o_orderkey, nullif(o_orderpriority, '1-URGENT') AS priority,
             CASE WHEN o_orderstatus <> 'P' THEN o_totalprice > 100000 END AS large FROM orders)
SELECT t.kept, o_orderkey FROM o, (VALUES ('null'), ('not_null'), ('true')) t(kept)
WHERE (t.kept = 'null' AND priority IS NULL) OR (t.kept = 'not_null' AND priority IS NOT NULL)
  OR (t.kept = 'true' AND large IS TRUE)
""")
def null_filters(spark: SparkSession, sf: str) -> DataFrame:
    o = Tables(spark, sf).orders.select(
        "o_orderkey", F.nullif("o_orderpriority", F.lit("1-URGENT")).alias("priority"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice") > 100000).alias("large"))
    frames = [(predicates.keep_null(o, "priority"), "null"), (predicates.keep_not_null(o, "priority"), "not_null"),
              (predicates.keep_true(o, "large"), "true")]
    return stage.stack_rows(*[stage.with_constants(df, {"kept": kept}).select("kept", "o_orderkey")
                              for df, kept in frames])


@register("mean_cost", """
SELECT CAST(l_shipdate AS DATE) AS day,
  CAST(CASE WHEN sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) = 0 THEN 0
    ELSE sum(CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS BIGINT) END)
         / sum(CASE WHEN l_returnflag = 'R' THEN 1 END) END AS DOUBLE) AS cost
FROM lineitem GROUP BY 1
""")
def mean_cost(spark: SparkSession, sf: str) -> DataFrame:
    li = Tables(spark, sf).lineitem
    cost = F.when(F.col("l_returnflag") == "R", F.col("l_quantity").cast("long"))
    return aggs.grouped(li, {"day": F.to_date("l_shipdate")}, {"cost": aggs.mean_or_zero(cost)})


@register("ordered_rows", """
SELECT o_orderkey, o_custkey, nullif(o_orderpriority, '5-LOW') AS priority FROM orders
""")
def ordered_rows(spark: SparkSession, sf: str) -> DataFrame:
    """O1/O3: the sink's order; the oracle compares the rows, a test their order."""
    o = Tables(spark, sf).orders.select("o_orderkey", "o_custkey",
                                        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"))
    return stage.ordered(o, [("priority", "desc"), ("o_custkey", "asc"), ("o_orderkey", "asc")], pg_nulls=True)
