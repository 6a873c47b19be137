"""Driver queries for the attribution operators and the composite marts.

Spark side: fixtures (shared SQL, lazily over the parquet scans) fed to the
library's operators and marts. Oracle side: the same fixtures and the SQL of
``mart_oracles``, which is written from the marts' meaning and shares no
steps with them; PostgreSQL null ordering is spelled out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import attribution
from tidemark.plans import marts
from tidemark.plans.mart_oracles import ORIGIN, acquisition_sql, money_sql, user_sql, visit_rules
from tidemark.plans.fixtures import (
    AS_OF,
    LEAGUE_SINCE,
    SPINE_END,
    SPINE_START,
    SUBSCRIPTION_USERS_SINCE,
    Fixtures,
    fixture_cte,
)
from tidemark.operators.reshape import date_spine
from tidemark.sources.files import stage_table

REGISTRY: dict[str, object] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None):
    def deco(fn):
        REGISTRY[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _ua_inputs(fx: Fixtures) -> dict:
    pages = fx.pages.withColumnRenamed("ts", "timestamp")
    id_graph = fx.id_graph.withColumnRenamed("ts", "timestamp")
    return dict(users=fx.users, pages=pages, id_graph=id_graph, identifiers=fx.identifiers,
                campaign_dim=fx.campaign_dim, referrals=fx.referrals, coupon_items=fx.coupon_items,
                coupons=fx.coupons, challenges=fx.challenges, deposits=fx.deposits, fb_insights=fx.fb_insights,
                fb_ads=fx.fb_ads, fb_campaigns=fx.fb_campaigns, google_reports=fx.google_reports,
                accounts=fx.accounts, wallets=fx.wallets, wallet_transactions=fx.wallet_transactions,
                blocklist=fx.user_blocklist)


def _staged(act: DataFrame) -> DataFrame:
    """The attributed users are read six times: written once, re-read."""
    return stage_table(act, "attribution_base")


def _user_attribution(spark: SparkSession, sf: str, persist: bool = True, **kw) -> DataFrame:
    fx = Fixtures(spark, sf)
    return marts.user_attribution(**_ua_inputs(fx), as_of=AS_OF, staged=_staged if persist else None, **kw)


# ------------------------------------------------------------ M1-M13 pieces
@register("identity_resolution", user_sql("SELECT v.page_id, w.user_id, v.ts FROM pages v JOIN owner w USING (segment_id)"))
def identity_resolution(spark: SparkSession, sf: str) -> DataFrame:
    fx = Fixtures(spark, sf)
    ins = _ua_inputs(fx)
    out = attribution.resolve_identity(ins["pages"], ins["id_graph"], ins["identifiers"],
                                       ins["users"].select("user_id"))
    return out.select("page_id", "user_id", F.col("timestamp").alias("ts"))


@register("identity_resolution_salted", user_sql("SELECT v.page_id, w.user_id, v.ts FROM pages v JOIN owner w USING (segment_id)"))
def identity_resolution_salted(spark: SparkSession, sf: str) -> DataFrame:
    """M1 with the event -> edge join salted over 16 buckets (hot segment ids)."""
    fx = Fixtures(spark, sf)
    ins = _ua_inputs(fx)
    out = attribution.resolve_identity(ins["pages"], ins["id_graph"], ins["identifiers"],
                                       ins["users"].select("user_id"), salt_buckets=16)
    return out.select("page_id", "user_id", F.col("timestamp").alias("ts"))


@register("classify_visits", user_sql(
    "SELECT page_id, user_id, medium, source, campaign, content, term FROM visit"))
def classify_visits(spark: SparkSession, sf: str) -> DataFrame:
    fx = Fixtures(spark, sf)
    ins = _ua_inputs(fx)
    v = attribution.resolve_identity(ins["pages"], ins["id_graph"], ins["identifiers"],
                                     ins["users"].select("user_id", "created_at"))
    v = attribution.visits_in_window(v, None, 30, own_site_like=marts.OWN_SITE_REFERRER)
    v = attribution.classify_visits(v, ins["campaign_dim"])
    return v.select("page_id", "user_id", "medium", "source", "campaign", "content", "term")


@register("referral_attribution", user_sql(
    "SELECT user_id, ts, 'mgm' AS medium, source, mgm_cost FROM invited"))
def referral_attribution(spark: SparkSession, sf: str) -> DataFrame:
    fx = Fixtures(spark, sf)
    m = attribution.referral_touches(fx.referrals, fx.users, tiebreak=[("referral_id", "desc")])
    return m.select("user_id", F.col("timestamp").alias("ts"), "medium", "source",
                    F.col("mgm_cost").cast("decimal(20,5)").alias("mgm_cost"))


@register("priority_attribution", user_sql(
    "SELECT user_id, medium, medium_agg, source, campaign, campaign_agg, page_path, mgm_cost FROM credited"))
def priority_attribution(spark: SparkSession, sf: str) -> DataFrame:
    att = marts.attributed_touches(**{k: v for k, v in _ua_inputs(Fixtures(spark, sf)).items()
                                      if k in ("users", "pages", "id_graph", "identifiers", "campaign_dim",
                                               "referrals")})
    return att.select("user_id", "medium", "medium_agg", "source", "campaign", "campaign_agg", "page_path",
                      "mgm_cost")


@register("bucket_labels", user_sql(
    "SELECT user_id, first_coupon_gamemode, original_gamemode, first_coupon_at FROM person"))
def bucket_labels(spark: SparkSession, sf: str) -> DataFrame:
    ua = _user_attribution(spark, sf, persist=False)
    return ua.select("user_id", "first_coupon_gamemode", "original_gamemode", "first_coupon_at")


@register("campaign_cost", user_sql("SELECT day AS _date, campaign, cost, network FROM paid"))
def campaign_cost(spark: SparkSession, sf: str) -> DataFrame:
    fx = Fixtures(spark, sf)
    g, fb = marts.network_costs(fx.google_reports, fx.fb_insights, fx.fb_ads, fx.fb_campaigns)
    return (g.cost.withColumn("network", F.lit("adwords"))
            .unionByName(fb.cost.withColumn("network", F.lit("facebook-ads"))))


_UNTRACKED_SQL = user_sql("SELECT day AS _date, cost, network, basis FROM unspent")


@register("untracked_cost", _UNTRACKED_SQL)
def untracked_cost(spark: SparkSession, sf: str) -> DataFrame:
    parts = marts.user_attribution(**_ua_inputs(Fixtures(spark, sf)), as_of=AS_OF,
                                   return_parts=True)
    frames = []
    for basis in ("cpl", "cac"):
        for network, df in parts["untracked"][basis].items():
            frames.append(df.select("_date", "cost", F.lit(network).alias("network"), F.lit(basis).alias("basis")))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


@register("cost_with_excess", user_sql(
    "SELECT day, medium_agg, source, campaign, users, campaign_cost, rate, basis FROM rate"))
def cost_with_excess(spark: SparkSession, sf: str) -> DataFrame:
    parts = marts.user_attribution(**_ua_inputs(Fixtures(spark, sf)), as_of=AS_OF,
                                   return_parts=True)
    cpl = parts["rates_full"]["cpl"].select(F.col("created_at").alias("day"), "medium_agg", "source", "campaign",
                                            "users", "campaign_cost", F.col("cpl").alias("rate"),
                                            F.lit("cpl").alias("basis"))
    cac = parts["rates_full"]["cac"].select(F.col("first_coupon_at").alias("day"), "medium_agg", "source",
                                            "campaign", "users", "campaign_cost", F.col("cac").alias("rate"),
                                            F.lit("cac").alias("basis"))
    return cpl.union(cac)


@register("engagement_ledger", user_sql(
    "SELECT user_id, transaction_date, days_since_user_creation, type, value FROM engagement"))
def engagement_ledger(spark: SparkSession, sf: str) -> DataFrame:
    fx = Fixtures(spark, sf)
    return attribution.engagement_ledger(fx.users, fx.accounts, fx.wallets, fx.wallet_transactions)


@register("cohort_sums", user_sql("SELECT * FROM cohort"))
def cohort_sums(spark: SparkSession, sf: str) -> DataFrame:
    fx = Fixtures(spark, sf)
    return attribution.cohort_sums(attribution.engagement_ledger(fx.users, fx.accounts, fx.wallets,
                                                                 fx.wallet_transactions))


@register("ban_status", user_sql("SELECT * FROM ban"))
def ban_status(spark: SparkSession, sf: str) -> DataFrame:
    return attribution.ban_status(Fixtures(spark, sf).user_blocklist, AS_OF)


# --------------------------------------------------------------- M14 / M16
@register("user_attribution", user_sql("SELECT * FROM attributed"))
def user_attribution(spark: SparkSession, sf: str) -> DataFrame:
    return _user_attribution(spark, sf)


# Users of the data that the query leaves out; most are referrers of others.
EXCLUDED = (4, 7, 14, 17, 40, 44, 56, 103, 133)


@register("user_attribution_excluding", user_sql("SELECT * FROM attributed", EXCLUDED))
def user_attribution_excluding(spark: SparkSession, sf: str) -> DataFrame:
    """M14 without some users: they are no rows and count for no rate, but still refer others."""
    return _user_attribution(spark, sf, excluded_users=EXCLUDED)


@register("acquisition_daily", acquisition_sql())
def acquisition_daily(spark: SparkSession, sf: str) -> DataFrame:
    # the attribution mart is a table upstream and is read twice here
    att = stage_table(_user_attribution(spark, sf), "user_attribution")
    spine = date_spine(spark, SPINE_START, SPINE_END)
    return marts.acquisition_daily(att, Fixtures(spark, sf).ads_cost, spine)


# ------------------------------------------------------------------- M17
def _banned(fx: Fixtures) -> DataFrame:
    return marts.banned_users(fx.blocklist_events, fx.user_notes, fx.payouts, fx.gateway_transactions, fx.accounts)


@register("banned_users", money_sql("SELECT * FROM banned"))
def banned_users(spark: SparkSession, sf: str) -> DataFrame:
    return _banned(Fixtures(spark, sf))


# ---------------------------------------------------------------- M18-M20
def _coupons_finished(fx: Fixtures) -> DataFrame:
    return marts.coupons_finished(fx.coupons, fx.grouped_challenges, _banned(fx), fx.transactions,
                                  fx.transaction_items, fx.wallets, fx.accounts, fx.super_tips, fx.coupon_items,
                                  fx.reputations, fx.match_players, fx.players)


@register("coupons_finished", money_sql("SELECT * FROM finished"))
def coupons_finished(spark: SparkSession, sf: str) -> DataFrame:
    return _coupons_finished(Fixtures(spark, sf))


@register("signed_settlement", money_sql("""
SELECT coupon_id, coupon_status, currency, balance_amount, user_balance_amount, balance_amount_bonus,
       user_balance_amount_bonus FROM finished"""))
def signed_settlement(spark: SparkSession, sf: str) -> DataFrame:
    return _coupons_finished(Fixtures(spark, sf)).select(
        "coupon_id", "coupon_status", "currency", "balance_amount", "user_balance_amount", "balance_amount_bonus",
        "user_balance_amount_bonus")


# ---------------------------------------------------------------- M21-M23
def _financial(spark: SparkSession, sf: str) -> DataFrame:
    """The coupon fact is a table upstream of the daily mart; it and the
    ledger's rows by feed are written once to the shared folder and re-read."""
    fx = Fixtures(spark, sf)
    cf = stage_table(_coupons_finished(fx), "coupons_finished")
    return marts.financial_daily(fx.transactions_finished, cf, fx.league_points, fx.coupon_items, fx.challenges,
                                 fx.users, league_since=LEAGUE_SINCE,
                                 subscription_users_since=SUBSCRIPTION_USERS_SINCE,
                                 staged=lambda rows: stage_table(rows, "ledger_rows", ["feed"]))


@register("financial_daily", money_sql("SELECT * FROM daily"))
def financial_daily(spark: SparkSession, sf: str) -> DataFrame:
    return _financial(spark, sf)


@register("typed_ledger", money_sql(
    "SELECT reference_date, user_id, gamemode, transaction_id, amount, type FROM booked"))
def typed_ledger(spark: SparkSession, sf: str) -> DataFrame:
    fx = Fixtures(spark, sf)
    # the coupon fact is a table upstream and gives two of the feeds
    rows = marts.typed_ledger(fx.transactions_finished, stage_table(_coupons_finished(fx), "coupons_finished"),
                              fx.league_points, fx.coupon_items, fx.challenges, fx.users, league_since=LEAGUE_SINCE,
                              subscription_users_since=SUBSCRIPTION_USERS_SINCE)
    return rows.select("reference_date", "user_id", "gamemode", "transaction_id", "amount", "type")


# ------------------------------------------------------------------- M26
@register("message_log", fixture_cte("messages", "users") + """
SELECT CAST((m.date_sent AT TIME ZONE 'UTC') AT TIME ZONE 'America/Sao_Paulo' AS TIMESTAMP) AS date_sent,
  coalesce(ut.user_id, uf.user_id) AS user_id, replace(m."to", 'whatsapp:', '') AS send_to,
  replace(m."from", 'whatsapp:', '') AS "from", m.body AS message, coalesce(m.price, 0) AS price, m.status,
  replace(m.direction, '-api', '') AS direction
FROM messages m
LEFT JOIN users ut ON ut.tel = replace(m."to", 'whatsapp:', '')
LEFT JOIN users uf ON uf.tel = replace(m."from", 'whatsapp:', '')""")
def message_log(spark: SparkSession, sf: str) -> DataFrame:
    fx = Fixtures(spark, sf)
    return marts.message_log(fx.messages, fx.users)


# ------------------------------------------------------------- M24 / M25
@register("exchange_series", """
WITH rates AS (SELECT CAST(o_orderdate AS DATE) - CAST((CAST(o_orderdate AS DATE) - DATE '1992-01-01') % 10 AS INTEGER)
                 AS reference_date, CAST(min(o_totalprice) AS DECIMAL(18,2)) AS exchange
               FROM orders GROUP BY 1),
spine AS (SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '2001-08-01', INTERVAL 1 DAY)) AS DATE) AS _date),
weekly AS (SELECT CAST(date_trunc('week', reference_date) AS DATE) AS wk, avg(exchange) AS exchange FROM rates GROUP BY 1)
SELECT s._date AS reference_date, CAST(round(coalesce(r.exchange, w.exchange), 4) AS DECIMAL(18,4)) AS exchange
FROM spine s
LEFT JOIN rates r ON r.reference_date = s._date
LEFT JOIN weekly w ON CAST(date_trunc('week', s._date) AS DATE) = w.wk AND r.exchange IS NULL
""")
def exchange_series(spark: SparkSession, sf: str) -> DataFrame:
    """M24 on a calendar from a fixed start to ``as_of`` (here the last order
    day). Every order counts for the first of its ten days, so most days and
    some whole weeks have no rate of their own."""
    from tidemark.sources.files import Tables
    day = F.to_date("o_orderdate")
    first = F.date_sub(day, F.date_diff(day, F.lit("1992-01-01").cast("date")) % 10)
    rates = Tables(spark, sf).orders.groupBy(first.alias("reference_date")).agg(
        F.min("o_totalprice").cast("decimal(18,2)").alias("exchange"))
    out = marts.exchange_series(rates, date_spine(spark, SPINE_START, SPINE_END))
    return out.withColumn("exchange", F.col("exchange").cast("decimal(18,4)"))


@register("ads_cost_series", fixture_cte("ads_cost") + f"""
SELECT CAST(reference_date AS DATE) AS reference_date, cost, font FROM ads_cost
WHERE CAST(reference_date AS DATE) < DATE '{AS_OF}'""")
def ads_cost_series(spark: SparkSession, sf: str) -> DataFrame:
    """The long cost table, days before ``as_of`` only."""
    return marts.ads_cost_series(Fixtures(spark, sf).ads_cost, AS_OF)


# ------------------------------------------------------------- M28 / M30
@register("ads_staging", """
SELECT CAST(l_orderkey AS VARCHAR) AS ad_id, CAST(l_partkey AS VARCHAR) AS campaign_id,
  CAST(l_discount AS FLOAT) AS cpc, CAST(l_tax AS FLOAT) AS ctr, CAST(l_extendedprice AS FLOAT) AS spend,
  CAST(l_shipdate AS DATE) AS date_start
FROM lineitem""")
def ads_staging(spark: SparkSession, sf: str) -> DataFrame:
    """Ad-platform staging — rename ids, rates and spend to 32-bit
    float (``::float`` is single precision in Spark SQL)."""
    from tidemark.operators.stage import stage
    from tidemark.sources.files import Tables
    li = Tables(spark, sf).lineitem
    return stage(li, [("l_orderkey", "ad_id"), ("l_partkey", "campaign_id"), ("l_discount", "cpc"),
                      ("l_tax", "ctr"), ("l_extendedprice", "spend"), (F.to_date("l_shipdate"), "date_start")],
                 casts={"ad_id": "string", "campaign_id": "string", "cpc": "float", "ctr": "float", "spend": "float"})


@register("event_staging", """
SELECT event_id AS id, user_id, event_type AS event, props AS context,
  CAST((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/Sao_Paulo' AS TIMESTAMP) AS "timestamp", ts AS received_at
FROM events""")
def event_staging(spark: SparkSession, sf: str) -> DataFrame:
    """Event staging — projection, renamed id, local wall-clock time."""
    from tidemark.functions import to_local
    from tidemark.operators.stage import stage
    from tidemark.sources.files import Tables
    ev = Tables(spark, sf).events
    return stage(ev, [("event_id", "id"), "user_id", ("event_type", "event"), ("props", "context"),
                      (to_local("ts"), "timestamp"), ("ts", "received_at")])


# ---------------------------------------------------------------- M2 on pages
_PAGE_VISITS = r"""
visits AS (
  SELECT page_id,
    nullif(regexp_extract(url, 'utm_source=([^&#]+)', 1), '') AS campaign_source,
    CAST(NULL AS VARCHAR) AS campaign_medium,
    nullif(regexp_extract(url, '[?&]ref=([^&#]+)', 1), '') AS campaign_name,
    CAST(NULL AS VARCHAR) AS campaign_content, CAST(NULL AS VARCHAR) AS campaign_term,
    regexp_extract(url, '^https?://[^/]+(/[^?#]*)', 1) AS path,
    CASE WHEN url LIKE '%#top' THEN NULL ELSE url END AS referrer
  FROM pages)"""


@register("classify_pages", f"""WITH {_PAGE_VISITS}
SELECT v.page_id, m.medium, m.source,
  coalesce(v.campaign_name, CASE WHEN contains(v.path, 'blog') THEN v.path END) AS campaign
FROM visits v, {ORIGIN}, {visit_rules('CAST(NULL AS VARCHAR)')}""")
def classify_pages(spark: SparkSession, sf: str) -> DataFrame:
    """M2/S9/T4 on the raw page table: every URL is parsed (path, campaign
    parameters) with regex and classified by the ordered rules."""
    from tidemark.sources.files import Tables
    p = Tables(spark, sf).pages.select("page_id", "url")
    visits = p.select(
        "page_id",
        F.nullif(F.regexp_extract("url", r"utm_source=([^&#]+)", 1), F.lit("")).alias("campaign_source"),
        F.lit(None).cast("string").alias("campaign_medium"),
        F.nullif(F.regexp_extract("url", r"[?&]ref=([^&#]+)", 1), F.lit("")).alias("campaign_name"),
        F.lit(None).cast("string").alias("campaign_content"), F.lit(None).cast("string").alias("campaign_term"),
        F.regexp_extract("url", r"^https?://[^/]+(/[^?#]*)", 1).alias("path"),
        F.when(F.col("url").like("%#top"), F.lit(None)).otherwise(F.col("url")).alias("referrer"))
    out = attribution.classify_visits(visits)
    return out.select("page_id", "medium", "source", "campaign")


# ------------------------------------------------------------ Q3 on marts
@register("grain_checks", money_sql("""
SELECT table_name, column_name, test,
  CAST(if(test = 'not_null', rows_ - filled, filled - kinds) AS BIGINT) AS failures
FROM (SELECT 'banned_users' AS table_name, 'user_id' AS column_name, count(*) AS rows_, count(user_id) AS filled,
        count(DISTINCT user_id) AS kinds FROM banned
      UNION ALL SELECT 'coupons_finished', 'coupon_id', count(*), count(coupon_id), count(DISTINCT coupon_id)
      FROM finished), (VALUES ('not_null'), ('unique')) t(test)"""))
def grain_checks(spark: SparkSession, sf: str) -> DataFrame:
    """Q3 on the composites' grain, as the source schema tests state it: one
    row per banned user, one row per finished coupon. The coupon grain is
    broken by duplicate match-player keys in the inputs (T19) and the check
    reports how many extra rows that makes."""
    from tidemark.operators.checks import run_checks
    fx = Fixtures(spark, sf)
    return run_checks({"banned_users": _banned(fx), "coupons_finished": _coupons_finished(fx)}, {
        "banned_users": {"not_null": ["user_id"], "unique": ["user_id"]},
        "coupons_finished": {"not_null": ["coupon_id"], "unique": ["coupon_id"]},
    })


# ------------------------------------------------- materialised model chain
@register("materialised_financial", money_sql("SELECT * FROM daily"))
def materialised_financial(spark: SparkSession, sf: str) -> DataFrame:
    """IO2/IO10/IO12: banned users -> finished coupons -> daily financial,
    each written (clustered) under the shared folder and read back by the
    next model; returns the written daily financial table."""
    import uuid

    from tidemark.plans.build import build_financial_marts
    from tidemark.session import checkpoint_dir

    fx = Fixtures(spark, sf)
    inputs = {n: getattr(fx, n) for n in (
        "user_notes", "payouts", "gateway_transactions", "accounts", "coupons", "grouped_challenges",
        "transactions", "transaction_items", "wallets", "super_tips", "coupon_items", "reputations",
        "match_players", "players", "transactions_finished", "league_points", "challenges", "users")}
    inputs["blocklist"] = fx.blocklist_events
    out = f"{checkpoint_dir(spark).rstrip('/')}/marts-{uuid.uuid4().hex}"
    paths = build_financial_marts(spark, inputs, out, league_since=LEAGUE_SINCE,
                                  subscription_users_since=SUBSCRIPTION_USERS_SINCE)
    return spark.read.parquet(paths["financial_daily"])


@register("materialised_attribution", acquisition_sql())
def materialised_attribution(spark: SparkSession, sf: str) -> DataFrame:
    """IO2/IO10/IO12: user attribution -> daily acquisition, each written
    under the shared folder; returns the written daily acquisition table."""
    import uuid

    from tidemark.plans.build import build_attribution_marts
    from tidemark.session import checkpoint_dir

    fx = Fixtures(spark, sf)
    out = f"{checkpoint_dir(spark).rstrip('/')}/marts-{uuid.uuid4().hex}"
    paths = build_attribution_marts(spark, _ua_inputs(fx), out, AS_OF, date_spine(spark, SPINE_START, SPINE_END),
                                    fx.ads_cost)
    return spark.read.parquet(paths["acquisition_daily"])
