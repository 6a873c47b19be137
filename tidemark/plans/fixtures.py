"""Reference-shaped inputs derived from the driver's tables.

Each fixture is one SELECT in the SQL subset that Spark and DuckDB share,
so the Spark driver query and the DuckDB oracle read *the same* inputs while
the mart logic itself is written independently on each side (DataFrame
operators vs. hand-written SQL). Spark evaluates the fixtures lazily over
the parquet scans; they grow with the tables.

Stand-ins: customers are users (their first order is the sign-up), orders
are coupons / page visits / referrals / identity edges, line items are
wallet and ledger transactions and ad-network cost rows, suppliers are
challenges, events are bans (error), payouts (purchase) and gateway
attempts (all others); line items belong to one of two ad networks.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources.files import read_source

BASE_TABLES = ("customer", "orders", "lineitem", "part", "supplier", "nation", "events")

FIXTURES: dict[str, str] = {
    "users": """
SELECT c.c_custkey AS user_id, f.first_at AS created_at,
  f.first_at + CASE WHEN c.c_nationkey < 8 THEN INTERVAL 2 DAY
                    WHEN c.c_nationkey < 16 THEN INTERVAL 7 DAY ELSE INTERVAL 9 DAY END AS first_login,
  c.c_name AS email, CAST(c.c_custkey AS STRING) AS tel
FROM customer c
JOIN (SELECT o_custkey, min(o_orderdate) AS first_at FROM orders GROUP BY o_custkey) f ON f.o_custkey = c.c_custkey""",
    "coupons": """
SELECT o_orderkey AS coupon_id, o_custkey AS user_id, o_orderdate AS created_at,
  CASE o_orderstatus WHEN 'F' THEN 'WON' WHEN 'O' THEN 'LOST' ELSE 'REFUND' END AS coupon_status,
  CASE WHEN o_orderpriority = '5-LOW' THEN 'FREE' ELSE 'NORMAL' END AS type,
  CAST(o_totalprice AS DECIMAL(18,2)) AS amount,
  CAST(1 + CAST(substr(o_orderpriority, 1, 1) AS INT) * 0.25 AS DECIMAL(18,2)) AS odd,
  CAST(NULL AS BIGINT) AS rollover_id,
  CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS grouped_challenge_id,
  o_orderpriority AS origin
FROM orders""",
    "grouped_challenges": """
SELECT DISTINCT CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS grouped_challenge_id, o_orderpriority AS name,
  CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'LOL1V1' WHEN '2' THEN 'VALEXTERNALRANKED'
       WHEN '4' THEN 'TFTEXTERNALRANKED' END AS gamemode,
  CASE substr(o_orderpriority, 1, 1) WHEN '3' THEN 'LOLEXTERNALARAM' WHEN '5' THEN 'CS2EXTERNALRANKED'
       ELSE 'LOLEXTERNAL5V5' END AS external_gamemode
FROM orders""",
    "challenges": """
SELECT s.s_suppkey AS challenge_id,
  CASE WHEN s.s_nationkey = 24 THEN 'CHESSEXTERNAL' WHEN n.n_regionkey = 0 THEN 'LOLEXTERNAL5V5'
       WHEN n.n_regionkey = 1 THEN 'TFTEXTERNALRANKED' WHEN n.n_regionkey = 2 THEN 'CS2EXTERNALRANKED'
       WHEN n.n_regionkey = 3 THEN 'VALEXTERNALRANKED' END AS external_gamemode,
  CASE WHEN n.n_regionkey = 4 THEN 'LOL2V2' END AS gamemode
FROM supplier s JOIN nation n ON n.n_nationkey = s.s_nationkey""",
    "coupon_items": """
SELECT l_orderkey AS coupon_id, l_orderkey * 10 + l_linenumber AS external_match_id, l_suppkey AS challenge_id,
  l_shipdate AS created_at
FROM lineitem""",
    "league_points": """
SELECT DISTINCT l_partkey AS league_id, l_orderkey * 10 + l_linenumber AS external_match_id
FROM lineitem""",
    "transactions_finished": """
SELECT l.l_shipdate AS created_at, l.l_shipdate + INTERVAL 1 DAY AS updated_at, o.o_custkey AS user_id,
  l.l_partkey AS league_id, l.l_orderkey AS coupon_id, l.l_orderkey * 10 + l.l_linenumber AS transaction_id,
  CASE WHEN l.l_quantity > 48 THEN 'SUBSCRIPTION_OLD_USER'
       WHEN l.l_returnflag = 'A' AND l.l_linestatus = 'F' THEN 'COUPON'
       WHEN l.l_returnflag = 'A' THEN 'COUPON_REFUND'
       WHEN l.l_returnflag = 'N' AND l.l_linestatus = 'F' THEN 'LEAGUE_REGISTRATION'
       WHEN l.l_returnflag = 'N' THEN 'PAYIN'
       WHEN l.l_linestatus = 'F' THEN 'PAYOUT'
       ELSE 'BONUS' END AS transaction_type,
  CASE WHEN l.l_tax >= 0.06 THEN 'CREDIT' WHEN l.l_tax <= 0.01 THEN 'ARTIFICIAL'
       WHEN l.l_tax = 0.02 THEN 'ARTIFICIAL_UNBANNED' ELSE 'DEBIT' END AS debit_credit,
  CASE WHEN l.l_discount >= 0.08 THEN 'BONUS_BRL' ELSE 'BRL' END AS wallet_currency,
  CAST(l.l_extendedprice AS DECIMAL(18,2)) AS absolut_amount,
  CAST(l.l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l.l_discount AS DECIMAL(18,2))) AS amount_rev
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey""",
    "accounts": """
SELECT c_custkey AS account_id, c_custkey AS user_id,
  CASE WHEN c_mktsegment = 'BUILDING' THEN 'HOUSE_ACCOUNT' ELSE 'PLAYER_ACCOUNT' END AS type
FROM customer""",
    "wallets": """
SELECT c_custkey * 2 AS wallet_id, c_custkey AS account_id, 'BRL' AS currency FROM customer
UNION ALL
SELECT c_custkey * 2 + 1 AS wallet_id, c_custkey AS account_id, 'BONUS_BRL' AS currency FROM customer""",
    "transactions": """
SELECT l_orderkey * 10 + l_linenumber AS transaction_id, 'COUPON' AS type, l_orderkey AS coupon_id FROM lineitem""",
    "transaction_items": """
SELECT l.l_orderkey * 10 + l.l_linenumber AS transaction_id,
  o.o_custkey * 2 + CASE WHEN l.l_discount >= 0.08 THEN 1 ELSE 0 END AS wallet_id,
  CASE WHEN l.l_linenumber = 1 THEN 'CREDIT' ELSE 'DEBIT' END AS status
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey""",
    "super_tips": """
SELECT o_orderkey AS coupon_id FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'""",
    "players": """
SELECT c_custkey AS external_player_id, c_custkey AS user_id, 'LOLEXTERNAL5V5' AS external_gamemode FROM customer""",
    "match_players": """
SELECT l.l_orderkey * 10 + l.l_linenumber AS external_match_player_id,
  l.l_orderkey * 10 + l.l_linenumber AS external_match_id, o.o_custkey AS external_player_id
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey""",
    "reputations": """
SELECT l_orderkey * 10 + l_linenumber AS external_match_player_id,
  CAST(l_extendedprice AS DECIMAL(18,2)) AS max_amount, l_returnflag AS metadata
FROM lineitem""",
    "blocklist_events": """
SELECT event_id AS user_blocklist_id, user_id, ts AS created_at, props AS description, value >= 50 AS active_ban,
  ts + CASE WHEN value < 150 THEN INTERVAL 30 DAY ELSE INTERVAL 3650 DAY END AS expiry, event_id AS user_notes_id
FROM events WHERE event_type = 'error'""",
    "user_notes": """
SELECT event_id AS user_notes_id, props AS notes, event_type AS flag, value > 100 AS cheat, value > 200 AS smurf,
  value > 300 AS derank, value > 350 AS duo_boost, value < 10 AS slow_climb, 'LOL1V1' AS gamemode
FROM events WHERE event_type = 'error' AND value < 400""",
    "payouts": """
SELECT user_id, ts AS created_at, event_id AS transaction_id, CAST(value AS DECIMAL(18,2)) AS absolut_amount,
  'PAYOUT' AS transaction_type
FROM events WHERE event_type = 'purchase'""",
    "gateway_transactions": """
SELECT user_id AS account_id, ts AS created_at, event_id AS transaction_id, CAST(value AS DECIMAL(18,2)) AS amount,
  CASE WHEN value > 250 THEN 'PAID' ELSE 'FAILED' END AS status, 'STARKBANK' AS gateway_name
FROM events WHERE event_type NOT IN ('error', 'purchase')""",
    "pages": """
SELECT o_orderkey AS page_id, CONCAT('s', CAST(o_custkey AS STRING)) AS segment_id,
  o_orderdate - CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN INTERVAL 1 DAY WHEN '2' THEN INTERVAL 3 DAY
       WHEN '3' THEN INTERVAL 10 DAY WHEN '4' THEN INTERVAL 31 DAY ELSE INTERVAL 0 DAY END AS ts,
  CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'influencer' WHEN '2' THEN 'adwords'
       WHEN '3' THEN 'facebook-ads' END AS campaign_source,
  CASE WHEN substr(o_orderpriority, 1, 1) IN ('2', '3') THEN 'paid-media' END AS campaign_medium,
  CASE WHEN substr(o_orderpriority, 1, 1) IN ('1', '2', '3') THEN o_orderstatus END AS campaign_name,
  CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'organic' END AS campaign_content,
  CAST(NULL AS STRING) AS campaign_term,
  CASE WHEN o_orderstatus = 'P' THEN '/blog/post' ELSE '/home' END AS path,
  CASE WHEN o_orderstatus = 'F' THEN 'https://www.google.com/search'
       WHEN o_orderstatus = 'O' THEN 'https://www.instagram.com/p/1'
       WHEN substr(o_orderpriority, 1, 1) = '5' THEN NULL
       ELSE 'https://partner.example.org/x' END AS referrer
FROM orders""",
    "id_graph": """
SELECT CONCAT('s', CAST(o_custkey AS STRING)) AS segment_id,
  CONCAT('c', CAST(o_custkey AS STRING), '-', o_orderstatus) AS canonical_segment_id, o_orderdate AS ts
FROM orders""",
    "identifiers": """
SELECT DISTINCT CONCAT('c', CAST(o_custkey AS STRING), '-', o_orderstatus) AS canonical_segment_id,
  'user_id' AS type, o_custkey AS value FROM orders
UNION ALL
SELECT DISTINCT CONCAT('c', CAST(o_custkey AS STRING), '-', o_orderstatus) AS canonical_segment_id,
  'email' AS type, o_custkey + 100000 AS value FROM orders""",
    "campaign_dim": """
SELECT DISTINCT o_orderstatus AS source_name, CONCAT('infl-', o_orderstatus) AS influencer FROM orders""",
    "referrals": """
SELECT o_orderkey AS referral_id, o_custkey * 10 + 3 AS referred_id,
  o_custkey + 1 AS referrer_id, o_orderdate AS created_at,
  CASE WHEN o_orderstatus = 'F' THEN 'FINISHED' ELSE 'PENDING' END AS status,
  CAST(o_totalprice AS DECIMAL(18,2)) * 0.001 AS reward
FROM orders""",
    "deposits": """
SELECT o_custkey AS user_id, CAST(o_orderdate AS DATE) AS reference_date FROM orders WHERE o_orderstatus = 'F'""",
    "fb_insights": """
SELECT l_partkey AS ad_id, l_shipdate AS date_start, CAST(l_extendedprice AS DECIMAL(18,2)) AS spend
FROM lineitem WHERE l_returnflag = 'N'""",
    "fb_ads": """
SELECT p_partkey AS id, CASE p_type WHEN 'ECONOMY' THEN 'F' WHEN 'PROMO' THEN 'O' WHEN 'LARGE' THEN NULL
       ELSE 'P' END AS campaign_id
FROM part""",
    "fb_campaigns": """
SELECT DISTINCT o_orderstatus AS id FROM orders WHERE o_orderstatus <> 'P'""",
    "google_reports": """
SELECT l_shipdate AS date_stop, l_linestatus AS campaign_id, CAST(round(l_extendedprice * 10000) AS BIGINT) AS cost
FROM lineitem WHERE l_returnflag <> 'N'""",
    "wallet_transactions": """
SELECT o.o_custkey * 2 + CASE WHEN l.l_discount >= 0.08 THEN 1 ELSE 0 END AS wallet_id, l.l_shipdate AS created_at,
  CASE WHEN l.l_linestatus = 'O' THEN 'CREDIT' ELSE 'DEBIT' END AS transaction_balance,
  CAST(l.l_extendedprice AS DECIMAL(18,2)) AS transaction_amount,
  CASE l.l_returnflag WHEN 'A' THEN 'COUPON' WHEN 'N' THEN 'MATCH' ELSE 'BONUS' END AS transaction_type
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey""",
    "user_blocklist": """
SELECT o_custkey AS user_id, o_orderdate AS created_at,
  o_orderdate + CASE WHEN o_orderstatus <> 'P' OR o_totalprice <= 400000 THEN INTERVAL 1 DAY
       WHEN o_orderpriority = '1-URGENT' THEN INTERVAL 400 DAY ELSE INTERVAL 4000 DAY END AS expiry
FROM orders""",
    "ads_cost": """
SELECT CAST(l_shipdate AS DATE) AS reference_date,
  CASE WHEN l_linestatus = 'O' THEN 'adwords' ELSE CONCAT('infl_', l_returnflag) END AS font,
  CAST(l_extendedprice AS DECIMAL(18,2)) AS cost
FROM lineitem""",
    "messages": """
SELECT ts AS date_sent, CONCAT('whatsapp:', CAST(user_id AS STRING)) AS "to",
  CONCAT('whatsapp:', CAST(user_id + 1000 AS STRING)) AS "from", props AS body,
  CASE WHEN event_type = 'purchase' THEN NULL ELSE CAST(value AS DECIMAL(18,2)) END AS price,
  event_type AS status, CASE WHEN value > 100 THEN 'outbound-api' ELSE 'inbound' END AS direction
FROM events""",
}

# Fixed dates of the driver runs (the source tables span 1995-2001).
AS_OF = "2001-01-01"
LEAGUE_SINCE = "1996-01-01"
SUBSCRIPTION_USERS_SINCE = "1996-01-01"
SPINE_START = "1995-01-01"
SPINE_END = "2001-08-01"


def fixture_cte(*names: str) -> str:
    """``WITH`` clause holding the named fixtures, for the DuckDB oracle."""
    return "WITH " + ",\n".join(f"{n} AS ({FIXTURES[n]})" for n in names)


_TABLE_REF = re.compile(r"\b(" + "|".join(BASE_TABLES) + r")\b(?![.'])")


class Fixtures:
    """Spark side: each attribute is the fixture as a lazy DataFrame.

    The base tables are bound into the SQL text as DataFrame arguments
    (``spark.sql(text, orders=df)``), so no temporary view is registered in
    the caller's session and two scale factors can be built side by side.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in FIXTURES:
            raise AttributeError(name)
        sql = FIXTURES[name].replace('"to"', "`to`").replace('"from"', "`from`")
        used = sorted(set(_TABLE_REF.findall(sql)))
        sql = _TABLE_REF.sub(lambda m: "{" + m.group(1) + "}", sql)
        frames = {t: read_source(self.spark, self.sf_dir, t) for t in used}
        return self.spark.sql(sql, **frames)
