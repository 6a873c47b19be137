"""Attribution operators (M1-M13): identity resolution, visit classification,
referral and priority attribution, cohort flags, campaign cost allocation,
engagement ledger, cohort sums and ban status.

Faithful-by-default choices are parameters (see SURVEY §2.14):
* T4 — the source pattern concatenates the search and social lists with no
  ``|`` between them; ``fix_join=True`` inserts it.
* T5 — the bucket label is ``Outros`` but the flag tests ``Other``; the
  flag here tests the real default label (fixed).
* T6 — ``total_engagement_30d`` counts PAYMENT only (faithful rule list).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import as_col, days_between, regex_first
from tidemark.operators.aggs import filtered_sum
from tidemark.operators.joins import without_match
from tidemark.operators.stage import distinct_on

# Referrer domain lists used to classify visits.
SEARCH_DOMAINS = r"google\.com|google\.android|bing\.com|yahoo\.com|brave\.com|duckduckgo\.com"
SOCIAL_DOMAINS = r"youtube\.com|linkedin\.com|lnkd\.in|instagram\.com|facebook\.com|twitch\.tv|steamcommunity\.com|//t\.co|tiktok\.com"
# Campaign-source labels that mark an influencer visit.
INFLUENCER_SOURCES = ("influencer", "influencers")

# Medium -> priority class (lower wins); media not listed and
# not in the low-priority list get class 4; a null medium gets no class.
MEDIUM_PRIORITY = (
    (("mgm",), 1),
    (("paid-media", "site"), 2),
    (("influencers", "influencer", "cpv"), 3),
)
LOW_PRIORITY_MEDIA = (
    (("search-brand", "search-blog"), 5),
    (("referral",), 6),
    (("direct",), 7),
)

# Medium groups of the rollup labels.
PAID_MEDIA = ("google-ads", "paid-media", "site", "youtube")
INFLUENCER_MEDIA = ("influencer", "cpv")
SOURCE_LABELLED_MEDIA = ("influencer", "mgm", "social", "search-brand", "search-blog")

# Game-mode buckets of the first coupon (label, modes).
GAMEMODE_BUCKETS = (
    ("LOL", ("LOLEXTERNAL5V5", "LOL1V1", "LOL2V2", "LOLEXTERNALBLITZ")),
    ("VALORANT", ("VALEXTERNALRANKED",)),
    ("ARAM", ("LOLEXTERNALARAM",)),
    ("TFT", ("TFTEXTERNALRANKED",)),
    ("CS2", ("CS2EXTERNALRANKED", "CS2EXTERNALFACEIT")),
)
GAMEMODE_NULL_LABEL = "None"
GAMEMODE_OTHER_LABEL = "Outros"

# Wallet transaction types that count as engagement, and the
# (balance side, currency) -> ledger type rules.
ENGAGEMENT_TRANSACTION_TYPES = ("LEAGUE_TICKET", "LEAGUE_REGISTRATION", "COUPON", "COUPON_REFUND",
                                "BUG_AMOUNT", "MATCH")
LEDGER_TYPES = (
    ("CREDIT", "BRL", "PAYMENT"),
    ("CREDIT", "BONUS_BRL", "BONUS_USE"),
    ("DEBIT", "BRL", "GAIN"),
)

# Cohort sums (name, ledger types, max days since sign-up).
COHORT_SUMS = (
    ("value_spent_7d", ("PAYMENT",), 7),
    ("value_received_7d", ("GAIN",), 7),
    ("total_engagement_7d", ("PAYMENT", "BONUS_USE"), 7),
    ("value_spent_30d", ("PAYMENT",), 30),
    ("value_received_30d", ("GAIN",), 30),
    ("total_engagement_30d", ("PAYMENT",), 30),
    ("value_spent_60d", ("PAYMENT",), 60),
    ("value_received_60d", ("GAIN",), 60),
    ("value_spent_90d", ("PAYMENT",), 90),
    ("value_received_90d", ("GAIN",), 90),
)


# --------------------------------------------------------------------- M1
def resolve_identity(events: DataFrame, edges: DataFrame, identifiers: DataFrame,
                     users: DataFrame, *, event_key: str = "segment_id",
                     edge_ts: str = "timestamp", user_key: str = "user_id",
                     identifier_type: str = "user_id", salt_buckets: int | None = None) -> DataFrame:
    """M1: event -> newest canonical id of its segment id -> identifier of
    type ``user_id`` -> user row. One hop on the newest edge; no closure.

    ``events`` must not carry a ``user_id`` column of its own; the result has
    the event columns plus the user columns. With ``salt_buckets`` the
    event -> edge join is salted (:func:`joins.salted_join`) for segment ids
    that carry a large share of the events; otherwise AQE splits skewed
    partitions at run time.
    """
    graph = distinct_on(edges, [event_key], [(edge_ts, "desc"), ("canonical_segment_id", "asc")])
    graph = graph.select(event_key, "canonical_segment_id")
    ids = identifiers.where(F.col("type") == F.lit(identifier_type)).select(
        "canonical_segment_id", F.col("value").alias(user_key))
    if salt_buckets:
        from tidemark.operators.joins import salted_join
        out = salted_join(events, graph, [event_key], salt_buckets)
    else:
        out = events.join(graph, on=event_key, how="inner")
    out = out.join(ids, on="canonical_segment_id", how="inner")
    return out.join(users, on=user_key, how="inner").drop("canonical_segment_id")


# --------------------------------------------------------------------- M2
def classify_visits(visits: DataFrame, campaign_dim: DataFrame | None = None, *,
                    search: str = SEARCH_DOMAINS, social: str = SOCIAL_DOMAINS,
                    fix_join: bool = False) -> DataFrame:
    """M2: medium, source and campaign of each visit, first matching rule wins.

    ``visits`` columns: campaign_source, campaign_medium, campaign_name,
    campaign_content, campaign_term, path, referrer. ``campaign_dim`` maps
    ``source_name`` (a campaign name) to ``influencer``.
    """
    v = visits
    if campaign_dim is not None:
        dim = campaign_dim.select(F.col("source_name").alias("__tm_cname"), F.col("influencer").alias("__tm_infl"))
        v = v.join(dim, on=F.col("campaign_name") == F.col("__tm_cname"), how="left")
        v = v.drop("__tm_cname")
        infl = F.col("__tm_infl")
    else:
        infl = F.lit(None).cast("string")
    is_infl = F.col("campaign_source").isin(*INFLUENCER_SOURCES)
    is_blog = F.col("path").like("%blog%")
    ref = F.col("referrer")
    search_hit = regex_first(ref, f"({search})")
    social_hit = regex_first(ref, f"({social})")
    either = f"({search}|{social})" if fix_join else f"({search}{social})"
    either_hit = regex_first(ref, either)
    medium = (F.when(is_infl, F.lit("influencer"))
              .when(F.col("campaign_medium").isNotNull(), F.col("campaign_medium"))
              .when(is_blog, F.lit("search-blog"))
              .when(search_hit.isNotNull(), F.lit("search-brand"))
              .when(social_hit.isNotNull(), F.lit("social"))
              .when(ref.isNull(), F.lit("direct"))
              .otherwise(F.lit("referral")))
    source = (F.when(is_infl, infl)
              .when(F.col("campaign_source").isNotNull(), F.col("campaign_source"))
              .when(is_blog, F.col("path"))
              .when(either_hit.isNotNull(), either_hit)
              .when(ref.isNull(), F.lit("direct"))
              .otherwise(ref))
    campaign = F.coalesce(F.col("campaign_name"), F.when(is_blog, F.col("path")))
    out = v.withColumns({"medium": medium, "source": source, "campaign": campaign,
                         "content": F.col("campaign_content"), "term": F.col("campaign_term")})
    return out.drop("__tm_infl") if campaign_dim is not None else out


def visits_in_window(visits: DataFrame, users: DataFrame | None, days: int = 30, *,
                     visit_ts: str = "timestamp", signup_ts: str = "created_at",
                     own_site_like: str | None = None) -> DataFrame:
    """J7 + M2 filter: visits of each user in the ``days`` days up to sign-up
    (both ends inclusive); referrers of the own site are excluded.

    With ``users=None`` the visits already carry the sign-up time in
    ``signup_ts`` (e.g. from :func:`resolve_identity`), so no second join to
    the users is made; the column is dropped from the result.
    """
    if users is not None:
        out = visits.join(users.select("user_id", F.col(signup_ts).alias("__tm_signup")), on="user_id", how="inner")
    else:
        out = visits.withColumnRenamed(signup_ts, "__tm_signup")
    out = out.where(F.col(visit_ts).between(F.col("__tm_signup") - F.make_dt_interval(F.lit(days)),
                                            F.col("__tm_signup")))
    if own_site_like:
        out = out.where(~F.coalesce(F.col("referrer"), F.lit("")).like(own_site_like))
    return out.drop("__tm_signup")


# --------------------------------------------------------------------- M3
def referral_touches(referrals: DataFrame, users: DataFrame, tiebreak=None) -> DataFrame:
    """M3: newest referral of each referred user as an ``mgm`` touch; its cost
    is the reward when the referral is FINISHED, else 0. ``tiebreak``
    orders referrals made at the same instant (default: referrer id)."""
    ref = referrals.join(users.select(F.col("user_id").alias("referrer_id"), F.col("email").alias("__tm_email")),
                         on="referrer_id", how="inner")
    tb = list(tiebreak) if tiebreak is not None else [("referrer_id", "asc")]
    ref = distinct_on(ref, ["referred_id"], [("created_at", "desc"), *tb])
    return ref.select(
        F.col("referred_id").alias("user_id"),
        F.col("created_at").alias("timestamp"),
        F.lit("mgm").alias("medium"),
        F.col("__tm_email").alias("source"),
        F.lit(None).cast("string").alias("path"),
        F.lit(None).cast("string").alias("referrer"),
        F.lit(None).cast("string").alias("campaign"),
        F.lit(None).cast("string").alias("content"),
        F.lit(None).cast("string").alias("term"),
        F.when(F.col("status") == F.lit("FINISHED"), F.col("reward")).otherwise(F.lit(0)).alias("mgm_cost"),
    )


# --------------------------------------------------------------------- M4
def medium_priority(c="medium") -> Column:
    """Priority class of a medium (1 best); null medium -> null class."""
    m = as_col(c)
    expr = None
    for media, rank in MEDIUM_PRIORITY:
        expr = F.when(m.isin(*media), F.lit(rank)) if expr is None else expr.when(m.isin(*media), F.lit(rank))
    low = [x for media, _ in LOW_PRIORITY_MEDIA for x in media]
    expr = expr.when(~m.isin(*low), F.lit(4))
    for media, rank in LOW_PRIORITY_MEDIA:
        expr = expr.when(m.isin(*media), F.lit(rank))
    return expr


def attribute_by_priority(touches: DataFrame, user: str = "user_id", ts: str = "timestamp",
                          tiebreak: Sequence | None = None) -> DataFrame:
    """M4: one touch per user — lowest priority class, then newest.

    PostgreSQL null order throughout (T1): a null class sorts last, a null
    timestamp sorts first among equals. Ties on both are broken by
    ``tiebreak`` (default: source, campaign, path, referrer, content, term, cost).
    Written as one ``row_number() == 1`` so the partial ``WindowGroupLimit``
    reduces each user's touches before the shuffle.
    """
    tb = list(tiebreak) if tiebreak is not None else [
        ("source", "asc"), ("campaign", "asc"), ("path", "asc"), ("referrer", "asc"), ("content", "asc"),
        ("term", "asc"), ("mgm_cost", "asc")]
    ranked = touches.withColumn("medium_priority", medium_priority("medium"))
    return distinct_on(ranked, [user], [("medium_priority", "asc"), (ts, "desc"), *tb])


# --------------------------------------------------------------------- M5
def rollup_labels(att: DataFrame) -> DataFrame:
    """M5: broad medium group and the source-or-campaign label."""
    m = F.col("medium")
    medium_agg = (F.when(m.isin(*PAID_MEDIA), F.lit("paid-media"))
                  .when(m.isin(*INFLUENCER_MEDIA), F.lit("influencer"))
                  .otherwise(m))
    campaign_agg = F.when(m.isin(*SOURCE_LABELLED_MEDIA), F.col("source")).otherwise(F.col("campaign"))
    return att.withColumns({"medium_agg": medium_agg, "campaign_agg": campaign_agg})


# --------------------------------------------------------------------- M7
def bucket(c, buckets=GAMEMODE_BUCKETS, null_label: str = GAMEMODE_NULL_LABEL,
           default: str = GAMEMODE_OTHER_LABEL) -> Column:
    """M7: category bucket of a value; null -> ``null_label``; else ``default``."""
    v = as_col(c)
    expr = None
    for label, members in buckets:
        cond = v.isin(*members)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.when(v.isNull(), F.lit(null_label)).otherwise(F.lit(default))


# --------------------------------------------------------------------- M8
def daily_raw_cost(reports: DataFrame, *, day: Column, campaign: Column, cost: Column) -> DataFrame:
    """Raw cost summed per (day, campaign): the shared pre-aggregate of M8
    and M9 (one scan and one partial aggregate serve all three uses)."""
    return reports.groupBy(day.alias("_date"), campaign.alias("campaign")).agg(F.sum(cost).alias("__tm_raw"))


def _finish(agg: Column, convert, round_to) -> Column:
    if convert is not None:
        agg = convert(agg)
    if round_to is not None:
        agg = F.round(agg, round_to)
    return agg


def campaign_daily_cost(reports: DataFrame, *, day: Column, campaign: Column, cost: Column,
                        round_to: int | None = None, convert=None) -> DataFrame:
    """M8: cost per (day, campaign). ``reports`` already carries the
    campaign of each row (ad -> campaign look-ups done by the caller).

    ``convert`` maps the summed cost to money (e.g. millionths to units); it
    runs once per group instead of once per row, and an exact conversion of
    the sum equals the sum of the converted rows.
    """
    raw = daily_raw_cost(reports, day=day, campaign=campaign, cost=cost)
    return raw.select("_date", "campaign", _finish(F.col("__tm_raw"), convert, round_to).alias("cost"))


# --------------------------------------------------------------------- M9
def untracked_cost(reports: DataFrame, att: DataFrame, *, report_day: Column, report_campaign: Column,
                   cost: Column, att_day: str, source_label: str, round_to: int | None = None,
                   convert=None) -> DataFrame:
    """M9: cost of report rows whose (day, campaign) has no attributed user
    of ``source_label`` on that day, summed by day.

    The reference's ``left join ... where att.user_id is null`` is an anti
    join; since whole (day, campaign) cells are kept or dropped, the rows are
    summed per cell first and the anti join runs on those totals (null
    campaigns never match and are kept, as row by row).
    """
    raw = daily_raw_cost(reports, day=report_day, campaign=report_campaign, cost=cost)
    users = att.where(F.col("source") == F.lit(source_label)).select(
        F.col(att_day).alias("_date"), F.col("campaign"))
    lonely = without_match(raw, users, ["_date", "campaign"])
    return lonely.groupBy("_date").agg(_finish(F.sum("__tm_raw"), convert, round_to).alias("cost"))


# --------------------------------------------------------------------- M10
def _share(cost: Column, users: Column) -> Column:
    """Cost per user as an exact decimal of 13 places, so that sums of it do not depend on their order."""
    return cost.cast("decimal(18,2)") / users.cast("decimal(10,0)")


def cost_per_user(att: DataFrame, costs: Mapping[str, DataFrame], untracked: Mapping[str, DataFrame],
                  day_col: str, rate_name: str) -> DataFrame:
    """Per (day, medium_agg, source, campaign) of paid-media users:
    users, campaign cost and cost per user plus the share of that day's
    untracked cost of the same source.

    ``costs`` / ``untracked`` map a source label ('adwords', 'facebook-ads')
    to its daily cost per campaign (M8) / untracked daily cost (M9).
    Users are counted per group *before* the cost look-up: the costs are
    unique per (day, campaign), so this equals the reference's
    join-then-average and never fans rows out.
    """
    base = att.where(F.col("medium_agg") == F.lit("paid-media"))
    if day_col != "created_at":
        base = base.where(F.col(day_col).isNotNull())
    keys = [day_col, "medium_agg", "source", "campaign"]
    tracked = base.groupBy(*keys).agg(F.countDistinct("user_id").alias("users"))
    cost_cols = []
    for i, (label, cdf) in enumerate(costs.items()):
        c = cdf.select(F.col("_date").alias(f"__tm_d{i}"), F.col("campaign").alias(f"__tm_c{i}"),
                       F.col("cost").alias(f"__tm_cost{i}"))
        cond = ((F.col("source") == F.lit(label)) & (F.col("campaign") == F.col(f"__tm_c{i}"))
                & (F.col(day_col) == F.col(f"__tm_d{i}")))
        tracked = tracked.join(c, on=cond, how="left").drop(f"__tm_d{i}", f"__tm_c{i}")
        cost_cols.append(F.coalesce(F.col(f"__tm_cost{i}"), F.lit(0)))
    campaign_cost = F.round(sum(cost_cols[1:], cost_cols[0]), 2)
    tracked = tracked.withColumn("campaign_cost", campaign_cost).drop(
        *[f"__tm_cost{i}" for i in range(len(costs))])
    tracked = tracked.withColumn(rate_name, _share(F.col("campaign_cost"), F.col("users")))

    per_source = tracked.groupBy(day_col, "medium_agg", "source").agg(F.sum("users").alias("__tm_users"))
    ex_cols = []
    for i, (label, udf) in enumerate(untracked.items()):
        u = udf.select(F.col("_date").alias(f"__tm_ud{i}"), F.col("cost").alias(f"__tm_ucost{i}"))
        cond = ((F.col(f"__tm_ud{i}") == F.col(day_col)) & (F.col("medium_agg") == F.lit("paid-media"))
                & (F.col("source") == F.lit(label)))
        per_source = per_source.join(u, on=cond, how="left").drop(f"__tm_ud{i}")
        ex_cols.append(F.coalesce(F.col(f"__tm_ucost{i}"), F.lit(0)))
    excess = _share(sum(ex_cols[1:], ex_cols[0]), F.col("__tm_users"))
    per_source = per_source.select(day_col, "medium_agg", "source", excess.alias("__tm_excess"))
    out = tracked.join(per_source, on=[day_col, "medium_agg", "source"], how="left")
    return out.withColumn(rate_name, F.col(rate_name) + F.coalesce(F.col("__tm_excess"), F.lit(0))).drop(
        "__tm_excess")


# --------------------------------------------------------------------- M11
def ledger_type(balance="transaction_balance", currency="currency") -> Column:
    b, c = as_col(balance), as_col(currency)
    expr = None
    for side, cur, label in LEDGER_TYPES:
        cond = (b == F.lit(side)) & (c == F.lit(cur))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def engagement_ledger(users: DataFrame, accounts: DataFrame, wallets: DataFrame, txns: DataFrame,
                      types: Sequence[str] = ENGAGEMENT_TRANSACTION_TYPES) -> DataFrame:
    """Wallet transactions of each user typed PAYMENT / BONUS_USE / GAIN,
    with the day and the whole days since sign-up. The type filter on the
    last table of the left-join chain makes the chain inner (J15)."""
    t = txns.where(F.col("transaction_type").isin(*types))
    out = (users.select("user_id", F.col("created_at").alias("__tm_signup"))
           .join(accounts.select("user_id", "account_id"), on="user_id", how="inner")
           .join(wallets.select("account_id", "wallet_id", "currency"), on="account_id", how="inner")
           .join(t, on="wallet_id", how="inner"))
    return out.select(
        "user_id",
        F.to_date("created_at").alias("transaction_date"),
        days_between("created_at", "__tm_signup").alias("days_since_user_creation"),
        ledger_type("transaction_balance", "currency").alias("type"),
        F.col("transaction_amount").alias("value"),
    )


# --------------------------------------------------------------------- M12
def cohort_sums(ledger: DataFrame, rules=COHORT_SUMS, key: str = "user_id") -> DataFrame:
    """Filtered sums per user over 7/30/60/90 days since sign-up; a sum
    with no qualifying row is null."""
    d = F.col("days_since_user_creation")
    aggs = [filtered_sum(F.col("type").isin(*types) & (d <= days), "value").alias(name)
            for name, types, days in rules]
    return ledger.groupBy(key).agg(*aggs)


# --------------------------------------------------------------------- M13
def ban_status(blocklist: DataFrame, as_of) -> DataFrame:
    """Newest ban of each user; active when its expiry date is after
    ``as_of`` (a date, so reruns give the same answer — T18)."""
    newest = distinct_on(blocklist, ["user_id"], [("created_at", "desc"), ("expiry", "desc")])
    as_of_col = as_of if isinstance(as_of, Column) else F.to_date(F.lit(str(as_of)))
    active = F.datediff(F.to_date("expiry"), as_of_col) > 0
    return newest.select("user_id", F.coalesce(active, F.lit(False)).alias("active_ban"))


