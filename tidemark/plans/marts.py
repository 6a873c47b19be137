"""Composite marts, composed lazily from the operators.

Inputs are DataFrames shaped like the pipelines' sources (column names by
use, see FIXTURES.md §2); ``as_of`` replaces ``now()`` / ``current_date`` so a
run is reproducible (T18). Nothing here runs an action.

* :func:`banned_users`      M17 — newest active ban per user with payouts
  in the 14 days and gateway attempts in the 3 days before it.
* :func:`coupons_finished`  M18-M20 — one row per finished coupon.
* :func:`financial_daily`   M21-M23 — daily ledger pivot, GENERAL and per
  game mode, with monthly users.
* :func:`user_attribution`  M1-M14 — one row per user: channel, cohort
  flags, cost per lead / activation, cohort value sums.
* :func:`acquisition_daily` M15-M16 — daily registrations and activations
  per channel on a calendar.
* :func:`exchange_series`   M24; :func:`message_log` M26.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import coalesce_diff, days_between, flag, local_date, month_start, to_local
from tidemark.operators import aggs, attribution, joins, reshape, stage

# ====================================================================== M17
# Gateway and status of the payout attempts that count.
PAYOUT_GATEWAY = "STARKBANK"
PAID_STATUS = "PAID"


def banned_users(blocklist: DataFrame, notes: DataFrame, transactions_finished: DataFrame,
                 gateway_transactions: DataFrame, accounts: DataFrame) -> DataFrame:
    """One row per user — the newest active ban with its notes and the
    payouts / payout attempts just before it.

    The two look-back aggregates are range joins bucketed by day (J6), so a
    user with a very long history is spread over many tasks. Amounts are
    summed exactly (decimal) and returned as double (T14: the source's
    ``::float`` is single precision).
    """
    bans = blocklist.where(F.col("active_ban").eqNullSafe(F.lit(True)))
    bans = bans.join(notes, on="user_notes_id", how="left")
    blocked = bans.select(
        F.col("user_blocklist_id").alias("block_id"), "user_id", "created_at", "description", "notes", "flag",
        F.col("cheat").alias("is_cheating"), F.col("smurf").alias("is_smurfing"),
        F.col("derank").alias("is_deranking"), F.col("duo_boost").alias("is_duo_boosting"),
        F.col("slow_climb").alias("is_slow_climbing"), "gamemode", "active_ban",
        F.col("expiry").alias("expire_at"))
    last = stage.latest_per_key(blocked, ["user_id"], "created_at", tiebreak=[("block_id", "desc")])

    payouts = transactions_finished.where(F.col("transaction_type") == F.lit("PAYOUT")).select(
        "user_id", F.col("created_at").alias("paid_at"), "transaction_id", "absolut_amount")
    attempts = (gateway_transactions
                .where((F.col("gateway_name") == F.lit(PAYOUT_GATEWAY)) & (F.col("status") != F.lit(PAID_STATUS)))
                .join(accounts.select("account_id", "user_id"), on="account_id", how="left")
                .select("user_id", F.col("created_at").alias("tried_at"),
                        F.col("transaction_id").alias("attempt_id"), "amount"))

    anchors = last.select("block_id", "user_id", "created_at")
    paid = joins.lookback_agg(anchors, payouts, "user_id", "created_at", "paid_at", 14, ["block_id"], {
        "successful_payouts_in_2_weeks": F.countDistinct("transaction_id"),
        "successful_payouts_amount": aggs.sum_or_zero("absolut_amount").cast("double"),
    })
    tried = joins.lookback_agg(anchors, attempts, "user_id", "created_at", "tried_at", 3, ["block_id"], {
        "attempts_payouts_before_ban": F.countDistinct("attempt_id"),
        "attempted_amount": aggs.sum_or_zero("amount").cast("double"),
    })
    out = (last.join(paid.drop("created_at"), on=["block_id", "user_id"], how="left")
           .join(tried.drop("created_at"), on=["block_id", "user_id"], how="left"))
    return out.select("block_id", "user_id", "created_at", "expire_at", "description", "notes", "flag",
                      "is_cheating", "is_smurfing", "is_deranking", "is_duo_boosting", "is_slow_climbing",
                      "gamemode", "active_ban", "successful_payouts_in_2_weeks", "successful_payouts_amount",
                      "attempts_payouts_before_ban", "attempted_amount")


# ====================================================================== M18-M20
def coupon_currency(transactions: DataFrame, transaction_items: DataFrame, wallets: DataFrame,
                    accounts: DataFrame) -> DataFrame:
    """Per coupon, the sorted, comma-joined currencies of the player
    credits of its coupon transactions (T11: the list is sorted)."""
    t = transactions.where(F.col("type") == F.lit("COUPON")).select("transaction_id", "coupon_id")
    ti = transaction_items.where(F.col("status") == F.lit("CREDIT")).select("transaction_id", "wallet_id")
    w = wallets.select("wallet_id", "account_id", "currency")
    a = accounts.where(F.col("type") == F.lit("PLAYER_ACCOUNT")).select("account_id")
    # the small dimensions first: house wallets never meet the items
    credits = ti.join(w.join(a, "account_id").select("wallet_id", "currency"), "wallet_id").join(t, "transaction_id")
    return aggs.concat_values(credits, ["coupon_id"], "currency")


def signed_settlement(df: DataFrame, status: str = "coupon_status", amount: str = "amount",
                      odd: str = "odd", currency: str = "currency") -> DataFrame:
    """House and user balance of a settled coupon, plain and
    bonus-aware. Faithful to the source (T10): a REFUND gives
    ``balance_amount = +amount`` but both bonus variants ``-amount``; an
    unknown currency list gives null in the bonus variants (T11)."""
    s, a, o, c = F.col(status), F.col(amount), F.col(odd), F.col(currency)
    won = s == F.lit("WON")
    lost = s == F.lit("LOST")
    profit = a * (o - F.lit(1))
    bonus, brl = c == F.lit("BONUS_BRL"), c == F.lit("BRL")
    return df.withColumns({
        "balance_amount": F.round(F.when(won, -profit).otherwise(a), 2),
        "user_balance_amount": F.round(F.when(won, profit).otherwise(-a), 2),
        "balance_amount_bonus": (F.when(won & bonus, F.lit(0) - profit).when(lost & bonus, F.lit(0))
                                 .when(won & brl, F.lit(0) - profit).when(lost & brl, a)
                                 .when(s == F.lit("REFUND"), -a)),
        "user_balance_amount_bonus": (F.when(won & bonus, profit).when(lost & bonus, F.lit(0))
                                      .when(won & brl, profit).when(lost & brl, -a)
                                      .when(s == F.lit("REFUND"), -a)),
    })


def coupons_finished(coupons: DataFrame, grouped_challenges: DataFrame, banned: DataFrame,
                     transactions: DataFrame, transaction_items: DataFrame, wallets: DataFrame,
                     accounts: DataFrame, super_tips: DataFrame, coupon_items: DataFrame,
                     reputations: DataFrame | None = None, match_players: DataFrame | None = None,
                     players: DataFrame | None = None,
                     staged: Callable[[DataFrame, str], DataFrame] | None = None) -> DataFrame:
    """One row per finished coupon (WON / LOST / REFUND), 22 columns.

    Banned and super-tip flags are semi-join flags (J10) on de-duplicated
    keys, so they never multiply coupons. The first external match of a
    coupon is its earliest item (D2, tie-break on the match id). The
    reputation look-up goes through match players; duplicate dimension
    keys there would multiply coupons as in the source (T19) — check
    ``coupon_id`` with :func:`check_unique` on the result. ``staged`` (if
    given) is the caller's step that writes a look-up table of the coupons
    (frame, name), so that the joins behind it are over before the next.
    """
    kept = staged or (lambda rows, name: rows)
    c = coupons.where(F.col("coupon_status").isin("WON", "LOST", "REFUND"))
    gc = grouped_challenges.select("grouped_challenge_id", F.col("name").alias("challenge_name"),
                                   F.col("gamemode").alias("__tm_gm"), F.col("external_gamemode").alias("__tm_egm"))
    out = joins.lookup(c, gc, "grouped_challenge_id")
    currency = kept(coupon_currency(transactions, transaction_items, wallets, accounts), "coupon_currency")
    out = joins.lookup(out, currency, "coupon_id")
    out = joins.flag_match(out, banned.select("user_id"), "user_id", "is_banned")
    out = joins.flag_match(out, super_tips.select("coupon_id"), "coupon_id", "is_supertip")
    first_item = stage.first_per_key(coupon_items.select("coupon_id", "external_match_id", "created_at"),
                                     ["coupon_id"], "created_at", tiebreak=[("external_match_id", "asc")])
    first_item = kept(first_item.select("coupon_id", "external_match_id"), "first_items")
    out = joins.lookup(out, first_item, "coupon_id")
    if reputations is not None and match_players is not None and players is not None:
        mpu = match_players.join(players.select("external_player_id", "user_id",
                                                F.col("external_gamemode").alias("__tm_egm")),
                                 on="external_player_id", how="left")
        mpu = mpu.select("external_match_id", "user_id", "__tm_egm", "external_match_player_id")
        rep = reputations.select("external_match_player_id", "max_amount", F.col("metadata").alias("reputation_metadata"))
        # looked up on the coupons' key columns, so whole rows are not shuffled by match and then by player;
        # match, user and game mode must all agree (null never matches)
        own = joins.lookup(c.select("coupon_id", "user_id", "grouped_challenge_id"),
                           gc.select("grouped_challenge_id", "__tm_egm"), "grouped_challenge_id", "inner")
        own = joins.lookup(own, first_item, "coupon_id", "inner").select(
            "coupon_id", "user_id", "__tm_egm", "external_match_id").distinct()
        hits = joins.lookup(own, mpu, ["external_match_id", "user_id", "__tm_egm"], "inner")
        hits = joins.lookup(hits, rep, "external_match_player_id").select(
            F.col("coupon_id").alias("__tm_coupon"), F.col("user_id").alias("__tm_user"), F.col("__tm_egm").alias("__tm_mode"),
            "max_amount", "reputation_metadata")
        hits = kept(hits, "coupon_reputations")
        # a coupon id may stand for several rows: user and mode are compared too, as bounds and not as
        # keys, so that the rows stay where they are by coupon
        out = out.join(hits, (F.col("coupon_id") == F.col("__tm_coupon")) & F.col("user_id").between(F.col("__tm_user"), F.col("__tm_user"))
                       & F.col("__tm_egm").between(F.col("__tm_mode"), F.col("__tm_mode")), "left")
    else:
        out = out.withColumns({"max_amount": F.lit(None).cast("decimal(18,2)"),
                               "reputation_metadata": F.lit(None).cast("string")})
    out = signed_settlement(out)
    return out.select(
        "coupon_id", "user_id", "created_at", "challenge_name", F.round("odd", 2).alias("odd"),
        F.col("type").alias("coupon_type"), F.round("amount", 2).alias("bet_amount"), "balance_amount",
        "user_balance_amount", "balance_amount_bonus", "user_balance_amount_bonus", "currency", "coupon_status",
        "rollover_id", "grouped_challenge_id", F.coalesce("__tm_gm", "__tm_egm").alias("gamemode"),
        "is_banned", "is_supertip", "external_match_id", "origin", "max_amount", "reputation_metadata")


# ====================================================================== M21-M23
# Game mode given to rows whose user never played one.
DEFAULT_GAMEMODE = "LOL1V1"

# The measures of the daily financial mart (name, types, value).
FINANCIAL_MEASURES = (
    ("league_entrance", ("LEAGUE_ENTRANCE",), "amount"),
    ("subscription_old_user", ("SUBSCRIPTION_OLD_USER",), "amount"),
    ("coupons", ("COUPON", "RECOVERED_REVENUE", "COUPON_REFUND", "ARTIFICIAL_UNBANNED"), "amount"),
    ("recovered_revenue", ("RECOVERED_REVENUE",), "amount"),
    ("coupons_only", ("COUPON",), "amount"),
    ("unbanned_users", ("ARTIFICIAL_UNBANNED",), "amount"),
    ("coupons_refund", ("COUPON_REFUND",), "amount"),
    ("bonus_converted", ("BONUS_CONVERTED",), "amount"),
    ("bonus_converted_abs", ("BONUS_CONVERTED",), "abs"),
    ("bonus_received", ("BONUS",), "amount"),
    ("payin", ("PAYIN",), "amount"),
    ("payout", ("PAYOUT",), "neg"),
    ("payout_abs", ("PAYOUT",), "amount"),
)

# Ledger amounts keep six places through the sums (revenue has four); the
# measures are rounded to cents last.
LEDGER_AMOUNT_TYPE = "decimal(38,6)"

LEDGER_COLUMNS = ("feed", "reference_date", "user_id", "gamemode", "coupon_id", "transaction_id", "bet_amount", "amount",
                  "type")


def _routed(tf: DataFrame, league_since: str) -> DataFrame:
    """The ledger rows that belong to a feed, tagged with it, with their day, type and amount there.

    The feeds' rules exclude one another (a type is in one feed, but for coupon refunds, which are told
    apart by wallet), so a row needs one tag and no copy.
    """
    kind, side, money = F.col("transaction_type"), F.col("debit_credit"), F.col("wallet_currency")
    feed = (F.when(kind.isin("LEAGUE_REGISTRATION", "LEAGUE_TICKET") & (side == "CREDIT") & (money == "BRL")
                   & (F.to_date("created_at") >= F.to_date(F.lit(league_since))), "league")
            .when((kind == "SUBSCRIPTION_OLD_USER") & (side == "CREDIT"), "subscription")
            .when(kind.isin("COUPON", "COUPON_REFUND") & (money == "BRL"), "coupon")
            .when((money == "BONUS_BRL") & kind.isin("ROLLOVER", "BONUS", "LEAGUE_PRIZE", "COUPON_REFUND",
                                                    "BACKOFFICE_BONUS") & (side == "DEBIT"), "bonus")
            .when(kind.isin("PAYIN", "PAYOUT"), "pay"))
    coupon_type = (F.when(side == "ARTIFICIAL", "RECOVERED_REVENUE").when(side == "ARTIFICIAL_UNBANNED", side)
                   .when(side.isNotNull(), kind))
    f = F.col("feed")
    return tf.withColumn("feed", feed).where("feed IS NOT NULL").select(
        "feed", F.to_date(F.when(f == "pay", F.col("updated_at")).otherwise(F.col("created_at"))).alias("reference_date"),
        F.when(f == "league", "LEAGUE_ENTRANCE").when(f == "bonus", "BONUS").when(f == "coupon", coupon_type)
        .otherwise(kind).alias("type"), "league_id", "coupon_id", "user_id", "transaction_id",
        F.when(f == "coupon", F.col("amount_rev")).otherwise(F.col("absolut_amount")).cast(LEDGER_AMOUNT_TYPE).alias("amount"))


def _converted(coupons: DataFrame) -> DataFrame:
    """The won bonus coupons: the feed that does not come from the ledger."""
    return coupons.where((F.col("currency") == "BONUS_BRL") & (F.col("coupon_status") == "WON"))


def typed_ledger(tf: DataFrame, coupons: DataFrame, league_points: DataFrame, coupon_items: DataFrame,
                 challenges: DataFrame, users: DataFrame, *, league_since: str = "2024-01-01",
                 subscription_users_since: str = "2023-10-11") -> DataFrame:
    """The rows of the six typed feeds of the daily financial mart, with
    their feed (league, subscription, coupon, bonus, pay, converted); ``gamemode`` is null where a feed has none.

    The ledger is scanned and joined once: a league's modes, a coupon's user
    and mode and the subscribed users are one relation keyed by (feed, key).
    A row without a key, or of a feed that joins nothing, takes its transaction as
    key, which the relation does not hold, so such rows are spread and not one hot null key.
    """
    f, text = F.col("feed"), "string"
    none = {c: F.lit(None).cast(t) for c, t in (("owner", users.schema["user_id"].dataType), ("mode", text),
                                                ("bet_amount", coupons.schema["bet_amount"].dataType))}

    def keyed(df: DataFrame, feed: str, key: str, **given) -> DataFrame:
        return df.where(F.col(key).isNotNull()).select(
            F.lit(feed).alias("feed"), F.concat(F.lit("key "), F.col(key).cast(text)).alias("key"),
            *(F.col(given[c]).alias(c) if c in given else none[c].alias(c) for c in none), F.lit(True).alias("found"))

    since = users.where(F.col("created_at") >= F.to_timestamp(F.lit(subscription_users_since)))
    sides = stage.stack_rows(
        keyed(_league_modes(league_points, coupon_items, challenges), "league", "league_id", mode="gamemode"),
        keyed(coupons, "coupon", "coupon_id", owner="user_id", mode="gamemode", bet_amount="bet_amount"),
        keyed(since, "subscription", "user_id"))
    own = (F.when(f == "league", F.col("league_id").cast(text)).when(f == "coupon", F.col("coupon_id").cast(text))
           .when(f == "subscription", F.col("user_id").cast(text)))
    key = F.coalesce(F.concat(F.lit("key "), own), F.concat(F.lit("row "), F.col("transaction_id").cast(text)))
    rows = _routed(tf, league_since).withColumn("key", key).join(sides, ["feed", "key"], "left")
    rows = rows.where((f != "subscription") | F.col("found")).select(
        "feed", "reference_date", F.when(f == "coupon", F.col("owner")).otherwise(F.col("user_id")).alias("user_id"),
        F.when(f == "league", F.coalesce("mode", F.lit(DEFAULT_GAMEMODE))).otherwise(F.col("mode")).alias("gamemode"),
        F.when(f == "coupon", F.col("coupon_id").cast(text)).alias("coupon_id"), "transaction_id", "bet_amount", "amount", "type")
    converted = _converted(coupons).select(
        F.lit("converted").alias("feed"), F.to_date("created_at").alias("reference_date"), "user_id", "gamemode",
        F.col("coupon_id").cast(text).alias("coupon_id"), F.lit(None).cast(tf.schema["transaction_id"].dataType)
        .alias("transaction_id"), "bet_amount", F.col("balance_amount").cast(LEDGER_AMOUNT_TYPE).alias("amount"),
        F.lit("BONUS_CONVERTED").alias("type"))
    return stage.stack_rows(rows, converted).select(*LEDGER_COLUMNS)


def _financial_rules() -> tuple[dict, dict]:
    rules = {name: (types, {"amount": "value"}.get(how, how)) for name, types, how in FINANCIAL_MEASURES}
    return rules, {"payin_payout_balance": (("PAYIN",), ("PAYOUT",))}


FINANCIAL_COLUMNS = ("reference_date", "gamemode", "league_entrance", "subscription_old_user", "coupons",
                     "recovered_revenue", "coupons_only", "unbanned_users", "coupons_refund", "bonus_converted",
                     "bonus_converted_abs", "bonus_received", "payin", "payout", "payout_abs",
                     "payin_payout_balance", "monthly_users")


def ledger_rows(tf: DataFrame, league_since: str = "2024-01-01") -> DataFrame:
    """M21 in one scan: every ledger row in its feed, with day, type, amount and the key that the feed is
    joined by (league, coupon or user). Not summed by these: a key has few rows a day and type."""
    f = F.col("feed")
    return _routed(tf, league_since).select(
        "feed", "reference_date", "type", F.when(f == "league", F.col("league_id")).alias("league_id"),
        F.when(f == "coupon", F.col("coupon_id")).alias("coupon_id"),
        F.when(f.isin("subscription", "bonus", "pay"), F.col("user_id")).alias("user_id"), "amount")


def ledger_totals(tf: DataFrame, league_since: str = "2024-01-01") -> DataFrame:
    """M21 summed in one pass: the ledger's rows (:func:`ledger_rows`) summed per feed, day, type and key."""
    return aggs.type_totals(ledger_rows(tf, league_since), ["feed", "reference_date", "league_id", "coupon_id", "user_id"],
                            "type", "amount")


# Modes told by one long.
MODE_BITS = 62


def _league_modes(league_points: DataFrame, coupon_items: DataFrame, challenges: DataFrame) -> DataFrame:
    """Leagues and the game modes they were played in (D7: group by both).

    A league's modes are gathered as bits, by their place among all modes (which are few), so that a task
    holds a small row per league and not one per league and mode. No challenge or no mode gives a null mode.
    """
    modes = challenges.agg(F.array_sort(F.collect_set("external_gamemode"))).scalar()
    places = challenges.withColumn("modes", modes).select(
        "challenge_id", (F.array_position("modes", F.col("external_gamemode")) - 1).alias("place"))
    played = (league_points.select("league_id", "external_match_id")
              .join(coupon_items.select("external_match_id", "challenge_id"), "external_match_id", "left")
              .join(places, "challenge_id", "left"))
    sets = played.groupBy("league_id", F.expr(f"place div {MODE_BITS}").alias("word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, CAST(place % {MODE_BITS} AS INT))")).alias("bits"))
    own = F.expr(f"filter(modes, (m, i) -> i div {MODE_BITS} = word AND getbit(bits, i % {MODE_BITS}) = 1)")
    return sets.withColumn("modes", modes).select("league_id", F.explode_outer(own).alias("gamemode"))


def financial_daily(tf: DataFrame, coupons: DataFrame, league_points: DataFrame, coupon_items: DataFrame,
                    challenges: DataFrame, users: DataFrame, *, league_since: str = "2024-01-01",
                    subscription_users_since: str = "2023-10-11",
                    staged: Callable[[DataFrame], DataFrame] | None = None,
                    staged_modes: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Daily ledger measures, ``GENERAL`` and per game mode, with the
    month's distinct coupon users.

    ``GENERAL`` sums the plain feeds; per-mode sums use the feeds whose rows
    are fanned out over every mode the user ever played (J17/M22), so the two
    inputs differ and a ``rollup`` would be wrong (T12). Users of one set of modes
    are summed together before that. ``coupons`` is the
    output of :func:`coupons_finished`. Three joins read the ledger's rows
    (:func:`ledger_rows`); ``staged`` (if given) is the caller's step that
    writes them once (by ``feed``), so the ledger is scanned once; ``staged_modes``
    is such a step for the leagues' modes.
    """
    modes = _league_modes(league_points, coupon_items, challenges)
    if staged_modes is not None:
        modes = staged_modes(modes)
    ledger = ledger_rows(tf, league_since)
    if staged is not None:
        ledger = staged(ledger)
    sums = ["type", "amount"]

    def feed(*names: str) -> DataFrame:
        return ledger.where(F.col("feed").isin(*names))

    # The rows are joined as they are and summed map-side right after, by day, mode (or set of
    # modes) and type: summing them by their key before would shuffle nearly every row once more.
    league = feed("league").join(modes, "league_id", "left").select(
        "reference_date", F.coalesce("gamemode", F.lit(DEFAULT_GAMEMODE)).alias("gamemode"), *sums)
    revenue = feed("coupon").join(coupons.select("coupon_id", "gamemode"), "coupon_id", "left").select(
        "reference_date", "gamemode", *sums)
    won = _converted(coupons).select(
        F.to_date("created_at").alias("reference_date"), "gamemode", F.lit("BONUS_CONVERTED").alias("type"),
        F.col("balance_amount").cast(LEDGER_AMOUNT_TYPE).alias("amount"))
    since = users.where(F.col("created_at") >= F.to_timestamp(F.lit(subscription_users_since))).select("user_id")
    per_user = stage.stack_rows(feed("subscription").join(since, "user_id", "inner").select("reference_date", "user_id", *sums),
                                feed("bonus", "pay").select("reference_date", "user_id", *sums))
    # summed by mode here, so that the GENERAL and the per-mode pivots share one exchange
    own = aggs.type_totals(stage.stack_rows(league, revenue, won), ["reference_date", "gamemode"], "type", "amount")
    # and the users' rows by the set of modes of their user: summed once, before they fan out over the modes
    per_set = aggs.type_totals(joins.with_segments(per_user, coupons.select("user_id", "gamemode"), "user_id", "gamemode",
                                                   DEFAULT_GAMEMODE, "modes"), ["reference_date", "modes"], "type", "amount")
    general_t = stage.stack_rows(own.drop("gamemode"), per_set.drop("modes"))
    mode_t = stage.stack_rows(own, per_set.withColumn("gamemode", F.explode("modes")).drop("modes"))
    rules, derived = _financial_rules()
    general = aggs.pivot_type_totals(general_t, ["reference_date"], "type", rules, derived)
    per_mode = aggs.pivot_type_totals(mode_t, ["reference_date", "gamemode"], "type", rules, derived)
    unified = aggs.with_general(general, per_mode, "gamemode")

    # exact sets of users, kept per month and mode once and merged for GENERAL
    bitmaps = aggs.user_bitmaps(coupons.select(month_start("created_at").alias("month"), "gamemode", "user_id"),
                                ["month", "gamemode"], "user_id")
    mu = aggs.bitmap_users(bitmaps, ["month"]).withColumn("gamemode", F.lit("GENERAL"))
    mug = aggs.bitmap_users(bitmaps, ["month", "gamemode"])
    users_per_month = mu.select("month", "gamemode", "monthly_users").unionByName(mug)
    out = unified.withColumn("month", month_start("reference_date"))
    out = out.join(users_per_month, on=["month", "gamemode"], how="left")
    return out.select(*FINANCIAL_COLUMNS)


# ====================================================================== M14
# Users excluded from the attribution mart, and the own-site
# referrer pattern (the site's domain, masked in the source).
EXCLUDED_USERS: tuple = ()
OWN_SITE_REFERRER = "%#####.%"
COUPON_FINISHED_STATUSES = ("WON", "LOST", "REFUND")

ATTRIBUTION_COLUMNS = (
    "user_id", "ban_status", "created_at", "logged_in", "medium", "medium_agg", "source", "referrer",
    "page_path", "campaign", "campaign_agg", "content", "term", "deposited", "activated", "first_coupon_at",
    "first_coupon_gamemode", "original_gamemode", "lol_activated", "aram_activated", "tft_activated",
    "cs_activated", "valorant_activated", "other_activated", "cpl_cost", "cac_cost",
    "value_spent_7d", "value_received_7d", "total_engagement_7d", "net_value_7d",
    "value_spent_30d", "value_received_30d", "total_engagement_30d", "net_value_30d",
    "value_spent_60d", "value_received_60d", "net_value_60d",
    "value_spent_90d", "value_received_90d", "net_value_90d")


def first_coupon(coupon_items: DataFrame, coupons: DataFrame, challenges: DataFrame,
                 external_first: bool = True) -> DataFrame:
    """First finished, non-free coupon of each user (that has items) and its
    game mode (T17: ``external_first`` picks the coalesce order).

    The source orders (coupon time, coupon id, game mode nulls last) over
    every item row; the game mode of the chosen coupon is therefore the
    smallest non-null mode of its items. It is computed per coupon first
    (a partial aggregate), so the per-user pick reads one row per coupon
    instead of one per item.
    """
    ch = challenges.select("challenge_id", "external_gamemode", "gamemode")
    mode = (F.coalesce("external_gamemode", "gamemode") if external_first
            else F.coalesce("gamemode", "external_gamemode"))
    per_coupon = (coupon_items.select("coupon_id", "challenge_id").join(ch, "challenge_id", "left")
                  .groupBy("coupon_id").agg(F.min(mode).alias("first_coupon_gamemode")))
    c = coupons.where(F.coalesce(F.col("coupon_status"), F.lit("")).isin(*COUPON_FINISHED_STATUSES)
                      & (F.col("type") != F.lit("FREE"))).select("coupon_id", "user_id", "created_at")
    rows = c.join(per_coupon, "coupon_id", "inner").select(
        "user_id", F.col("created_at").alias("first_coupon_at"), "first_coupon_gamemode", "coupon_id")
    first = stage.distinct_on(rows, ["user_id"], [("first_coupon_at", "asc"), ("coupon_id", "asc")])
    return first.drop("coupon_id")


class NetworkCost:
    """Cost rows of one ad network and its (day, campaign) daily cost (M8).

    ``convert`` turns a summed raw cost into money; sums run on the raw
    column (a long for millionths) and the conversion once per group.
    """

    def __init__(self, rows: DataFrame, day: Column, campaign: Column, cost_expr: Column, round_to,
                 convert=None):
        self.rows, self.day, self.campaign, self.cost_expr = rows, day, campaign, cost_expr
        self.round_to, self.convert = round_to, convert
        self.cost = attribution.campaign_daily_cost(rows, day=day, campaign=campaign, cost=cost_expr,
                                                    round_to=round_to, convert=convert)


def micros_to_money(c: Column) -> Column:
    """Millionths (integer) to money, exactly: ``cost / 1000000``."""
    return c.cast("decimal(38,0)") * F.lit(0.000001).cast("decimal(7,6)")


def network_costs(google_reports: DataFrame, fb_insights: DataFrame, fb_ads: DataFrame,
                  fb_campaigns: DataFrame) -> tuple[NetworkCost, NetworkCost]:
    """M8 for both networks: Google reports carry cost in millionths and the
    campaign id; Facebook insights reach their campaign through ad -> campaign
    look-ups (a missing campaign gives a null campaign)."""
    google = NetworkCost(google_reports, F.to_date("date_stop"), F.col("campaign_id"), F.col("cost"), 2,
                         convert=micros_to_money)
    ads = fb_ads.select(F.col("id").alias("ad_id"), "campaign_id")
    camps = fb_campaigns.select(F.col("id").alias("campaign_id"), F.col("id").alias("__tm_cid"))
    fb_rows = fb_insights.join(ads, "ad_id", "left").join(camps, "campaign_id", "left")
    facebook = NetworkCost(fb_rows, F.to_date("date_start"), F.col("__tm_cid"), F.col("spend"), None)
    return google, facebook


def attributed_touches(*, users: DataFrame, pages: DataFrame, id_graph: DataFrame, identifiers: DataFrame,
                       campaign_dim: DataFrame, referrals: DataFrame, window_days: int = 30,
                       own_site_like: str | None = OWN_SITE_REFERRER, fix_source_regex: bool = False) -> DataFrame:
    """M1-M5: visits resolved to users (M1), kept in the look-back window and
    classified (M2), plus referral touches (M3); one touch per user by
    priority (M4) with rollup labels (M5)."""
    visits = attribution.resolve_identity(pages, id_graph, identifiers, users.select("user_id", "created_at"))
    visits = attribution.visits_in_window(visits, None, window_days, own_site_like=own_site_like)
    visits = attribution.classify_visits(visits, campaign_dim, fix_join=fix_source_regex)
    touches = visits.select("user_id", "timestamp", "medium", "source", "path", "referrer", "campaign",
                            "content", "term", F.lit(0).cast("decimal(20,5)").alias("mgm_cost"))
    tb = [("referral_id", "desc")] if "referral_id" in referrals.columns else None
    mgm = attribution.referral_touches(referrals, users, tiebreak=tb)
    mgm = mgm.withColumn("mgm_cost", F.col("mgm_cost").cast("decimal(20,5)"))
    att = attribution.attribute_by_priority(stage.stack_rows(touches, mgm))
    return attribution.rollup_labels(att.select("user_id", "medium", "source", "referrer",
                                                F.col("path").alias("page_path"), "campaign", "content", "term",
                                                "mgm_cost"))


def user_attribution(*, users: DataFrame, pages: DataFrame, id_graph: DataFrame, identifiers: DataFrame,
                     campaign_dim: DataFrame, referrals: DataFrame, coupon_items: DataFrame,
                     coupons: DataFrame, challenges: DataFrame, deposits: DataFrame,
                     fb_insights: DataFrame, fb_ads: DataFrame, fb_campaigns: DataFrame,
                     google_reports: DataFrame, accounts: DataFrame, wallets: DataFrame,
                     wallet_transactions: DataFrame, blocklist: DataFrame, as_of,
                     window_days: int = 30, own_site_like: str | None = OWN_SITE_REFERRER,
                     excluded_users=EXCLUDED_USERS, fix_source_regex: bool = False,
                     staged: Callable[[DataFrame], DataFrame] | None = None, return_parts: bool = False):
    """One row per user with the attributed channel, cohort flags,
    cost per lead (CPL) and per activation (CAC), and cohort value sums.

    The per-user attributed frame feeds six look-ups (CPL, CAC, both
    untracked-cost anti joins, the final join); ``staged`` (if given) is
    the caller's step that writes it once and returns the re-read table, which
    the caller owns. Without it the frame is recomputed per use.
    ``return_parts`` returns the intermediate frames by name instead.
    """
    att = attributed_touches(users=users, pages=pages, id_graph=id_graph, identifiers=identifiers,
                             campaign_dim=campaign_dim, referrals=referrals, window_days=window_days,
                             own_site_like=own_site_like, fix_source_regex=fix_source_regex)
    u = users
    if excluded_users:
        u = u.where(~F.col("user_id").isin(*excluded_users))
    base = u.select("user_id", F.col("created_at").alias("__tm_created"), "first_login").join(att, "user_id", "left")
    labels = ["medium", "medium_agg", "source", "referrer", "page_path", "campaign", "campaign_agg", "content", "term"]
    base = base.select(
        "user_id", local_date("__tm_created").alias("created_at"),
        attribution_flag("first_login", "__tm_created"),
        *[F.coalesce(F.col(c), F.lit("None")).alias(c) for c in labels],
        F.coalesce("mgm_cost", F.lit(0).cast("decimal(20,5)")).alias("mgm_cost"))
    # Activation: first deposit and first coupon within 7 days of sign-up.
    fca = first_coupon(coupon_items, coupons, challenges)
    fda = deposits.groupBy("user_id").agg(F.min("reference_date").alias("first_deposit_at"))
    act = base.join(fca, "user_id", "left").join(fda, "user_id", "left")
    act = act.select(
        *base.columns,
        F.when(days_between("first_deposit_at", "created_at") <= 7, 1).otherwise(0).alias("deposited"),
        F.when(days_between("first_coupon_at", "created_at") <= 7, 1).otherwise(0).alias("activated"),
        F.to_date("first_coupon_at").alias("first_coupon_at"),
        attribution.bucket("first_coupon_gamemode").alias("first_coupon_gamemode"),
        F.coalesce("first_coupon_gamemode", F.lit("None")).alias("original_gamemode"))
    if staged is not None:
        act = staged(act)

    google, facebook = network_costs(google_reports, fb_insights, fb_ads, fb_campaigns)
    costs = {"adwords": google.cost, "facebook-ads": facebook.cost}
    rates, rates_full, untracked_all = {}, {}, {}
    for day_col, rate in (("created_at", "cpl"), ("first_coupon_at", "cac")):
        untracked = {}
        for label, net in (("adwords", google), ("facebook-ads", facebook)):
            untracked[label] = attribution.untracked_cost(
                net.rows, act, report_day=net.day, report_campaign=net.campaign, cost=net.cost_expr,
                att_day=day_col, source_label=label, round_to=net.round_to, convert=net.convert)
        untracked_all[rate] = untracked
        full = attribution.cost_per_user(act, costs, untracked, day_col, rate)
        rates_full[rate] = full
        rates[rate] = full.select(day_col, "medium_agg", "source", "campaign", rate)

    # M11 + M12: engagement sums; M13: ban status.
    ledger = attribution.engagement_ledger(users, accounts, wallets, wallet_transactions)
    stats = attribution.cohort_sums(ledger)
    bans = attribution.ban_status(blocklist, as_of)
    if return_parts:
        return {"att": att, "act": act, "costs": costs, "untracked": untracked_all, "rates_full": rates_full,
                "ledger": ledger, "stats": stats, "bans": bans}

    keys3 = ["medium_agg", "source", "campaign"]
    out = (act.join(stats, "user_id", "left").join(bans, "user_id", "left")
           .join(rates["cpl"], ["created_at", *keys3], "left")
           .join(rates["cac"], ["first_coupon_at", *keys3], "left"))
    fc = F.col("first_coupon_gamemode")
    sums = {}
    for name, _, _ in attribution.COHORT_SUMS:
        sums[name] = F.coalesce(F.col(name), F.lit(0))
    for d in (7, 30, 60, 90):
        sums[f"net_value_{d}d"] = coalesce_diff(f"value_spent_{d}d", f"value_received_{d}d")
    return out.select(
        "user_id",
        F.when(F.col("active_ban").eqNullSafe(F.lit(True)), F.lit("Banned")).otherwise(F.lit("Not Banned")).alias("ban_status"),
        "created_at", "logged_in", "medium", "medium_agg", "source", "referrer", "page_path", "campaign",
        "campaign_agg", "content", "term", "deposited", "activated", "first_coupon_at", "first_coupon_gamemode",
        "original_gamemode",
        flag(fc == "LOL").alias("lol_activated"), flag(fc == "ARAM").alias("aram_activated"),
        flag(fc == "TFT").alias("tft_activated"), flag(fc == "CS2").alias("cs_activated"),
        flag(fc == "VALORANT").alias("valorant_activated"),
        flag(fc == attribution.GAMEMODE_OTHER_LABEL).alias("other_activated"),
        (F.col("mgm_cost") + F.coalesce("cpl", F.lit(0))).alias("cpl_cost"),
        (F.col("mgm_cost") + F.coalesce("cac", F.lit(0))).alias("cac_cost"),
        *[sums[c].alias(c) for c in ATTRIBUTION_COLUMNS[26:]])


def attribution_flag(first_login: str, created: str) -> Column:
    """M6 for the login flag: first login at most 7 days after sign-up."""
    return F.when(days_between(first_login, created) <= 7, 1).otherwise(0).alias("logged_in")


# ====================================================================== M15-M16
# Cost-sheet sources that are ad networks, not influencers.
NON_INFLUENCER_FONTS = ("adwords", "amazon", "others", "adwords_lol", "adwords_tft", "adwords_cs", "facebook-ads")

ACQ_SUMS = ("new_users", "logged_in", "deposited", "activated_users", "value_spent_7d", "value_received_7d",
            "total_engagement_7d", "net_value_7d", "value_spent_30d", "value_received_30d",
            "total_engagement_30d", "net_value_30d", "value_spent_60d", "value_received_60d", "net_value_60d",
            "value_spent_90d", "value_received_90d", "net_value_90d")
ACQ_ACTIVATIONS = ("lol", "valorant", "aram", "tft", "cs", "other")
COST_PLACES = 6  # of the daily cost, rounded after the sum


def acquisition_daily(att: DataFrame, ads_cost: DataFrame, spine: DataFrame) -> DataFrame:
    """M15 + M16: registrations per (day, medium, source, campaign) of
    non-banned users plus influencer cost rows, on a calendar (R6), left
    joined with activations per (first-coupon day, labels).

    Faithful traps: the ban filter applies to registrations only (T8);
    activation cells whose (day, labels) have no registration cell are lost
    and null labels never match (T9).
    """
    reg = att.where(F.col("ban_status") == F.lit("Not Banned"))
    reg_aggs = [F.sum("cpl_cost").alias("cost"), F.count(F.lit(1)).alias("new_users"),
                F.sum("logged_in").alias("logged_in"), F.sum("deposited").alias("deposited"),
                F.sum("activated").alias("activated_users")]
    reg_aggs += [F.sum(c).alias(c) for c in ACQ_SUMS[4:]]
    daily = reg.groupBy(F.col("created_at").alias("_date"), "medium_agg", "source", "campaign_agg").agg(*reg_aggs)
    infl = ads_cost.where(~F.col("font").isin(*NON_INFLUENCER_FONTS))
    infl = infl.groupBy(F.col("reference_date").alias("_date"), F.lit("influencer").alias("medium_agg"),
                        F.col("font").alias("source"), F.col("font").alias("campaign_agg")).agg(
        F.sum("cost").alias("cost"))
    infl = infl.select("_date", "medium_agg", "source", "campaign_agg", F.col("cost").cast(daily.schema["cost"].dataType).alias("cost"),
                       *[F.lit(0).cast("long").alias(c) for c in ACQ_SUMS[:4]],
                       *[F.lit(0).cast(daily.schema[c].dataType).alias(c) for c in ACQ_SUMS[4:]])
    both = daily.select(*infl.columns).unionByName(infl)
    frame = reshape.fill_spine(spine, both.withColumnRenamed("_date", "__tm_d"), "__tm_d",
                               ["medium_agg", "source", "campaign_agg"], ["cost"], list(ACQ_SUMS))
    frame = frame.withColumn("cost", F.round("cost", COST_PLACES))
    act_aggs = [F.count(F.lit(1)).alias("activated_on_date")]
    act_aggs += [F.sum(f"{m}_activated").alias(f"{m}_activated_on_date") for m in ACQ_ACTIVATIONS]
    af = att.groupBy(F.col("first_coupon_at").alias("_date"), "medium_agg", "source", "campaign_agg").agg(*act_aggs)
    out = frame.join(af, on=["_date", "medium_agg", "source", "campaign_agg"], how="left")
    act_cols = ["activated_on_date"] + [f"{m}_activated_on_date" for m in ACQ_ACTIVATIONS]
    return out.select("_date", "medium_agg", "source", "campaign_agg", "cost", "new_users", "logged_in",
                      "deposited", "activated_users", *[F.coalesce(c, F.lit(0)).alias(c) for c in act_cols],
                      *ACQ_SUMS[4:])


# ====================================================================== M24-M26
def exchange_series(rates: DataFrame, spine: DataFrame) -> DataFrame:
    """Rate of every calendar day, weekly mean where a day is missing,
    rounded to 4 places."""
    return reshape.fill_from_week(spine, rates, "reference_date", "exchange")


def ads_cost_series(costs: DataFrame, as_of) -> DataFrame:
    """Long cost table, days before ``as_of`` only."""
    return costs.select(F.to_date("reference_date").alias("reference_date"), "cost", "font").where(
        F.col("reference_date") < F.to_date(F.lit(str(as_of))))


def message_log(messages: DataFrame, users: DataFrame) -> DataFrame:
    """Message log with the user found by receiver phone, else sender
    phone; null price -> 0; ``whatsapp:`` and ``-api`` stripped. Duplicate
    phones multiply messages as in the source (T19)."""
    strip = lambda c: F.replace(F.col(c), F.lit("whatsapp:"), F.lit(""))
    m = messages.withColumns({"__tm_to": strip("to"), "__tm_from": strip("from")})
    m = joins.coalesced_lookup(m, users, ["__tm_to", "__tm_from"], "tel", "user_id")
    return m.select(to_local("date_sent").alias("date_sent"), "user_id", F.col("__tm_to").alias("send_to"),
                    F.col("__tm_from").alias("from"), F.col("body").alias("message"),
                    F.coalesce("price", F.lit(0)).alias("price"), "status",
                    F.replace(F.col("direction"), F.lit("-api"), F.lit("")).alias("direction"))
