"""DuckDB SQL for the composite marts, written from what they mean.

Nothing here follows the marts' own steps: rules are relations (label maps,
settlement coefficients, feed rules, cost bases) that the rows join, a "newest"
or "best" row is an ordered ``first`` over the group, and both cost bases, all
ledger feeds and both user counts are one relation each.
"""

from __future__ import annotations

from tidemark.operators import attribution
from tidemark.plans import marts
from tidemark.plans.fixtures import (
    AS_OF,
    LEAGUE_SINCE,
    SPINE_END,
    SPINE_START,
    SUBSCRIPTION_USERS_SINCE,
    fixture_cte,
)

SEARCH = attribution.SEARCH_DOMAINS
SOCIAL = attribution.SOCIAL_DOMAINS


def visit_rules(influencer: str) -> str:
    """Medium and source of a visit ``v``: an influencer's, else what its
    campaign says, else its origin's."""
    by_influencer = "coalesce(v.campaign_source IN ('influencer', 'influencers'), false)"
    return (f"LATERAL (SELECT if({by_influencer}, 'influencer', coalesce(v.campaign_medium, o.medium)) AS medium,\n"
            f"    if({by_influencer}, {influencer}, coalesce(v.campaign_source, o.source)) AS source) m")


#: Medium and source by where the visit came from, whatever its campaign says.
ORIGIN = f"""LATERAL (SELECT
    CASE WHEN contains(coalesce(v.path, ''), 'blog') THEN 'search-blog' WHEN v.referrer IS NULL THEN 'direct'
         WHEN regexp_matches(v.referrer, '({SEARCH})') THEN 'search-brand'
         WHEN regexp_matches(v.referrer, '({SOCIAL})') THEN 'social' ELSE 'referral' END AS medium,
    CASE WHEN contains(coalesce(v.path, ''), 'blog') THEN v.path
         ELSE coalesce(nullif(regexp_extract(v.referrer, '({SEARCH}{SOCIAL})', 1), ''), v.referrer, 'direct')
         END AS source) o"""

# ------------------------------------------------------- users and attribution
USER_FIXTURES = ("users", "pages", "id_graph", "identifiers", "campaign_dim", "referrals", "coupon_items", "coupons",
                 "challenges", "deposits", "fb_insights", "fb_ads", "fb_campaigns", "google_reports", "accounts",
                 "wallets", "wallet_transactions", "user_blocklist", "ads_cost")

_COHORTS = ",\n    ".join(
    f"sum(CASE WHEN days_since_user_creation <= {days} AND list_contains({list(kinds)!r}, type) THEN value END) AS {name}"
    for name, kinds, days in attribution.COHORT_SUMS)



def _per_user(cost: str, users: str) -> str:
    """Cost per user in whole numbers of 10^-13, half up (DuckDB has no decimal division)."""
    units = f"CAST(round(coalesce({cost}, 0), 2) * 100 AS HUGEINT) * 100000000000"
    return f"(CAST((2 * {units} + {users}) // (2 * {users}) AS DECIMAL(24,0)) * CAST(0.0000000000001 AS DECIMAL(14,13)))"


USER_RELATIONS = {
    "owner": """
  SELECT e.segment_id, u.user_id, u.created_at AS joined
  FROM (SELECT segment_id, first(canonical_segment_id ORDER BY ts DESC NULLS FIRST, canonical_segment_id) AS person
        FROM id_graph GROUP BY segment_id) e, identifiers i, users u
  WHERE i.type = 'user_id' AND i.canonical_segment_id = e.person AND u.user_id = i.value""",
    "visit": """
  SELECT v.page_id, w.user_id, v.ts, m.medium, m.source, v.path, v.referrer,
    coalesce(v.campaign_name, CASE WHEN contains(v.path, 'blog') THEN v.path END) AS campaign,
    v.campaign_content AS content, v.campaign_term AS term
  FROM owner w JOIN pages v USING (segment_id) LEFT JOIN campaign_dim d ON d.source_name = v.campaign_name,
    """ + ORIGIN + ", " + visit_rules("d.influencer") + """
  WHERE v.ts <= w.joined AND v.ts >= w.joined - INTERVAL 30 DAY
    AND NOT contains(coalesce(v.referrer, ''), '#####.')""",
    "invited": """
  SELECT referred_id AS user_id, max(created_at) AS ts, best.source, best.mgm_cost
  FROM (SELECT r.*, first({'source': p.email, 'ts': r.created_at,
                'mgm_cost': CAST(if(r.status = 'FINISHED', r.reward, 0) AS DECIMAL(20,5))}
                ORDER BY r.created_at DESC NULLS FIRST, r.referral_id DESC NULLS FIRST)
          OVER (PARTITION BY r.referred_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS best
        FROM referrals r JOIN users p ON p.user_id = r.referrer_id)
  GROUP BY ALL""",
    "preference": """
  SELECT * FROM (VALUES ('mgm', 1), ('paid-media', 2), ('site', 2), ('influencers', 3), ('influencer', 3), ('cpv', 3),
    ('search-brand', 5), ('search-blog', 5), ('referral', 6), ('direct', 7)) t(medium, place)""",
    "touch": """
  SELECT user_id, ts, medium, source, referrer, path, campaign, content, term, CAST(0 AS DECIMAL(20,5)) AS mgm_cost
  FROM visit
  UNION ALL BY NAME SELECT user_id, ts, 'mgm' AS medium, source, mgm_cost FROM invited""",
    "rollup": """
  SELECT * FROM (VALUES ('google-ads', 'paid-media'), ('paid-media', 'paid-media'), ('site', 'paid-media'),
    ('youtube', 'paid-media'), ('influencer', 'influencer'), ('cpv', 'influencer')) t(medium, medium_agg)""",
    "credited": """
  SELECT user_id, t.medium, t.source, t.referrer, t.path AS page_path, t.campaign, t.content, t.term, t.mgm_cost,
    coalesce(g.medium_agg, t.medium) AS medium_agg,
    if(list_contains(['influencer', 'mgm', 'social', 'search-brand', 'search-blog'], t.medium), t.source, t.campaign)
      AS campaign_agg
  FROM (SELECT user_id, first(touch ORDER BY coalesce(place, 4), ts DESC NULLS FIRST, source NULLS LAST,
          campaign NULLS LAST, path NULLS LAST, referrer NULLS LAST, content NULLS LAST, term NULLS LAST,
          mgm_cost NULLS LAST) AS t
        FROM touch LEFT JOIN preference USING (medium) GROUP BY user_id)
  LEFT JOIN rollup g ON g.medium = t.medium""",
    "debut": """
  SELECT c.user_id, min(c.created_at) AS at,
    first(coalesce(h.external_gamemode, h.gamemode)
          ORDER BY c.created_at, c.coupon_id, coalesce(h.external_gamemode, h.gamemode) NULLS LAST) AS mode
  FROM coupons c JOIN coupon_items i USING (coupon_id) LEFT JOIN challenges h ON h.challenge_id = i.challenge_id
  WHERE c.type <> 'FREE' AND list_contains(['WON', 'LOST', 'REFUND'], c.coupon_status) GROUP BY c.user_id""",
    "family": """
  SELECT * FROM (VALUES ('LOLEXTERNAL5V5', 'LOL'), ('LOL1V1', 'LOL'), ('LOL2V2', 'LOL'), ('LOLEXTERNALBLITZ', 'LOL'),
    ('VALEXTERNALRANKED', 'VALORANT'), ('LOLEXTERNALARAM', 'ARAM'), ('TFTEXTERNALRANKED', 'TFT'),
    ('CS2EXTERNALRANKED', 'CS2'), ('CS2EXTERNALFACEIT', 'CS2')) t(mode, label)""",
    "person": """
  SELECT u.user_id, local.day AS created_at,
    CAST(coalesce(CAST(u.first_login AS DATE) - CAST(u.created_at AS DATE) <= 7, false) AS INTEGER) AS logged_in,
    coalesce(t.medium, 'None') AS medium, coalesce(t.medium_agg, 'None') AS medium_agg,
    coalesce(t.source, 'None') AS source, coalesce(t.referrer, 'None') AS referrer,
    coalesce(t.page_path, 'None') AS page_path, coalesce(t.campaign, 'None') AS campaign,
    coalesce(t.campaign_agg, 'None') AS campaign_agg, coalesce(t.content, 'None') AS content,
    coalesce(t.term, 'None') AS term, coalesce(t.mgm_cost, 0) AS mgm_cost,
    CAST(coalesce(CAST(d.at AS DATE) - local.day <= 7, false) AS INTEGER) AS deposited,
    CAST(coalesce(CAST(debut.at AS DATE) - local.day <= 7, false) AS INTEGER) AS activated,
    CAST(debut.at AS DATE) AS first_coupon_at,
    coalesce(family.label, if(debut.mode IS NULL, 'None', 'Outros')) AS first_coupon_gamemode,
    coalesce(debut.mode, 'None') AS original_gamemode
  FROM users u LEFT JOIN credited t USING (user_id) LEFT JOIN debut ON debut.user_id = u.user_id
  LEFT JOIN family ON family.mode = debut.mode
  LEFT JOIN (SELECT user_id, min(reference_date) AS at FROM deposits GROUP BY user_id) d ON d.user_id = u.user_id,
  LATERAL (SELECT CAST((u.created_at AT TIME ZONE 'UTC') AT TIME ZONE 'America/Sao_Paulo' AS DATE) AS day) local""",
    "spend": """
  SELECT 'adwords' AS network, CAST(date_stop AS DATE) AS day, campaign_id AS campaign,
    CAST(CAST(cost AS DECIMAL(20,0)) * CAST(0.000001 AS DECIMAL(7,6)) AS DECIMAL(30,6)) AS cost FROM google_reports
  UNION ALL
  SELECT 'facebook-ads', CAST(i.date_start AS DATE), (SELECT c.id FROM fb_campaigns c JOIN fb_ads a
    ON a.campaign_id = c.id WHERE a.id = i.ad_id), CAST(i.spend AS DECIMAL(30,6)) FROM fb_insights i""",
    "paid": """
  SELECT network, day, campaign, if(network = 'adwords', round(sum(cost), 2), sum(cost)) AS cost
  FROM spend GROUP BY network, day, campaign""",
    "dated": """
  SELECT unnest([{'basis': 'cpl', 'day': created_at}, {'basis': 'cac', 'day': first_coupon_at}], recursive := true),
    user_id, medium_agg, source, campaign FROM person""",
    "unspent": """
  SELECT basis, network, s.day, if(network = 'adwords', round(sum(cost), 2), sum(cost)) AS cost
  FROM spend s, (VALUES ('cpl'), ('cac')) b(basis)
  WHERE NOT EXISTS (FROM dated p WHERE p.basis = b.basis AND p.day = s.day AND p.source = s.network
                    AND p.campaign = s.campaign)
  GROUP BY basis, network, s.day""",
    "rate": f"""
  WITH cell AS (SELECT basis, day, medium_agg, source, campaign, count(DISTINCT user_id) AS users FROM dated
                WHERE medium_agg = 'paid-media' AND day IS NOT NULL GROUP BY ALL),
  day_users AS (SELECT basis, day, source, sum(users) AS users FROM cell GROUP BY ALL)
  SELECT c.basis, c.day, c.medium_agg, c.source, c.campaign, c.users,
    round(CAST(coalesce(p.cost, 0) AS DECIMAL(18,2)), 2) AS campaign_cost,
    {_per_user('p.cost', 'c.users')} + {_per_user('n.cost', 'd.users')} AS rate
  FROM cell c JOIN day_users d ON d.basis = c.basis AND d.day = c.day AND d.source = c.source
  LEFT JOIN paid p ON p.network = c.source AND p.day = c.day AND p.campaign = c.campaign
  LEFT JOIN unspent n ON n.basis = c.basis AND n.network = c.source AND n.day = c.day""",
    "engagement": """
  SELECT u.user_id, CAST(t.created_at AS DATE) AS transaction_date,
    CAST(CAST(t.created_at AS DATE) - CAST(u.created_at AS DATE) AS INTEGER) AS days_since_user_creation,
    kind.type, t.transaction_amount AS value
  FROM wallet_transactions t JOIN wallets w USING (wallet_id) JOIN accounts a USING (account_id)
  JOIN users u ON u.user_id = a.user_id
  LEFT JOIN (VALUES ('CREDIT', 'BRL', 'PAYMENT'), ('CREDIT', 'BONUS_BRL', 'BONUS_USE'), ('DEBIT', 'BRL', 'GAIN'))
    kind(side, currency, type) ON kind.side = t.transaction_balance AND kind.currency = w.currency
  WHERE list_contains(['LEAGUE_TICKET', 'LEAGUE_REGISTRATION', 'COUPON', 'COUPON_REFUND', 'BUG_AMOUNT', 'MATCH'],
                      t.transaction_type)""",
    "cohort": f"""
  SELECT user_id,
    {_COHORTS}
  FROM engagement GROUP BY user_id""",
    "ban": f"""
  SELECT user_id, coalesce(CAST(first(expiry ORDER BY created_at DESC NULLS FIRST, expiry DESC NULLS FIRST) AS DATE)
                           > DATE '{AS_OF}', false) AS active_ban
  FROM user_blocklist GROUP BY user_id""",
}
_NETS = ", ".join(f"coalesce(value_spent_{d}d - value_received_{d}d, 0) AS net_value_{d}d" for d in (7, 30, 60, 90))
_FLAGS = ", ".join(f"CAST(first_coupon_gamemode = '{label}' AS INTEGER) AS {name}_activated" for name, label in (
    ("lol", "LOL"), ("aram", "ARAM"), ("tft", "TFT"), ("cs", "CS2"), ("valorant", "VALORANT"), ("other", "Outros")))
USER_RELATIONS["attributed"] = f"""
  SELECT p.* EXCLUDE (mgm_cost), if(coalesce(ban.active_ban, false), 'Banned', 'Not Banned') AS ban_status, {_FLAGS},
    mgm_cost + coalesce(lead.rate, 0) AS cpl_cost, mgm_cost + coalesce(won.rate, 0) AS cac_cost,
    {', '.join(f'coalesce({name}, 0) AS {name}' for name, _, _ in attribution.COHORT_SUMS)}, {_NETS}
  FROM person p LEFT JOIN cohort USING (user_id) LEFT JOIN ban ON ban.user_id = p.user_id
  LEFT JOIN rate lead ON lead.basis = 'cpl' AND lead.day = p.created_at AND lead.medium_agg = p.medium_agg
    AND lead.source = p.source AND lead.campaign = p.campaign
  LEFT JOIN rate won ON won.basis = 'cac' AND won.day = p.first_coupon_at AND won.medium_agg = p.medium_agg
    AND won.source = p.source AND won.campaign = p.campaign"""

_COUNTS, _VALUES = marts.ACQ_SUMS[1:4], marts.ACQ_SUMS[4:]
_ACQ = f"""
WITH fact AS (
  SELECT created_at AS _date, medium_agg, source, campaign_agg, CAST(cpl_cost AS DECIMAL(38,13)) AS cost,
    1 AS new_users, logged_in, deposited, activated AS activated_users, {', '.join(_VALUES)}
  FROM attributed WHERE ban_status = 'Not Banned'
  UNION ALL
  SELECT CAST(reference_date AS DATE), 'influencer', font, font, CAST(cost AS DECIMAL(38,13)), 0, 0, 0, 0,
    {', '.join('0' for _ in _VALUES)}
  FROM ads_cost WHERE NOT list_contains(['adwords', 'amazon', 'others', 'adwords_lol', 'adwords_tft', 'adwords_cs',
                                         'facebook-ads'], font)),
won AS (
  SELECT first_coupon_at, medium_agg, source, campaign_agg, count(*) AS activated_on_date,
    {', '.join(f'CAST(sum({m}_activated) AS BIGINT) AS {m}_activated_on_date' for m in marts.ACQ_ACTIVATIONS)}
  FROM attributed GROUP BY ALL),
calendar AS (SELECT CAST(range AS DATE) AS _date FROM range(DATE '{SPINE_START}', DATE '{SPINE_END}' + 1, INTERVAL 1 DAY)),
by_day AS (
  SELECT k._date, medium_agg, source, campaign_agg, CAST(round(coalesce(sum(cost), 0), 6) AS DECIMAL(38,6)) AS cost,
    {', '.join(f'CAST(sum({c}) AS BIGINT) AS {c}' for c in ('new_users', 'logged_in', 'deposited', 'activated_users'))},
    {', '.join(f'sum({c}) AS {c}' for c in _VALUES)}
  FROM calendar k LEFT JOIN fact USING (_date) GROUP BY ALL)
SELECT b.*, coalesce(activated_on_date, 0) AS activated_on_date,
  {', '.join(f'coalesce({m}_activated_on_date, 0) AS {m}_activated_on_date' for m in marts.ACQ_ACTIVATIONS)}
FROM by_day b LEFT JOIN won w ON w.first_coupon_at = b._date AND w.medium_agg = b.medium_agg AND w.source = b.source
  AND w.campaign_agg = b.campaign_agg"""


def _with(fixtures: tuple[str, ...], relations: dict[str, str], final: str) -> str:
    body = ",\n".join(f"{name} AS ({sql})" for name, sql in relations.items())
    return f"{fixture_cte(*fixtures)},\n{body}\n{final}"


def user_sql(final: str, excluded: tuple = ()) -> str:
    """``excluded`` users are no persons of the mart; their visits and referrals still count for others."""
    relations = dict(USER_RELATIONS)
    if excluded:
        relations["person"] = relations["person"].replace(
            "FROM users u LEFT JOIN credited", f"FROM (SELECT * FROM users WHERE user_id NOT IN {excluded}) u LEFT JOIN credited")
    return _with(USER_FIXTURES, relations, final)


def acquisition_sql() -> str:
    return user_sql(f"SELECT * FROM ({_ACQ})")


# ------------------------------------------------------------ coupons and money
MONEY_FIXTURES = ("blocklist_events", "user_notes", "payouts", "gateway_transactions", "accounts", "coupons",
                  "grouped_challenges", "transactions", "transaction_items", "wallets", "super_tips", "coupon_items",
                  "reputations", "match_players", "players", "transactions_finished", "league_points", "challenges",
                  "users")

MONEY_RELATIONS = {
    "block": """
  SELECT b.block_id, user_id, b.created_at, b.expire_at, b.description, n.notes, n.flag, n.cheat AS is_cheating,
    n.smurf AS is_smurfing, n.derank AS is_deranking, n.duo_boost AS is_duo_boosting,
    n.slow_climb AS is_slow_climbing, n.gamemode, true AS active_ban
  FROM (SELECT user_id, first({'block_id': user_blocklist_id, 'created_at': created_at, 'expire_at': expiry,
            'description': description, 'note': user_notes_id}
            ORDER BY created_at DESC, user_blocklist_id DESC) AS b
        FROM blocklist_events WHERE active_ban GROUP BY user_id)
  LEFT JOIN user_notes n ON n.user_notes_id = b.note""",
    "banned": """
  SELECT block.*,
    (SELECT count(DISTINCT transaction_id) FROM payouts y WHERE y.user_id = block.user_id
       AND y.created_at BETWEEN block.created_at - INTERVAL 14 DAY AND block.created_at) AS successful_payouts_in_2_weeks,
    (SELECT CAST(coalesce(sum(absolut_amount), 0) AS DOUBLE) FROM payouts y WHERE y.user_id = block.user_id
       AND y.created_at BETWEEN block.created_at - INTERVAL 14 DAY AND block.created_at) AS successful_payouts_amount,
    (SELECT count(DISTINCT g.transaction_id) FROM gateway_transactions g JOIN accounts a USING (account_id)
       WHERE g.gateway_name = 'STARKBANK' AND g.status <> 'PAID' AND a.user_id = block.user_id
       AND g.created_at BETWEEN block.created_at - INTERVAL 3 DAY AND block.created_at) AS attempts_payouts_before_ban,
    (SELECT CAST(coalesce(sum(g.amount), 0) AS DOUBLE) FROM gateway_transactions g JOIN accounts a USING (account_id)
       WHERE g.gateway_name = 'STARKBANK' AND g.status <> 'PAID' AND a.user_id = block.user_id
       AND g.created_at BETWEEN block.created_at - INTERVAL 3 DAY AND block.created_at) AS attempted_amount
  FROM block""",
    "paid_in": """
  SELECT t.coupon_id, array_to_string(list_sort(list(w.currency) FILTER (WHERE w.currency IS NOT NULL)), ', ') AS money
  FROM accounts a JOIN wallets w USING (account_id) JOIN transaction_items i USING (wallet_id)
  JOIN transactions t USING (transaction_id)
  WHERE a.type = 'PLAYER_ACCOUNT' AND i.status = 'CREDIT' AND t.type = 'COUPON' GROUP BY t.coupon_id""",
    "settlement": """
  SELECT * FROM (VALUES ('WON', 'BRL', -1, 0, 1, 0), ('WON', 'BONUS_BRL', -1, 0, 1, 0), ('LOST', 'BRL', 0, 1, 0, -1),
    ('LOST', 'BONUS_BRL', 0, 0, 0, 0), ('REFUND', NULL, 0, -1, 0, -1))
    t(status, money, house_win, house_stake, user_win, user_stake)""",
    "finished": """
  SELECT c.coupon_id, c.user_id, c.created_at, g.name AS challenge_name, round(c.odd, 2) AS odd,
    c.type AS coupon_type, round(c.amount, 2) AS bet_amount,
    round(if(c.coupon_status = 'WON', -x.win, c.amount), 2) AS balance_amount,
    round(if(c.coupon_status = 'WON', x.win, -c.amount), 2) AS user_balance_amount,
    s.house_win * x.win + s.house_stake * c.amount AS balance_amount_bonus,
    s.user_win * x.win + s.user_stake * c.amount AS user_balance_amount_bonus,
    k.money AS currency, c.coupon_status, c.rollover_id, c.grouped_challenge_id,
    coalesce(g.gamemode, g.external_gamemode) AS gamemode,
    c.user_id IN (SELECT user_id FROM block WHERE user_id IS NOT NULL) AS is_banned,
    c.coupon_id IN (SELECT coupon_id FROM super_tips WHERE coupon_id IS NOT NULL) AS is_supertip,
    f.match AS external_match_id, c.origin, e.max_amount, e.metadata AS reputation_metadata
  FROM coupons c LEFT JOIN grouped_challenges g USING (grouped_challenge_id)
  LEFT JOIN paid_in k ON k.coupon_id = c.coupon_id
  LEFT JOIN settlement s ON s.status = c.coupon_status AND coalesce(s.money, k.money, '') = coalesce(k.money, '')
  LEFT JOIN (SELECT coupon_id, first(external_match_id ORDER BY created_at, external_match_id) AS match
             FROM coupon_items GROUP BY coupon_id) f ON f.coupon_id = c.coupon_id
  LEFT JOIN (players p JOIN match_players m ON m.external_player_id = p.external_player_id)
    ON m.external_match_id = f.match AND p.user_id = c.user_id AND p.external_gamemode = g.external_gamemode
  LEFT JOIN reputations e ON e.external_match_player_id = m.external_match_player_id,
  LATERAL (SELECT c.amount * (c.odd - 1) AS win) x
  WHERE list_contains(['WON', 'LOST', 'REFUND'], c.coupon_status)""",
    "feed": """
  SELECT * FROM (VALUES ('league', ['LEAGUE_REGISTRATION', 'LEAGUE_TICKET'], 'CREDIT', 'BRL'),
    ('subscription', ['SUBSCRIPTION_OLD_USER'], 'CREDIT', NULL), ('coupon', ['COUPON', 'COUPON_REFUND'], NULL, 'BRL'),
    ('bonus', ['ROLLOVER', 'BONUS', 'LEAGUE_PRIZE', 'COUPON_REFUND', 'BACKOFFICE_BONUS'], 'DEBIT', 'BONUS_BRL'),
    ('pay', ['PAYIN', 'PAYOUT'], NULL, NULL)) t(feed, kinds, side, money)""",
    "league_mode": """
  SELECT DISTINCT l.league_id, h.external_gamemode AS mode FROM league_points l
  LEFT JOIN coupon_items i USING (external_match_id) LEFT JOIN challenges h ON h.challenge_id = i.challenge_id""",
    "booked": f"""
  SELECT f.feed, CAST(if(f.feed = 'pay', t.updated_at, t.created_at) AS DATE) AS reference_date,
    if(f.feed = 'coupon', c.user_id, t.user_id) AS user_id,
    CASE f.feed WHEN 'league' THEN coalesce(l.mode, 'LOL1V1') WHEN 'coupon' THEN c.gamemode END AS gamemode,
    t.transaction_id, CAST(if(f.feed = 'coupon', t.amount_rev, t.absolut_amount) AS DECIMAL(38,6)) AS amount,
    CASE f.feed WHEN 'league' THEN 'LEAGUE_ENTRANCE' WHEN 'bonus' THEN 'BONUS' WHEN 'coupon' THEN
      CASE t.debit_credit WHEN 'ARTIFICIAL' THEN 'RECOVERED_REVENUE' WHEN 'ARTIFICIAL_UNBANNED'
        THEN 'ARTIFICIAL_UNBANNED' ELSE if(t.debit_credit IS NULL, NULL, t.transaction_type) END
      ELSE t.transaction_type END AS type
  FROM transactions_finished t JOIN feed f ON list_contains(f.kinds, t.transaction_type)
    AND (f.side IS NULL OR f.side = t.debit_credit) AND (f.money IS NULL OR f.money = t.wallet_currency)
  LEFT JOIN league_mode l ON f.feed = 'league' AND l.league_id = t.league_id
  LEFT JOIN finished c ON f.feed = 'coupon' AND c.coupon_id = t.coupon_id
  LEFT JOIN users u ON f.feed = 'subscription' AND u.user_id = t.user_id
  WHERE CASE f.feed WHEN 'league' THEN CAST(t.created_at AS DATE) >= DATE '{LEAGUE_SINCE}'
    WHEN 'subscription' THEN u.created_at >= TIMESTAMP '{SUBSCRIPTION_USERS_SINCE} 00:00:00' ELSE true END
  UNION ALL BY NAME
  SELECT 'converted' AS feed, CAST(created_at AS DATE) AS reference_date, user_id, gamemode,
    CAST(balance_amount AS DECIMAL(38,6)) AS amount, 'BONUS_CONVERTED' AS type
  FROM finished WHERE currency = 'BONUS_BRL' AND coupon_status = 'WON'""",
    "spread": """
  SELECT 'GENERAL' AS gamemode, reference_date, type, amount FROM booked
  UNION ALL BY NAME
  SELECT if(feed IN ('subscription', 'bonus', 'pay'), coalesce(p.gamemode, 'LOL1V1'), b.gamemode) AS gamemode,
    reference_date, type, amount
  FROM booked b LEFT JOIN (SELECT DISTINCT user_id, gamemode FROM finished) p
    ON p.user_id = b.user_id AND b.feed IN ('subscription', 'bonus', 'pay')""",
    "active": """
  SELECT CAST(date_trunc('month', created_at) AS DATE) AS month,
    if(grouping(gamemode) = 1, 'GENERAL', gamemode) AS gamemode, count(DISTINCT user_id) AS monthly_users
  FROM finished GROUP BY GROUPING SETS ((date_trunc('month', created_at)),
                                        (date_trunc('month', created_at), gamemode))""",
}
_SIGNED = {"abs": "abs(amount)", "neg": "-amount", "amount": "amount"}
_MEASURES = ",\n    ".join(
    f"CAST(round(coalesce(sum({_SIGNED[how]}) FILTER (WHERE list_contains({list(kinds)!r}, type)), 0), 2) AS DECIMAL(38,2))"
    f" AS {name}" for name, kinds, how in marts.FINANCIAL_MEASURES)
MONEY_RELATIONS["daily"] = f"""
  SELECT s.*, a.monthly_users
  FROM (SELECT reference_date, gamemode, {_MEASURES},
      CAST(round(coalesce(sum(amount) FILTER (WHERE type = 'PAYIN'), 0)
                 - coalesce(sum(amount) FILTER (WHERE type = 'PAYOUT'), 0), 2) AS DECIMAL(38,2)) AS payin_payout_balance
    FROM spread GROUP BY ALL) s
  LEFT JOIN active a ON a.month = CAST(date_trunc('month', s.reference_date) AS DATE) AND a.gamemode = s.gamemode"""


def money_sql(final: str) -> str:
    return _with(MONEY_FIXTURES, MONEY_RELATIONS, final)
