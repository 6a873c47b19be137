"""Staging models of the real tables (M27-M31 and accounts), as data.

A :class:`Model` names a table's output columns in order, which of them come
from a differently named source column, which are cast, and which are shifted
to local time. ``stage_model`` stages one export; ``merged``, ``latest`` and
``ranked`` join it with the legacy export of the same table.

Two column lists differ on purpose from the tables they were taken from: the
25 and 50 per cent video rates, and a log-in's platform and coupon, are each
two columns here (one of each pair was lost to a missing comma).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import to_local
from tidemark.operators import stage as ops
from tidemark.operators.checks import run_checks
from tidemark.operators.reshape import parse_measure_columns, unpivot_measures
from tidemark.plans import marts
from tidemark.plans.fixtures import AS_OF
from tidemark.sources.files import Tables


@dataclass(frozen=True)
class Model:
    """Output columns in order; ``source`` maps output to input names,
    ``casts`` output names to types; ``local`` names the local-time columns."""

    columns: str
    source: dict = field(default_factory=dict)
    casts: dict = field(default_factory=dict)
    local: tuple = ()
    merge: tuple = ()  # ("primary" | "latest" | "ranked", key, order)

    @property
    def names(self) -> list[str]:
        return self.columns.split()


# Column lists, renames and casts of the staged tables.
MODELS = {
    "usage": Model("""account_id workspace_id record_id sku_name cloud usage_start_time usage_end_time usage_date
        custom_tags usage_unit usage_quantity usage_metadata identity_metadata record_type ingestion_date
        billing_origin_product product_features usage_type"""),
    "list_prices": Model("account_id price_start_time price_end_time sku_name cloud currency_code usage_unit pricing"),
    "fb_ads": Model("""ad_id name status adlabels adset_id bid_info bid_type creative targeting account_id bid_amount
        campaign_id created_time updated_time source_ad_id tracking_specs recommendations conversion_specs
        effective_status last_updated_by_app_id""", {"ad_id": "id"}),
    "fb_ads_insights": Model("""adset_id ad_id account_id campaign_id adset_name ad_name objective campaign_name
        date_start date_stop created_time updated_time cpc cpm cpp ctr reach spend clicks impressions unique_clicks
        conversions actions""", casts=dict.fromkeys(("cpc", "cpm", "cpp", "ctr", "spend"), "float")),
    "fb_campaigns": Model("""campaign_id name status adlabels objective spend_cap stop_time account_id start_time
        buying_type issues_info bid_strategy created_time updated_time daily_budget lifetime_budget budget_remaining
        effective_status boosted_object_id configured_status source_campaign_id special_ad_category
        smart_promotion_type budget_rebalance_flag special_ad_category_country""", {"campaign_id": "id"}),
    "pipe_ads": Model("""ad_id adset_id campaign_id name account_id received_at status url_parameters utm_medium uuid_ts
        bid_type received_date""", {"ad_id": "id"}),
    "pipe_campaigns": Model("""campaign_id name effective_status account_id received_at start_time uuid_ts buying_type
        received_date""", {"campaign_id": "id"}),
    "pipe_insights": Model("""insight_id ad_id reach clicks impressions link_clicks unique_impressions unique_clicks
        spend social_spend inline_post_engagements frequency uuid_ts date_start date_stop received_at""",
                           {"insight_id": "id"}),
    "google_campaigns": Model("""campaign_id adwords_customer_id serving_status status name start_date end_date
        received_at uuid_ts received_date""", {"campaign_id": "id"}, {"campaign_id": "string"},
                              merge=("primary", "campaign_id", None)),
    "google_reports": Model("""campaign_performance_report_id impressions clicks cost invalid_clicks engagements
        conversions video_views interactions active_view_measurability average_cost campaign_id campaign_status
        campaign_trial_type date_stop gmail_saves adwords_customer_id all_conversion_rate date_start
        active_view_impressions uuid_ts view_through_conversions base_campaign_id received_at video_quartile_25_rate
        video_quartile_50_rate video_quartile_75_rate video_quartile_100_rate conversion_value
        is_budget_explicitly_shared value_per_all_conversion active_view_measurable_impressions all_conversion_value
        amount bounce_rate budget_id interaction_types average_time_on_site gmail_secondary_clicks
        active_view_measurable_cost active_view_viewability advertising_channel_sub_type all_conversions gmail_forwards
        video_view_rate received_date""", {"campaign_performance_report_id": "id"}, {"campaign_id": "string"},
                            merge=("primary", "campaign_performance_report_id", None)),
    "coupon_created": Model("""id event_source_slug original_timestamp received_at segment_id user_id
        context_library_version coupon_amount_real event_source_name event_text gamemode timestamp _id coupon_amount
        event fraud_score is_first_coupon is_first_coupon_at_gamemode uuid_ts context_library_name coupon_id
        coupon_max_amount event_source_id received_date amount external_gamemode""", local=("timestamp",)),
    "deposit_confirmed": Model("""id event event_text event_source_name context_library_version event_source_slug
        original_timestamp received_at uuid_ts timestamp received_date context_library_name event_source_id segment_id
        user_id email transaction_id payment_method value currency first_deposit bonus_received bonus_value coupon""",
                               local=("timestamp",)),
    "first_login": Model("""first_login_id name original_timestamp platform sent_at email event_source_id
        event_source_slug received_at segment_id context_library_name context_library_version event uuid_ts timestamp
        user_id event_source_name event_text first_login received_date referrer_url source context_page_path
        context_page_title context_ip context_user_agent_data_platform context_user_agent_data_mobile medium
        context_user_agent context_user_agent_data_brands context_locale gaid anonymous_id context_page_url
        context_timezone""", {"first_login_id": "id"}),
    "first_match_finished": Model("""event first_match_finished_id original_timestamp segment_id transaction_id
        context_library_name event_source_slug event_text timestamp uuid_ts coupon_did_win coupon_id event_source_id
        user_id context_library_version coupon_balance event_source_name gamemode sent_at received_at coupon_max_amount
        coupon_amount coupon_amount_real user_tip_score""", {"first_match_finished_id": "id"}, local=("timestamp",)),
    "mobile_attribution": Model("""mobile_attribution_id context_page_path medium source anonymous_id user_id
        context_user_agent_data_mobile context_page_title context_page_url event_source_id referrer_url segment_id
        timestamp uuid_ts context_library_name context_library_version email event context_ip context_timezone
        context_locale event_text context_user_agent context_user_agent_data_platform context_user_agent_data_brands
        event_source_slug received_at sent_at gaid original_timestamp event_source_name received_date""",
                                {"mobile_attribution_id": "id"}),
    "profile_merges": Model("""profile_merge_id received_at segment_id seq uuid_ts __profile_version
        canonical_segment_id received_date""", {"profile_merge_id": "id"}),
    "user_attribution_gtm": Model("""id event_source_name traits_phone context_user_agent_data_mobile event
        context_user_agent_data_brands context_user_agent_data_platform context_page_title traits_gclid event_source_id
        received_at segment_id traits_ip anonymous_id context_library_name original_timestamp timestamp context_ip
        event_source_slug traits_email traits_gbraid traits_ttclid traits_user_agent uuid_ts event_text sent_at
        context_page_referrer context_timezone context_user_agent traits_fbp traits_user_id context_locale
        context_page_path traits_wbraid user_id context_library_version context_page_url received_date
        context_campaign_content context_campaign_term context_page_search context_campaign_medium
        context_campaign_source context_campaign_name context_campaign_id traits_fbclid""", local=("timestamp",)),
    "user_logged_in": Model("""id event event_text event_source_name context_library_version event_source_slug
        original_timestamp received_at uuid_ts timestamp received_date context_library_name event_source_id segment_id
        user_id email name first_login platform coupon""", local=("timestamp",)),
    "user_traits": Model("""user_trait_id name received_at seq uuid_ts value __profile_version canonical_segment_id
        received_date""", {"user_trait_id": "id"}),
    "id_graph_updates": Model("""id_graph_update_id canonical_segment_id triggering_event_id
        triggering_event_source_name triggering_event_source_slug uuid_ts triggering_event_type received_at segment_id
        seq timestamp triggering_event_name triggering_event_source_id received_date""", {"id_graph_update_id": "id"},
                              local=("timestamp",), merge=("latest", "id_graph_update_id", "timestamp")),
    "user_identifiers": Model("""user_identifier_id value profile_version canonical_segment_id received_at seq type
        uuid_ts received_date""", {"user_identifier_id": "id", "profile_version": "__profile_version"},
                              merge=("latest", "user_identifier_id", "received_at")),
    "pages": Model("""page_id event_source_id received_at context_campaign_source context_library_name
        context_page_path context_page_referrer context_user_agent url context_campaign_name context_library_version
        context_page_title context_user_agent_data_platform referrer segment_id context_page_search timestamp user_id
        context_user_agent_data_brands original_timestamp context_timezone path title anonymous_id
        context_campaign_content event_source_slug uuid_ts sent_at context_campaign_medium context_ip context_locale
        context_page_url context_user_agent_data_mobile event_source_name search received_date context_campaign_id
        context_campaign_term""", {"page_id": "id"}, local=("timestamp",), merge=("ranked", "page_id", "timestamp")),
    "accounts": Model("account_id created_at updated_at name type user_id", {"account_id": "id"},
                      local=("created_at", "updated_at")),
}


def stage_model(df: DataFrame, model: Model) -> DataFrame:
    """One export staged: projection, renames, casts, local times. A legacy
    export without ``received_date`` gets a null one."""
    columns = []
    for name in model.names:
        source = model.source.get(name, name)
        if source == "received_date" and source not in df.columns:
            columns.append((F.lit(None).cast("string"), name))
        else:
            columns.append((to_local(source) if name in model.local else F.col(source), name))
    return ops.stage(df, columns, casts=model.casts)


def stage_both(df: DataFrame, legacy: DataFrame, model: Model) -> DataFrame:
    """Both exports staged and joined as the model's merge rule says."""
    new, old = stage_model(df, model), stage_model(legacy, model)
    how, key, order = model.merge
    if how == "primary":
        return ops.unify_prefer_primary(new, old, key)
    if how == "latest":
        return ops.unify_latest(new, old, [key], order, ties(model))
    return ops.unify_ranked(new, old, [key], order, tiebreak=ties(model))


def ties(model: Model) -> list[tuple[str, str]]:
    """Order among rows of one key and time: the current export (it has a
    ``received_date``) before the legacy one, then by every other column, so a run picks what the last one picked."""
    _, key, order = model.merge
    return [("received_date", "desc"), *((n, "asc") for n in model.names if n not in (key, order, "received_date"))]


def stage_accounts(df: DataFrame) -> DataFrame:
    """The newest version of every account, renamed, in local time; of versions
    of one instant, the first by the other columns."""
    other = [(c, "asc") for c in ("created_at", "name", "type", "user_id")]
    return stage_model(ops.latest_per_key(df, ["id"], "updated_at", other), MODELS["accounts"])


# ------------------------------------------------------------ driver queries
_TIMES = ("timestamp", "received_at", "created_at", "updated_at")


def _export_sql(model: Model, shift: str = "", legacy: bool = False) -> str:
    """A source table of the model's columns, derived from ``events``; it runs
    on Spark and DuckDB alike."""
    cols = []
    for i, name in enumerate(model.names):
        source = model.source.get(name, name)
        if legacy and source == "received_date":
            continue
        if source == "id":
            value = "event_id + 300 * (event_id % 2)" if legacy else "event_id"
        elif source in _TIMES:
            value = shift.format("ts") if shift else "ts"
        elif name in model.casts:
            value = f"value / {i + 1}" if model.casts[name] == "float" else f"event_id + {i}"
        else:
            value = f"concat('{name}-', CAST(event_id % {i + 7} AS VARCHAR(20)))"
            if legacy:
                value = f"CASE WHEN event_id % 8 = 0 THEN concat('old ', {value}) ELSE {value} END"
        cols.append(f'{value} AS {source}')
    return f"SELECT {', '.join(cols)} FROM events"


def _frame(spark: SparkSession, sf: str, sql: str) -> DataFrame:
    return spark.sql(sql.replace("FROM events", "FROM {events}"), events=Tables(spark, sf).events)


def _oracle(name: str, model: Model) -> str:
    types = {"float": "FLOAT", "string": "VARCHAR"}

    def select(source: str, legacy: bool) -> str:
        cols = []
        for n in model.names:
            c = f'"{model.source.get(n, n)}"'
            if n in model.local:
                c = f"CAST(({c} AT TIME ZONE 'UTC') AT TIME ZONE 'America/Sao_Paulo' AS TIMESTAMP)"
            if n in model.casts:
                c = f"CAST({c} AS {types[model.casts[n]]})"
            cols.append(f'{"NULL" if legacy and n == "received_date" else c} AS "{n}"')
        return f"SELECT {', '.join(cols)} FROM ({source})"

    new = select(_export_sql(model), False)
    if not model.merge:
        return new
    how, key, order = model.merge
    old = select(_export_sql(model, _SHIFT, True), True)
    if how == "primary":
        return f'{new} UNION ALL SELECT * FROM ({old}) o WHERE NOT EXISTS (FROM ({new}) n WHERE n."{key}" = o."{key}")'
    rest = ", ".join(f'"{n}" ASC NULLS FIRST' for n in model.names if n not in (key, order, "received_date"))
    place = (f'row_number() OVER (PARTITION BY "{key}" ORDER BY "{order}" DESC NULLS LAST, received_date DESC NULLS LAST, '
             f'{rest})')
    both = f"({new} UNION ALL {old})"
    if how == "latest":
        return f"SELECT * FROM {both} QUALIFY {place} = 1"
    return f"SELECT *, CAST({place} AS INTEGER) AS rn FROM {both}"


# The legacy export: three of four events an hour earlier, the others at the same time as
# in the current one; every other event under an id of its own.
_SHIFT = "CASE WHEN event_id % 4 = 0 THEN {0} ELSE {0} - INTERVAL '1' HOUR END"

REGISTRY: dict[str, object] = {}
ORACLE: dict[str, str] = {}


def _register(name: str, model: Model) -> None:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        new = _frame(spark, sf, _export_sql(model))
        if not model.merge:
            return stage_model(new, model)
        return stage_both(new, _frame(spark, sf, _export_sql(model, _SHIFT, True)), model)

    REGISTRY[f"stg_{name}"] = query
    ORACLE[f"stg_{name}"] = _oracle(name, model)


for _name, _model in MODELS.items():
    if _name != "accounts":
        _register(_name, _model)

_ACCOUNTS = """SELECT event_id % 997 AS id, ts AS created_at, CAST(concat('2024-01-01 00:', lpad(CAST(
  CAST(floor(event_id / 997) AS INT) % 3 AS VARCHAR(9)), 2, '0'), ':00') AS TIMESTAMP) AS updated_at,
  event_type AS name, props AS type, user_id FROM events"""


def stg_accounts(spark: SparkSession, sf: str) -> DataFrame:
    return stage_accounts(_frame(spark, sf, _ACCOUNTS))


_LOCAL = "(({} AT TIME ZONE 'UTC') AT TIME ZONE 'America/Sao_Paulo')"
REGISTRY["stg_accounts"] = stg_accounts
ORACLE["stg_accounts"] = f"""SELECT a.id AS account_id, CAST({_LOCAL.format('a.created_at')} AS TIMESTAMP) AS created_at,
  CAST({_LOCAL.format('a.updated_at')} AS TIMESTAMP) AS updated_at, a.name, a.type, a.user_id
FROM ({_ACCOUNTS}) a QUALIFY row_number() OVER (PARTITION BY a.id ORDER BY a.updated_at DESC NULLS LAST,
  a.created_at NULLS FIRST, a.name NULLS FIRST, a.type NULLS FIRST, a.user_id NULLS FIRST) = 1"""


def account_checks(spark: SparkSession, sf: str) -> DataFrame:
    """The schema tests of the staged accounts: the id is there, once each."""
    return run_checks({"accounts": stg_accounts(spark, sf)},
                      {"accounts": {"not_null": ["account_id"], "unique": ["account_id"]}})


REGISTRY["account_checks"] = account_checks
ORACLE["account_checks"] = f"""SELECT 'accounts' AS table_name, 'account_id' AS column_name, test,
  CAST(if(test = 'unique', count(account_id) - count(DISTINCT account_id), count(*) - count(account_id)) AS BIGINT)
    AS failures
FROM ({ORACLE['stg_accounts']}) a, (VALUES ('not_null'), ('unique')) t(test) GROUP BY test"""

# the ads-cost chain: a wide sheet of text, numbers parsed, long, days before `as_of`
_FONTS = ("alpha", "beta", "gamma", "delta")
_SHEET = f"""SELECT CAST(CAST(l_shipdate AS DATE) AS VARCHAR(10)) AS _, 'raw' AS _airbyte_raw_id,
  {', '.join(f"CASE WHEN l_linenumber % 4 = {i} THEN concat(CAST(l_quantity AS VARCHAR(20)), ',5') WHEN l_linenumber = 5 THEN 'n/a' END AS {f}" for i, f in enumerate(_FONTS))}
FROM lineitem"""


def ads_cost_chain(spark: SparkSession, sf: str) -> DataFrame:
    """R2 -> R1 -> M25."""
    sheet = spark.sql(_SHEET.replace("CAST(l_quantity AS VARCHAR(20))", "CAST(CAST(l_quantity AS INT) AS VARCHAR(20))")
                      .replace("FROM lineitem", "FROM {lineitem}"), lineitem=Tables(spark, sf).lineitem)
    return marts.ads_cost_series(unpivot_measures(parse_measure_columns(sheet), "reference_date"), AS_OF)


REGISTRY["ads_cost_chain"] = ads_cost_chain
ORACLE["ads_cost_chain"] = f"""
SELECT CAST(l_shipdate AS DATE) AS reference_date, f.font,
  CASE WHEN l_linenumber % 4 = f.place THEN CAST(CAST(l_quantity AS INT) AS DOUBLE) + 0.5 END AS cost
FROM lineitem, (VALUES {', '.join(f"('{f}', {i})" for i, f in enumerate(_FONTS))}) f(font, place)
WHERE CAST(l_shipdate AS DATE) < DATE '{AS_OF}'"""
