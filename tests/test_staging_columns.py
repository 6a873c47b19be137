"""Column lists of the staged tables, stated here apart from the models they check.

Fixed values: output columns in order. ``a<-b`` is a renamed column, ``a:type`` a cast one, ``a@`` one in local time.
"""

from __future__ import annotations

import pytest

from tidemark.plans.staging import MODELS

EXPECTED = {
    "usage": """account_id workspace_id record_id sku_name cloud usage_start_time usage_end_time usage_date custom_tags
        usage_unit usage_quantity usage_metadata identity_metadata record_type ingestion_date billing_origin_product
        product_features usage_type""",
    "list_prices": "account_id price_start_time price_end_time sku_name cloud currency_code usage_unit pricing",
    "accounts": "account_id<-id created_at@ updated_at@ name type user_id",
    "fb_ads": """ad_id<-id name status adlabels adset_id bid_info bid_type creative targeting account_id bid_amount
        campaign_id created_time updated_time source_ad_id tracking_specs recommendations conversion_specs effective_status
        last_updated_by_app_id""",
    "fb_ads_insights": """adset_id ad_id account_id campaign_id adset_name ad_name objective campaign_name date_start
        date_stop created_time updated_time cpc:float cpm:float cpp:float ctr:float reach spend:float clicks impressions
        unique_clicks conversions actions""",
    "fb_campaigns": """campaign_id<-id name status adlabels objective spend_cap stop_time account_id start_time buying_type
        issues_info bid_strategy created_time updated_time daily_budget lifetime_budget budget_remaining effective_status
        boosted_object_id configured_status source_campaign_id special_ad_category smart_promotion_type
        budget_rebalance_flag special_ad_category_country""",
    "pipe_ads": """ad_id<-id adset_id campaign_id name account_id received_at status url_parameters utm_medium uuid_ts
        bid_type received_date""",
    "pipe_campaigns": """campaign_id<-id name effective_status account_id received_at start_time uuid_ts buying_type
        received_date""",
    "pipe_insights": """insight_id<-id ad_id reach clicks impressions link_clicks unique_impressions unique_clicks spend
        social_spend inline_post_engagements frequency uuid_ts date_start date_stop received_at""",
    "google_campaigns": """campaign_id<-id:string adwords_customer_id serving_status status name start_date end_date
        received_at uuid_ts received_date""",
    # the 25 and the 50 per cent rate are two columns
    "google_reports": """campaign_performance_report_id<-id impressions clicks cost invalid_clicks engagements conversions
        video_views interactions active_view_measurability average_cost campaign_id:string campaign_status
        campaign_trial_type date_stop gmail_saves adwords_customer_id all_conversion_rate date_start
        active_view_impressions uuid_ts view_through_conversions base_campaign_id received_at video_quartile_25_rate
        video_quartile_50_rate video_quartile_75_rate video_quartile_100_rate conversion_value
        is_budget_explicitly_shared value_per_all_conversion active_view_measurable_impressions all_conversion_value amount
        bounce_rate budget_id interaction_types average_time_on_site gmail_secondary_clicks active_view_measurable_cost
        active_view_viewability advertising_channel_sub_type all_conversions gmail_forwards video_view_rate
        received_date""",
    "coupon_created": """id event_source_slug original_timestamp received_at segment_id user_id context_library_version
        coupon_amount_real event_source_name event_text gamemode timestamp@ _id coupon_amount event fraud_score
        is_first_coupon is_first_coupon_at_gamemode uuid_ts context_library_name coupon_id coupon_max_amount
        event_source_id received_date amount external_gamemode""",
    "deposit_confirmed": """id event event_text event_source_name context_library_version event_source_slug
        original_timestamp received_at uuid_ts timestamp@ received_date context_library_name event_source_id segment_id
        user_id email transaction_id payment_method value currency first_deposit bonus_received bonus_value coupon""",
    # the platform and the coupon are two columns
    "user_logged_in": """id event event_text event_source_name context_library_version event_source_slug
        original_timestamp received_at uuid_ts timestamp@ received_date context_library_name event_source_id segment_id
        user_id email name first_login platform coupon""",
    "first_login": """first_login_id<-id name original_timestamp platform sent_at email event_source_id event_source_slug
        received_at segment_id context_library_name context_library_version event uuid_ts timestamp user_id
        event_source_name event_text first_login received_date referrer_url source context_page_path context_page_title
        context_ip context_user_agent_data_platform context_user_agent_data_mobile medium context_user_agent
        context_user_agent_data_brands context_locale gaid anonymous_id context_page_url context_timezone""",
    "first_match_finished": """event first_match_finished_id<-id original_timestamp segment_id transaction_id
        context_library_name event_source_slug event_text timestamp@ uuid_ts coupon_did_win coupon_id event_source_id
        user_id context_library_version coupon_balance event_source_name gamemode sent_at received_at coupon_max_amount
        coupon_amount coupon_amount_real user_tip_score""",
    "mobile_attribution": """mobile_attribution_id<-id context_page_path medium source anonymous_id user_id
        context_user_agent_data_mobile context_page_title context_page_url event_source_id referrer_url segment_id
        timestamp uuid_ts context_library_name context_library_version email event context_ip context_timezone
        context_locale event_text context_user_agent context_user_agent_data_platform context_user_agent_data_brands
        event_source_slug received_at sent_at gaid original_timestamp event_source_name received_date""",
    "profile_merges": """profile_merge_id<-id received_at segment_id seq uuid_ts __profile_version canonical_segment_id
        received_date""",
    "user_traits": """user_trait_id<-id name received_at seq uuid_ts value __profile_version canonical_segment_id
        received_date""",
    "user_identifiers": """user_identifier_id<-id value profile_version<-__profile_version canonical_segment_id received_at
        seq type uuid_ts received_date""",
    "id_graph_updates": """id_graph_update_id<-id canonical_segment_id triggering_event_id triggering_event_source_name
        triggering_event_source_slug uuid_ts triggering_event_type received_at segment_id seq timestamp@
        triggering_event_name triggering_event_source_id received_date""",
    "pages": """page_id<-id event_source_id received_at context_campaign_source context_library_name context_page_path
        context_page_referrer context_user_agent url context_campaign_name context_library_version context_page_title
        context_user_agent_data_platform referrer segment_id context_page_search timestamp@ user_id
        context_user_agent_data_brands original_timestamp context_timezone path title anonymous_id
        context_campaign_content event_source_slug uuid_ts sent_at context_campaign_medium context_ip context_locale
        context_page_url context_user_agent_data_mobile event_source_name search received_date context_campaign_id
        context_campaign_term""",
    "user_attribution_gtm": """id event_source_name traits_phone context_user_agent_data_mobile event
        context_user_agent_data_brands context_user_agent_data_platform context_page_title traits_gclid event_source_id
        received_at segment_id traits_ip anonymous_id context_library_name original_timestamp timestamp@ context_ip
        event_source_slug traits_email traits_gbraid traits_ttclid traits_user_agent uuid_ts event_text sent_at
        context_page_referrer context_timezone context_user_agent traits_fbp traits_user_id context_locale
        context_page_path traits_wbraid user_id context_library_version context_page_url received_date
        context_campaign_content context_campaign_term context_page_search context_campaign_medium
        context_campaign_source context_campaign_name context_campaign_id traits_fbclid""",
}
MERGES = {"google_campaigns": ("primary", "campaign_id", None),
          "google_reports": ("primary", "campaign_performance_report_id", None),
          "id_graph_updates": ("latest", "id_graph_update_id", "timestamp"),
          "user_identifiers": ("latest", "user_identifier_id", "received_at"), "pages": ("ranked", "page_id", "timestamp")}


def test_every_model_is_stated():
    assert set(EXPECTED) == set(MODELS)


@pytest.mark.parametrize("name", sorted(EXPECTED))
def test_columns(name):
    model, names, source, casts, local = MODELS[name], [], {}, {}, []
    for entry in EXPECTED[name].split():
        entry, _, kind = entry.partition(":")
        entry, _, old = entry.partition("<-")
        column = entry.rstrip("@")
        names.append(column)
        if old:
            source[column] = old
        if kind:
            casts[column] = kind
        if entry.endswith("@"):
            local.append(column)
    assert len(names) == len(set(names))
    assert model.names == names
    assert (model.source, model.casts, list(model.local)) == (source, casts, local)
    assert model.merge == MERGES.get(name, ())
