"""Column lists of the feeds, dimensions and outputs.

Fixed values: names and order are those of the data itself. Every feed column
is text; positions matter for the delimited feeds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import types as T


def _names(text: str) -> tuple[str, ...]:
    return tuple(text.split())


def text_schema(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


PAYMENT_FEED = _names(
    """
    payment_timestamp msisdn bss_order_id plan_id plan_name topping_id topping_name plan_price
    payment_channel cell_id indicator_4g future_string_1 future_string_2 future_string_3
    bundling_id future_string_5 future_string_6 future_string_7 future_string_8 future_string_9
    future_string_10
    """
)
ORDER_FEED = _names(
    """
    timestamp_r user_name msisdn order_id main_plan_name main_plan_id topping_plan_name
    topping_plan_id price payment_channel
    """
)
USAGE_FEED = _names(
    """
    timestamp a_party locationnumbertypea location_number_a b_party locationnumbertypeb
    location_number_b nrofreroutings imsi nrofnetworkreroutings redirectingpartyid
    precallduration callduration chargingid roamingflag vlr_num cell_id negotiated_qos
    requested_qos subscribed_qos dialled_apn event_type provider_id currency subscriber_status
    forwarding_flag first_call_flag camel_roaming time_zone account_balance account_delta
    account_number account_owner event_source guiding_resource_type rounded_duration
    total_volume rounded_total_volume event_start_period charge_including_free_allowance
    discount_amount free_total_volume free_duration call_direction charge_code
    special_number_ind bonus_information internalcause basiccause time_band call_type
    bonus_consumed vas_code service_filter national_calling_zone national_called_zone
    international_calling_zone international_called_zone credit_indicator event_id access_code
    country_name cp_name content_id rating_group bft_indicator unapplied_amount partition_id
    rateddatetime area cost_band rating_offer_id settlement_indicator tap_code mcc_mnc
    rating_pricing_item_id file_identifier record_number future_string1 future_string2
    future_string3 allowance_consumed_revenue ifrs_ind_for_allowance_revenue
    ifrs_ind_for_vas_event itemized_bill_fee consumed_monetary_allowance partial_charge_ind
    """
)
RECHARGE_FEED = _names(
    """
    timestamp msisdn account recharge_channel expiration_date serial_number delta_balance
    balance_amount credit_indicator recharge_method recharge_id bonus_information provider_id
    source_ip user_id result_code bank_code a_number_location balance_before adjustment_reason
    case_id crmuser_id old_expiration_date split_code recharge_amount future_string_2
    future_string_3 future_string_1 indicator_4g
    """
)
RECHARGE_HOURLY = _names(
    """
    timestamp_r trx_hour trx_date msisdn subs_id cust_type_desc cust_subtype_desc account
    recharge_channel expiration_date serial_number delta_balance balance_amount credit_indicator
    recharge_method recharge_id bonus_information provider_id source_ip user_id result_code
    bank_code a_number_location lacci_id lacci_closing_flag lac ci node_type area_sales
    region_sales branch subbranch cluster_sales provinsi kabupaten kecamatan kelurahan
    indicator_4g balance_before adjustment_reason case_id crmuser_id old_expiration_date
    split_code recharge_amount future_string_1 future_string_2 future_string_3 brand file_id
    load_ts load_user site_name event_date filename rec_id retry_count retry_ts
    """
)
SUBSCRIBERS = _names(
    """
    trx_date subs_id msisdn account_id status pre_post_flag activation_date deactivation_date
    los price_plan_id prefix area_hlr region_hlr city_hlr cust_type_desc cust_subtype_desc
    customer_sub_segment load_ts load_user job_id migration_date
    """
)
PAYMENT_MTD = _names(
    """
    trx_date subs_id_mtd lacci_id_mtd msisdn cust_type_desc cust_subtype_desc area_sales
    region_sales branch subbranch cluster_sales provinsi kabupaten kecamatan kelurahan node_type
    vol trx dur load_ts load_user job_id
    """
)
PAYMENT_MM = tuple(name.replace("_mtd", "_mm") for name in PAYMENT_MTD)
HISTORY_MTD = _names(
    """
    trx_date subs_id_mtd lacci_id msisdn cust_type_desc cust_subtype_desc area_sales
    region_sales branch subbranch cluster_sales provinsi kabupaten kecamatan kelurahan node_type
    trx dur load_ts load_user event_date job_id lacci_area_name lacci_region_network
    lacci_cluster_sales lacci_lac lacci_ci lacci_node lacci_region_sales lacci_branch
    lacci_subbranch lacci_provinsi lacci_kabupaten lacci_kecamatan lacci_kelurahan
    """
)
HISTORY_MM = tuple(name.replace("_mtd", "_mm") for name in HISTORY_MTD)
LOCATION_NARROW = _names(
    """
    lacci_id eci cgi_post area_sales lac ci node region_sales branch subbranch cluster_sales
    provinsi kabupaten kecamatan kelurahan
    """
)
LOCATION_MASTER = _names(
    """
    lac ci cell_name vendor site_id ne_id site_name msc_name node longitude latitude
    region_network provinsi kabupaten kecamatan kelurahan region_sales branch subbranch address
    cluster_sales mitra_ad cgi_pre cgi_post ocs_cluster ocs_zone area_sales eci lacci_id
    file_date file_id load_ts load_user event_date
    """
)
PRODUCTS = _names(
    """
    trx_date rkey mapping_key_type service_type l1_name l2_name l3_name l4_name price
    updated_date product_name plan_type plan_service quota_value quota_unit validity_value
    validity_unit vascode_type file_id load_ts load_user
    """
)
PRODUCT_LINES = _names(
    """
    product_name price l1 l2 l3 l4 note source
    """
)
ACCOUNTING_PRODUCTS = _names(
    """
    trx_date rkey mapping_key_type service_type l1_payu l2_service_type l3_allowance_type
    l4_product_category l5_product price updated_date product_name plan_type plan_service
    quota_value quota_unit validity_value validity_unit vascode_type file_id load_ts load_user
    """
)
PHONE_PREFIXES = _names(
    """
    regional area prefix enriched_prefix area_name region_id area_code regional_code file_id
    load_user
    """
)
MERGED_REVENUE = _names(
    """
    trx_date msisdn subs_id lacci_id node_type area_sales region_sales branch subbranch
    cluster_sales provinsi kabupaten kecamatan kelurahan indicator_4g lacci_closing_flag
    mm_closing_flag l1_name l2_name l3_name l4_name offer_id offer_name brand cust_type_desc
    cust_subtype_desc service_filter payment_channel trx rev dur vol source_name load_ts
    """
)
LOCATION_STATE = _names(
    """
    msisdn subs_id chg_lacci_id chg_area_name chg_region_network chg_cluster_sales chg_site_id
    chg_node chg_provinsi chg_kabupaten chg_kecamatan chg_kelurahan chg_region_sales chg_branch
    chg_subbranch chg_flag usg_lacci_id usg_area_name usg_region_network usg_cluster_sales
    usg_site_id usg_node usg_provinsi usg_kabupaten usg_kecamatan usg_kelurahan usg_region_sales
    usg_branch usg_subbranch usg_flag ifrs_lacci_id ifrs_area_name ifrs_region_network
    ifrs_cluster_sales ifrs_site_id ifrs_node ifrs_provinsi ifrs_kabupaten ifrs_kecamatan
    ifrs_kelurahan ifrs_region_sales ifrs_branch ifrs_subbranch ifrs_flag event_date job_id
    """
)
DAILY_LOCATION = _names(
    """
    trx_date subs_id lacci_id msisdn brand cust_type_desc cust_subtype_desc area_sales
    region_sales branch subbranch cluster_sales provinsi kabupaten kecamatan kelurahan node_type
    rev trx load_ts load_user site_id lacci_area_name lacci_region_network lacci_cluster_sales
    lacci_lac lacci_ci lacci_site_id lacci_node lacci_provinsi lacci_kabupaten lacci_kecamatan
    lacci_kelurahan lacci_region_sales lacci_branch lacci_subbranch
    """
)
PAYMENT_STAGED = _names(
    """
    payment_timestamp trx_date trx_hour msisdn bss_order_id plan_id plan_name topping_id
    topping_name plan_price offer_id payment_channel cell_id indicator_4g future_string_1
    future_string_2 future_string_3 brand site_name pre_post_flag event_date bundling_id
    future_string_5 future_string_6 future_string_7 future_string_8 future_string_9
    future_string_10 filename trx_lacci retry_count subs_id cust_type_desc cust_subtype_desc
    """
)
ACTIVATION_STAGED = _names(
    """
    activation_timestamp trx_date trx_hour msisdn bss_order_id plan_id plan_name topping_id
    topping_name plan_price payment_timestamp offer_id payment_channel cell_id indicator_4g
    future_string_1 future_string_2 future_string_3 brand site_name pre_post_flag event_date
    future_string_4 future_string_5 future_string_6 future_string_7 future_string_8
    future_string_9 future_string_10 filename trx_lacci subs_id cust_type_desc cust_subtype_desc
    retry_count
    """
)
USAGE_STAGED = _names(
    """
    timestamp_r trx_date trx_hour a_party account_owner msisdn subs_id cust_type_desc
    cust_subtype_desc location_number_type_a location_number_a b_party location_number_type_b
    location_number_b number_of_reroutings imsi number_of_network_reroutings
    redirecting_party_id pre_call_duration call_duration chargingid roaming_flag vlr_num cell_id
    lacci_id lacci_closing_flag lac ci node_type area_sales region_sales branch subbranch
    cluster_sales provinsi kabupaten kecamatan kelurahan negotiated_qos requested_qos
    subscribed_qos dialled_apn event_type provider_id currency subscriber_status forwarding_flag
    first_call_flag camel_roaming time_zone account_balance account_number event_source
    guiding_resource_type rounded_duration total_volume rounded_total_volume event_start_period
    cifa account_delta bonus_consumed credit_indicator rev discount_amount free_total_volume
    free_duration call_direction charge_code special_number_ind bonus_information internal_cause
    basic_cause time_band call_type vas_code service_filter national_calling_zone
    national_called_zone international_calling_zone international_called_zone event_id
    access_code country_name cp_name content_id rating_group bft_indicator unapplied_amount
    partition_id rated_date_time area cost_band rating_offer_id settlement_indicator tap_code
    mcc_mnc rating_pricing_item_id file_identifier record_number future_string1 future_string2
    future_string3 allowance_consumed_revenue ifrs_ind_for_allowance_revenue
    ifrs_ind_for_vas_event itemized_bill_fee consumed_monetary_allowance partial_charge_ind
    brand offer_id file_id load_ts load_user site_name pre_post_flag mcc mnc network_activity_id
    filename rec_id event_date productline_bonus_l4 retry_count retry_ts status_data status
    trx_lacci
    """
)
PAYMENT_GOOD = _names(
    """
    payment_timestamp trx_date trx_hour msisdn subs_id cust_type_desc cust_subtype_desc
    bss_order_id plan_id plan_name topping_id topping_name plan_price offer_id l4_name l3_name
    l2_name l1_name payment_channel cell_id lacci_id lacci_closing_flag lac ci node_type
    area_name region_sales branch subbranch cluster_sales provinsi kabupaten kecamatan kelurahan
    indicator_4g future_string_1 future_string_2 future_string_3 brand site_name file_id load_ts
    load_user pre_post_flag event_date bundling_id future_string_5 future_string_6
    future_string_7 future_string_8 future_string_9 future_string_10
    """
)
ORDER_OUT = _names(
    """
    timestamp_r trx_date trx_hour user_name msisdn order_id main_plan_name main_plan_id
    topping_plan_name topping_plan_id price brand file_id load_ts load_user offer_id
    pre_post_flag l1_payu l2_service_type l3_allowance_type l4_product_category l5_product
    l1_name l2_name l3_name l4_name payment_channel
    """
)
RECHARGE_OUT = _names(
    """
    timestamp_r trx_hour trx_date msisdn subs_id cust_type_desc cust_subtype_desc account
    recharge_channel expiration_date serial_number delta_balance balance_amount credit_indicator
    recharge_method recharge_id bonus_information provider_id source_ip user_id result_code
    bank_code a_number_location lacci_id lacci_closing_flag lac ci node_type area_sales
    region_sales branch subbranch cluster_sales provinsi kabupaten kecamatan kelurahan
    indicator_4g balance_before adjustment_reason case_id crmuser_id old_expiration_date
    split_code recharge_amount future_string_1 future_string_2 future_string_3 brand file_id
    load_ts load_user site_name event_date filename rec_id retry_count retry_ts load_date
    p_event_date
    """
)


def _usage_out() -> tuple[str, ...]:
    """The staged columns with the taxonomy after the cost band and the record
    keys moved behind the event date."""
    at = USAGE_STAGED.index("cost_band") + 1
    end = USAGE_STAGED.index("filename")
    return (
        *USAGE_STAGED[:at],
        *_names("l4_name l3_name l2_name l1_name"),
        *USAGE_STAGED[at:end],
        *_names(
            "event_date productline_bonus_l4 filename rec_id retry_count retry_ts p_event_date load_date"
        ),
    )


USAGE_OUT = _usage_out()
