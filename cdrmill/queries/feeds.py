"""Telecom feeds and dimensions derived from the star-schema tables.

Plain SQL that Spark and DuckDB read alike. Customers are subscribers, parts
products, suppliers cells, orders payments, line items usage and events
recharges; gaps, blanks, sentinels and copies come from the tables' own
attributes, so every feed grows with its table.
"""

from __future__ import annotations

from ..schemas import (
    ACCOUNTING_PRODUCTS,
    DAILY_LOCATION,
    HISTORY_MM,
    HISTORY_MTD,
    LOCATION_MASTER,
    LOCATION_STATE,
    MERGED_REVENUE,
    ORDER_FEED,
    PAYMENT_FEED,
    PHONE_PREFIXES,
    PRODUCT_LINES,
    PRODUCTS,
    RECHARGE_FEED,
    RECHARGE_HOURLY,
    SUBSCRIBERS,
    USAGE_FEED,
)


def _phone(key: str) -> str:
    return f"'628' || reverse(lpad(cast({key} AS string), 8, '0'))"


def _text(value: str) -> str:
    return f"cast({value} AS string)"


def _money(value: str) -> str:
    return f"cast(cast({value} AS decimal(18,2)) AS string)"


def _digits(ts: str) -> str:
    """Timestamp as yyyyMMddHHmmss."""
    return (
        f"replace(replace(replace(substr(cast({ts} AS string), 1, 19), '-', ''), ':', ''), ' ', '')"
    )


def _select(schema: tuple[str, ...], values: dict[str, str], source: str, extra: tuple[str, ...] = ()) -> str:
    """All columns of a schema, null unless given."""
    unknown = set(values) - set(schema) - set(extra)
    if unknown:
        raise ValueError(f"not in the schema: {sorted(unknown)}")
    columns = [
        f"{values.get(name, 'cast(NULL AS string)')} AS {name}" for name in [*schema, *extra]
    ]
    return "SELECT " + ",\n  ".join(columns) + f"\n{source}"


_PLACE = {
    "provinsi": "n_name",
    "kabupaten": "n_name || '_KAB'",
    "kecamatan": "n_name || '_KEC'",
    "kelurahan": "n_name || '_KEL'",
    "branch": "'BR_' || n_name",
    "subbranch": "'SB_' || n_name",
    "cluster_sales": "'CL_' || r_name",
}
_GEO = "JOIN nation ON n_nationkey = {key} JOIN region ON r_regionkey = n_regionkey"

_subscriber = {
    "msisdn": _phone("c_custkey"),
    "subs_id": "'S' || cast(c_custkey AS string)",
    "cust_type_desc": "CASE c_mktsegment WHEN 'BUILDING' THEN NULL WHEN 'FURNITURE' THEN 'NQ' ELSE 'B2C' END",
    "cust_subtype_desc": "CASE WHEN c_acctbal < 0 THEN 'UNKNOWN' ELSE c_mktsegment END",
}
SUBSCRIBERS_SQL = (
    _select(SUBSCRIBERS, _subscriber, "FROM customer WHERE c_mktsegment <> 'MACHINERY'")
    + "\nUNION ALL\n"
    + _select(
        SUBSCRIBERS,
        {**_subscriber, "subs_id": "'T' || cast(c_custkey AS string)"},
        "FROM customer WHERE c_mktsegment = 'AUTOMOBILE' AND c_acctbal > 9000",
    )
)


def _history(schema: tuple[str, ...], subs: str, cell: str, floor: int) -> str:
    values = {
        subs: "'S' || cast(c_custkey AS string)",
        "msisdn": _phone("c_custkey"),
        "lacci_id": f"'{cell}' || cast(c_nationkey AS string)",
        "lacci_area_name": "CASE WHEN r_name = 'AFRICA' THEN 'UNKNOWN' ELSE r_name END",
        "lacci_region_network": "'NET_' || r_name",
        "lacci_region_sales": "CASE WHEN r_name = 'ASIA' THEN 'UNKNOWN' ELSE 'RS_' || r_name END",
        "lacci_lac": _text("10000 + c_nationkey"),
        "lacci_ci": "'C' || cast(c_custkey AS string)",
        "lacci_node": "CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN NULL ELSE '4G' END",
        **{f"lacci_{name}": sql for name, sql in _PLACE.items()},
    }
    return _select(
        schema, values, f"FROM customer {_GEO.format(key='c_nationkey')} WHERE c_acctbal >= {floor}"
    )


_cell_lac = "cast(10000 + s_nationkey AS string)"
_cell_ci = "cast(20000 + s_suppkey AS string)"
_cell_eci = "cast(3000000 + s_suppkey AS string)"
_cell_cgi = "'5101' || lpad(cast(s_suppkey AS string), 9, '0')"
LOCATIONS_SQL = _select(
    LOCATION_MASTER,
    {
        "lac": _cell_lac,
        "ci": _cell_ci,
        "lacci_id": f"{_cell_lac} || '|' || {_cell_ci}",
        "eci": f"{_cell_eci} || '|101'",
        "cgi_post": _cell_cgi,
        "node": "CASE WHEN s_acctbal < 3000 THEN '3G' ELSE '4G' END",
        "area_sales": "CASE WHEN s_acctbal < 500 THEN 'UNKNOWN' WHEN s_acctbal < 1500 THEN NULL ELSE r_name END",
        "region_sales": "CASE WHEN s_acctbal > 9000 THEN 'UNKNOWN' ELSE 'RS_' || r_name END",
        "file_id": "'F' || cast(s_suppkey AS string)",
        **_PLACE,
    },
    f"FROM supplier {_GEO.format(key='s_nationkey')}",
)

_product = {
    "rkey": "'P0' || cast(p_partkey AS string)",
    "mapping_key_type": "CASE p_type WHEN 'PROMO' THEN 'T' || cast(p_partkey AS string) WHEN 'SMALL' THEN '' ELSE NULL END",
    "service_type": "CASE WHEN p_size <= 20 THEN '1_' WHEN p_size <= 30 THEN '2_' WHEN p_size <= 40 THEN '3_' ELSE '5_' END",
    "product_name": "CASE WHEN p_retailprice > 1050 THEN p_name ELSE NULL END",
    "l1_name": "p_type",
    "l2_name": "p_brand",
    "l3_name": "CASE WHEN p_name LIKE 'red%' THEN 'NQ' ELSE p_name END",
    "l4_name": "CASE WHEN p_brand = 'Brand#5' THEN NULL ELSE 'L4_' || cast(p_partkey AS string) END",
    "price": _money("p_retailprice"),
}
PRODUCTS_SQL = (
    _select(PRODUCTS, _product, "FROM part")
    + "\nUNION ALL\n"
    + _select(
        PRODUCTS,
        {**_product, "l1_name": "'AGAIN_' || p_type"},
        "FROM part WHERE p_size > 45",
    )
    + "\nUNION ALL\n"
    + _select(
        PRODUCTS,
        {
            **_product,
            "rkey": "'2_' || p_brand",
            "service_type": "'2_'",
            "product_name": "cast(NULL AS string)",
        },
        "FROM part WHERE p_size = 1",
    )
)

PRODUCT_LINES_SQL = _select(
    PRODUCT_LINES,
    {
        "product_name": "p_name",
        "price": _money("p_retailprice"),
        "l1": "CASE p_type WHEN 'PROMO' THEN 'UNKNOWN' WHEN 'SMALL' THEN 'Digital Service' WHEN 'LARGE' THEN 'Voice P2P' ELSE p_type END",
        "l2": "CASE WHEN p_size <= 10 THEN 'UNKNOWN' WHEN p_size <= 20 THEN 'Other VAS Services' WHEN p_size <= 30 THEN 'SMS Non P to P' ELSE 'Internal MO Call' END",
        "l3": "CASE WHEN p_name LIKE 'hot%' THEN 'Local' WHEN p_name LIKE 'red%' THEN 'Volume Based' WHEN p_name LIKE 'old%' THEN 'Other VAS Services' ELSE p_name END",
        "l4": "' LN_' || cast(p_partkey AS string)",
        "note": "' ' || cast(p_partkey AS string) || ' '",
        "source": "CASE WHEN p_size <= 25 THEN 'payd' WHEN p_size <= 40 THEN 'PAYD' ELSE 'POST' END",
    },
    "FROM part",
)

ACCOUNTING_SQL = _select(
    ACCOUNTING_PRODUCTS,
    {
        "rkey": "'P0' || cast(p_partkey AS string)",
        "service_type": "CASE WHEN p_size <= 30 THEN '1_' ELSE '2_' END",
        "l1_payu": "p_type",
        "l2_service_type": "p_brand",
        "l3_allowance_type": "p_name",
        "l4_product_category": "CASE WHEN p_name LIKE 'hot%' THEN NULL ELSE 'CAT' END",
        "l5_product": "'L5_' || cast(p_partkey AS string)",
    },
    "FROM part",
)

# The cell an order was paid at: that of its first supplier.
_FIRST_LINE = (
    "(SELECT l_orderkey AS f_orderkey, min(l_suppkey) AS f_suppkey, min(l_partkey) AS f_partkey "
    "FROM lineitem GROUP BY l_orderkey)"
)
_PAYMENT_SOURCE = (
    f"FROM orders LEFT JOIN {_FIRST_LINE} AS first_line ON f_orderkey = o_orderkey "
    "LEFT JOIN supplier ON s_suppkey = f_suppkey"
)
_indicator_of_order = (
    "CASE o_orderpriority WHEN '1-URGENT' THEN '129' WHEN '2-HIGH' THEN '130' "
    "WHEN '3-MEDIUM' THEN '128' WHEN '4-NOT SPECIFIED' THEN '999' ELSE NULL END"
)
_part_offer = "'P0' || cast(f_partkey AS string)"
_payment = {
    "payment_timestamp": "substr(cast(o_orderdate AS string), 1, 10) || ' 13:' || substr(lpad(cast(o_orderkey AS string), 8, '0'), 1, 2) || ':30'",
    "msisdn": _phone("o_custkey"),
    "bss_order_id": "'O' || cast(o_orderkey AS string)",
    "plan_id": f"CASE WHEN o_totalprice > 420000 THEN 'SA10359' WHEN o_orderstatus = 'F' THEN NULL ELSE {_part_offer} END",
    "plan_name": "o_orderstatus",
    "topping_id": "CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE 'T' || cast(f_partkey AS string) END",
    "plan_price": f"CASE WHEN o_totalprice < 30000 THEN 'NQ' WHEN o_totalprice < 60000 THEN NULL ELSE {_money('o_totalprice')} END",
    "payment_channel": "o_orderpriority",
    "cell_id": (
        "CASE WHEN o_totalprice > 400000 THEN NULL WHEN o_totalprice > 380000 THEN '51' "
        f"WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN '510100000' || {_cell_eci} || '101' "
        f"WHEN o_orderpriority = '3-MEDIUM' THEN {_cell_cgi} "
        f"ELSE '5101' || {_cell_lac} || '0' || {_cell_ci} END"
    ),
    "indicator_4g": _indicator_of_order,
    "future_string_1": _part_offer,
}
PAYMENTS_SQL = _select(PAYMENT_FEED, {**_payment, "bundling_id": "o_orderstatus"}, _PAYMENT_SOURCE)
_ACTIVATION_FEED = ("activation_timestamp", *PAYMENT_FEED, "future_string_4")
ACTIVATIONS_SQL = _select(
    _ACTIVATION_FEED,
    {
        **_payment,
        "activation_timestamp": _payment["payment_timestamp"],
        "future_string_4": "o_orderstatus",
    },
    _PAYMENT_SOURCE,
)

ORDERS_SQL = _select(
    ORDER_FEED,
    {
        "timestamp_r": _digits("o_orderdate"),
        "user_name": "'U' || cast(o_custkey AS string)",
        "msisdn": _phone("o_custkey"),
        "order_id": "cast(o_orderkey AS string)",
        "main_plan_id": f"CASE WHEN o_orderstatus = 'F' THEN NULL ELSE {_part_offer} END",
        "topping_plan_id": f"CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE {_part_offer} END",
        "price": _money("o_totalprice"),
        "payment_channel": "o_orderpriority",
    },
    f"FROM orders LEFT JOIN {_FIRST_LINE} AS first_line ON f_orderkey = o_orderkey",
)

# A subscriber's usual cell is one of the nation's: the lowest, or the highest
# (some subscribers have both in a month).
_NATION_CELLS = (
    "(SELECT s_nationkey, min(s_suppkey) AS low, max(s_suppkey) AS high "
    "FROM supplier GROUP BY s_nationkey) AS cells ON s_nationkey = c_nationkey"
)


def _usual_cell(month: str, cell: str, test: str) -> str:
    return (
        f"SELECT 'S' || cast(c_custkey AS string) AS subs_id_{month}, "
        f"cast(10000 + s_nationkey AS string) || '|' || cast(20000 + {cell} AS string) "
        f"AS lacci_id_{month} FROM customer JOIN {_NATION_CELLS} WHERE {test}"
    )


_MTD_NARROW = (
    _usual_cell("mtd", "low", "c_acctbal >= 6000")
    + " UNION ALL "
    + _usual_cell("mtd", "high", "c_acctbal >= 6000 AND c_mktsegment = 'BUILDING'")
)
_MM_NARROW = _usual_cell("mm", "high", "c_acctbal >= 2000")

_USAGE_SOURCE = (
    "FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN supplier ON s_suppkey = l_suppkey"
)
_usage_indicator = (
    "CASE WHEN l_quantity <= 10 THEN '129' WHEN l_quantity <= 20 THEN '130' "
    "WHEN l_quantity <= 30 THEN '128' ELSE NULL END"
)
_usage_cell = (
    "CASE WHEN l_discount >= 0.1 THEN NULL WHEN l_discount >= 0.09 THEN ' ' "
    f"WHEN l_quantity <= 20 THEN ' 51010' || {_cell_lac} || {_cell_eci} || '101' "
    f"ELSE '51010' || {_cell_lac} || {_cell_ci} || '00' END"
)
_line_service = (
    "CASE l_returnflag || l_linestatus WHEN 'AF' THEN '1_VOICE' WHEN 'RF' THEN '1_GPRS' "
    "WHEN 'AO' THEN '2_Brand#' || cast(l_linenumber AS string) "
    "WHEN 'NO' THEN '3_Brand#' || cast(l_linenumber AS string) "
    "WHEN 'NF' THEN '5_VAS' ELSE NULL END"
)
_line_part = "'P0' || cast(l_partkey AS string)"
_bad_line = "l_tax >= 0.08 AND l_quantity >= 49"
USAGE_SQL = _select(
    USAGE_FEED,
    {
        "timestamp": f"CASE WHEN {_bad_line} THEN NULL WHEN l_linenumber = 7 THEN 'malformed' ELSE {_digits('o_orderdate')} END",
        "a_party": f"CASE WHEN {_bad_line} THEN NULL ELSE {_phone('o_custkey')} END",
        "b_party": f"CASE WHEN l_linenumber = 1 THEN '' WHEN l_linenumber >= 5 THEN {_line_part} ELSE 'B' || cast(l_linenumber AS string) END",
        "callduration": "CASE WHEN l_linenumber = 2 THEN ' ' ELSE cast(l_linenumber * 60 AS string) END",
        "chargingid": "CASE WHEN l_linenumber = 3 THEN NULL ELSE 'CH' || cast(l_orderkey AS string) END",
        "roamingflag": "CASE WHEN l_returnflag = 'R' THEN 'Y' ELSE 'N' END",
        "cell_id": _usage_cell,
        "event_type": "CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'GPRS' ELSE 'CALL' END",
        "account_balance": _money("o_totalprice"),
        "account_delta": f"CASE WHEN {_bad_line} THEN NULL WHEN l_linenumber = 4 THEN NULL ELSE ' ' || cast(l_linenumber AS string) || '.25 ' END",
        "account_owner": "o_orderstatus",
        "total_volume": "cast(l_linenumber * 1024 AS string)",
        "charge_including_free_allowance": "CASE WHEN l_linenumber = 5 THEN '  ' ELSE 'A' END",
        "bonus_consumed": f"CASE WHEN l_linenumber = 6 THEN {_line_part} WHEN l_linenumber >= 3 THEN {_line_part} || '#1' ELSE 'P01#9' END",
        "vas_code": _line_part,
        "service_filter": _line_service,
        "credit_indicator": "CASE WHEN l_returnflag = 'A' THEN 'C' ELSE 'D' END",
        "event_id": "cast(l_linenumber AS string)",
        "mcc_mnc": "'51010' || cast(l_linenumber AS string) || 'xx'",
        "future_string3": _usage_indicator,
        "cost_band": "l_linestatus",
        "rec_id": "l_orderkey * 10000000 + l_partkey * 10 + l_linenumber",
    },
    _USAGE_SOURCE,
    ("rec_id",),
)

_rcg_indicator = (
    "CASE WHEN value < 5 THEN '129' WHEN value < 10 THEN '130' WHEN value < 15 THEN '128' "
    "WHEN value < 20 THEN ' 131' WHEN value < 30 THEN '131' ELSE NULL END"
)
_bad_event = "value < 0.5"
RECHARGES_SQL = _select(
    RECHARGE_FEED,
    {
        "timestamp": f"CASE WHEN {_bad_event} THEN NULL WHEN value < 1 THEN '2024' ELSE substr({_digits('ts')}, 1, 8) || '060000' END",
        "msisdn": f"CASE WHEN {_bad_event} THEN NULL ELSE {_phone('user_id')} END",
        "account": "'ACC'",
        "expiration_date": f"CASE WHEN value < 8 THEN NULL ELSE {_digits('ts')} END",
        "delta_balance": f"CASE WHEN {_bad_event} THEN NULL WHEN value < 40 THEN '20' ELSE '50' END",
        "credit_indicator": "CASE WHEN value < 60 THEN 'd' ELSE 'C' END",
        "recharge_method": "CASE event_type WHEN 'click' THEN 'btsource' WHEN 'error' THEN 'OTHER' WHEN 'view' THEN 'tpfee' ELSE 'TPFEE' END",
        "recharge_id": "'R' || cast(event_id AS string)",
        "provider_id": "'P0' || cast(user_id AS string)",
        "a_number_location": (
            f"CASE WHEN value < 10 THEN '51010' || {_cell_lac} || {_cell_eci} || '101' "
            f"WHEN value < 30 THEN {_cell_cgi} ELSE '51010' || {_cell_lac} || {_cell_ci} || '00' END"
        ),
        "recharge_amount": f"CASE WHEN value < 2 THEN NULL ELSE {_money('value')} END",
        "indicator_4g": _rcg_indicator,
        "rec_id": "event_id",
    },
    "FROM events LEFT JOIN supplier ON s_suppkey = user_id",
    ("rec_id",),
)

RECHARGE_HOURLY_SQL = _select(
    RECHARGE_HOURLY,
    {
        "trx_date": "substr(cast(ts AS string), 1, 10)",
        "trx_hour": "substr(cast(ts AS string), 12, 2)",
        "msisdn": _phone("user_id"),
        "subs_id": "'S' || cast(user_id AS string)",
        "provider_id": "event_type",
        "lac": _cell_lac,
        "ci": _cell_ci,
        "credit_indicator": "CASE WHEN value < 10 THEN 'D' ELSE 'C' END",
        "recharge_amount": f"CASE WHEN value < 2 THEN NULL ELSE {_money('value')} END",
        "brand": "'byU'",
        "load_ts": "substr(cast(ts AS string), 1, 7)",
    },
    "FROM events LEFT JOIN supplier ON s_suppkey = user_id",
)

PREFIXES_SQL = _select(
    PHONE_PREFIXES,
    {
        "enriched_prefix": f"substr({_phone('c_custkey')}, 1, 8)",
        "regional": "CASE WHEN c_acctbal > 9000 THEN NULL ELSE CASE n_regionkey WHEN 0 THEN 'Bali-Nusra' WHEN 1 THEN 'PUMA' WHEN 2 THEN 'Jawa-Timur' WHEN 3 THEN 'NQ' ELSE n_name END END",
        "area": "r_name",
        "area_name": "CASE WHEN c_acctbal > 8000 THEN 'NQ' WHEN c_acctbal > 7000 THEN NULL ELSE 'AREA_' || r_name END",
    },
    f"FROM customer {_GEO.format(key='c_nationkey')} WHERE c_acctbal >= 1000",
)

REVENUE_SQL = _select(
    MERGED_REVENUE,
    {
        "trx_date": f"substr({_digits('o_orderdate')}, 1, 8)",
        "msisdn": _phone("o_custkey"),
        "region_sales": "o_orderpriority",
        "cluster_sales": "l_linestatus",
        "l1_name": "l_returnflag",
        "l2_name": "l_linestatus",
        "l3_name": "o_orderstatus",
        "offer_name": "CASE WHEN l_linenumber = 3 THEN NULL ELSE 'OFFER_' || cast(l_linenumber AS string) END",
        "brand": "'byU'",
        "cust_type_desc": "'B2C'",
        "cust_subtype_desc": "CASE WHEN l_quantity <= 25 THEN 'UNKNOWN' ELSE 'RETAIL' END",
        "trx": "'1'",
        "rev": _money("l_extendedprice"),
        "dur": "CASE WHEN l_linenumber = 2 THEN NULL ELSE cast(l_linenumber * 10 AS string) END",
        "vol": "CASE WHEN l_linenumber = 4 THEN NULL ELSE cast(cast(l_quantity AS bigint) AS string) END",
        "source_name": "CASE WHEN l_tax >= 0.05 THEN 'CHG_GOOD' ELSE 'CHG_REJECT' END",
    },
    "FROM lineitem JOIN orders ON o_orderkey = l_orderkey",
)

_STATE_NAMES = (
    "lacci_id", "area_name", "region_network", "cluster_sales", "site_id", "node", "provinsi",
    "kabupaten", "kecamatan", "kelurahan", "region_sales", "branch", "subbranch",
)
STATE_SQL = _select(
    LOCATION_STATE,
    {
        "msisdn": _phone("c_custkey"),
        "subs_id": "'S' || cast(c_custkey AS string)",
        **{
            f"{block}_{name}": f"'{block}_{name}_' || n_name"
            for block in ("chg", "usg", "ifrs")
            for name in _STATE_NAMES
        },
        "chg_flag": "CASE WHEN c_acctbal > 9000 THEN NULL ELSE '1' END",
        "usg_flag": "CASE WHEN c_acctbal > 8000 THEN NULL ELSE '2' END",
        "ifrs_flag": "CASE WHEN c_acctbal > 7000 THEN NULL ELSE '3' END",
        "event_date": "'20230119'",
    },
    "FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE c_acctbal >= 2000",
)
DAILY_SQL = _select(
    DAILY_LOCATION,
    {
        "subs_id": "CASE WHEN o_custkey < 3 THEN NULL ELSE 'S' || cast(o_custkey AS string) END",
        "msisdn": _phone("o_custkey"),
        "lacci_id": "'day_' || cast(last_order AS string)",
        "rev": _money("day_total"),
        **{f"lacci_{name}": f"'day_{name}'" for name in _STATE_NAMES if name != "lacci_id"},
    },
    "FROM (SELECT o_custkey, max(o_orderkey) AS last_order, sum(cast(o_totalprice AS decimal(18,2))) AS day_total "
    "FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderdate >= timestamp '1999-01-01 00:00:00' "
    "GROUP BY o_custkey) AS day_orders",
)

FEEDS = {
    "subscribers": SUBSCRIBERS_SQL,
    "history_mtd": _history(HISTORY_MTD, "subs_id_mtd", "MTD", 5000),
    "history_mm": _history(HISTORY_MM, "subs_id_mm", "MM", 2000),
    "payment_mtd": _MTD_NARROW,
    "payment_mm": _MM_NARROW,
    "locations": LOCATIONS_SQL,
    "products": PRODUCTS_SQL,
    "product_lines": PRODUCT_LINES_SQL,
    "accounting": ACCOUNTING_SQL,
    "payments": PAYMENTS_SQL,
    "activations": ACTIVATIONS_SQL,
    "order_feed": ORDERS_SQL,
    "usage_feed": USAGE_SQL,
    "recharges": RECHARGES_SQL,
    "recharge_hourly": RECHARGE_HOURLY_SQL,
    "prefixes": PREFIXES_SQL,
    "revenue": REVENUE_SQL,
    "state": STATE_SQL,
    "daily": DAILY_SQL,
}
