"""Enrichment, location and product lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import before
from ..operators import enrich, locate, lookup, marts, product
from ..plans import payment
from ..plans.history import HISTORY_COLUMNS
from .base import Registry, Tables, with_feeds

registry = Registry()
query = registry.add

# One subscriber row per msisdn, the smallest by its columns in order.
ONE_SUBSCRIBER = """one_subscriber AS (SELECT msisdn, subs_id, cust_type_desc, cust_subtype_desc FROM
    (SELECT *, row_number() OVER (PARTITION BY msisdn ORDER BY subs_id NULLS LAST, cust_type_desc NULLS LAST,
    cust_subtype_desc NULLS LAST) AS rn FROM subscribers) AS numbered WHERE rn = 1)"""


@query(
    with_feeds(
        ["subscribers"],
        f"""{ONE_SUBSCRIBER}
        SELECT o.o_orderkey, coalesce(s.subs_id, '-99') AS subs_id, coalesce(s.cust_type_desc, 'UNKNOWN') AS cust_type_desc,
        coalesce(s.cust_subtype_desc, 'UNKNOWN') AS cust_subtype_desc FROM orders o LEFT JOIN one_subscriber s
        ON s.msisdn = '628' || reverse(lpad(cast(o.o_custkey AS string), 8, '0'))""",
    )
)
def subscriber_enrich(t: Tables) -> DataFrame:
    phone = F.concat(F.lit("628"), F.reverse(F.lpad(F.col("o_custkey").cast("string"), 8, "0")))
    return enrich.enrich_subscriber(
        t.orders.select("o_orderkey", phone.alias("msisdn")),
        t.feed("subscribers"),
        payment.SUBSCRIBER_DEFAULTS,
        null_attributes_too=True,
    ).drop("msisdn")


@query(
    with_feeds(
        ["subscribers"],
        """SELECT o.o_orderkey, CASE WHEN s.msisdn IS NULL THEN '-99' ELSE s.cust_type_desc END AS cust_type_desc,
        coalesce(s.subs_id, '-99') AS subs_id FROM orders o LEFT JOIN subscribers s
        ON s.msisdn = '628' || reverse(lpad(cast(o.o_custkey AS string), 8, '0'))""",
    )
)
def subscriber_fan_out(t: Tables) -> DataFrame:
    """Duplicate subscriber rows kept: they multiply the records."""
    phone = F.concat(F.lit("628"), F.reverse(F.lpad(F.col("o_custkey").cast("string"), 8, "0")))
    return enrich.enrich_subscriber(
        t.orders.select("o_orderkey", phone.alias("msisdn")),
        t.feed("subscribers"),
        {"subs_id": "-99", "cust_type_desc": "-99"},
        unique=False,
    ).drop("msisdn")


@query(
    with_feeds(
        ["history_mtd"],
        """SELECT o.o_orderkey, CASE WHEN h.msisdn IS NOT NULL THEN h.lacci_id ELSE '-99' END AS mtd_lacci_id,
        CASE WHEN h.msisdn IS NOT NULL THEN h.lacci_area_name ELSE 'UNKNOWN' END AS mtd_area_name,
        CASE WHEN h.msisdn IS NOT NULL THEN h.lacci_node ELSE '' END AS mtd_node,
        CASE WHEN h.msisdn IS NOT NULL THEN h.lacci_provinsi ELSE '-99' END AS mtd_provinsi,
        CASE WHEN h.msisdn IS NOT NULL THEN h.lacci_kelurahan ELSE '' END AS mtd_kelurahan,
        CASE WHEN h.msisdn IS NOT NULL THEN '1' ELSE '0' END AS mtd_flag
        FROM orders o LEFT JOIN history_mtd h ON h.subs_id_mtd = 'S' || cast(o.o_custkey AS string)
        AND h.msisdn = '628' || reverse(lpad(cast(o.o_custkey AS string), 8, '0'))""",
    )
)
def history_enrich_composite(t: Tables) -> DataFrame:
    key = F.col("o_custkey").cast("string")
    orders = t.orders.select(
        "o_orderkey",
        F.concat(F.lit("S"), key).alias("subs_id"),
        F.concat(F.lit("628"), F.reverse(F.lpad(key, 8, "0"))).alias("msisdn"),
    )
    return enrich.enrich_dominant_location(
        orders,
        t.feed("history_mtd"),
        "mtd",
        {"msisdn": "msisdn", "subs_id": "subs_id_mtd"},
        HISTORY_COLUMNS,
    ).select(
        "o_orderkey", "mtd_lacci_id", "mtd_area_name", "mtd_node", "mtd_provinsi", "mtd_kelurahan", "mtd_flag"
    )


PAYMENT_CELL = """cell_parts AS (SELECT *, regexp_replace(substr(cell_id, 10, 7), '^0', '') || '_' ||
    regexp_replace(substr(cell_id, 17), '^0', '') AS c1, regexp_replace(substr(cell_id, 5, 5), '^0', '') || '_' ||
    regexp_replace(substr(cell_id, 10), '^0', '') AS c2 FROM {feed}),
    cells AS (SELECT * EXCLUDE (cell_id), CASE WHEN indicator_4g IN ('129', '130') THEN c1
    WHEN indicator_4g IN ('128', '131') THEN cell_id ELSE c2 END AS cell_id,
    CASE WHEN indicator_4g IN ('129', '130') THEN replace(c1, '_', '|')
    WHEN indicator_4g IN ('128', '131') THEN cell_id ELSE replace(c2, '_', '|') END AS trx_lacci FROM cell_parts)"""
USUAL = """usual_mtd AS (SELECT subs_id_mtd, min(lacci_id_mtd) AS mtd_id FROM payment_mtd GROUP BY subs_id_mtd),
    usual_mm AS (SELECT subs_id_mm, min(lacci_id_mm) AS mm_id FROM payment_mm GROUP BY subs_id_mm)"""


def _payments_with_cell(t: Tables) -> DataFrame:
    return locate.payment_cell(t.feed("payments")).withColumn(
        "subs_id", F.concat(F.lit("S"), F.ltrim(F.reverse(F.substring("msisdn", 4, 8)), F.lit("0")))
    )


SUBS_OF_PHONE = "'S' || ltrim(reverse(substr(msisdn, 4, 8)), '0')"


@query(
    with_feeds(
        ["payments", "payment_mtd", "payment_mm"],
        f"""{PAYMENT_CELL.format(feed='payments')}, {USUAL},
        owned AS (SELECT bss_order_id, {SUBS_OF_PHONE} AS subs_id, nullif(nullif(trx_lacci, '|'), '') AS own FROM cells)
        SELECT bss_order_id, coalesce(own, mtd_id, mm_id, '-99') AS trx_lacci, CASE WHEN own IS NULL AND mtd_id IS NOT NULL
        THEN '1#' WHEN own IS NULL AND mm_id IS NOT NULL THEN '2#' ELSE '0' END AS find_flag
        FROM owned LEFT JOIN usual_mtd ON subs_id_mtd = subs_id LEFT JOIN usual_mm ON subs_id_mm = subs_id""",
    )
)
def history_fallback(t: Tables) -> DataFrame:
    return enrich.fill_location_from_history(
        _payments_with_cell(t), t.feed("payment_mtd"), t.feed("payment_mm"), spread_by=["bss_order_id"]
    ).select("bss_order_id", "trx_lacci", "find_flag")


@query(
    with_feeds(
        ["payments", "payment_mtd", "payment_mm"],
        f"""{PAYMENT_CELL.format(feed='payments')}, {USUAL},
        owned AS (SELECT bss_order_id, {SUBS_OF_PHONE} AS subs_id,
        CASE WHEN trx_lacci = '|' THEN '' ELSE trx_lacci END AS own FROM cells)
        SELECT bss_order_id, coalesce(own, mtd_id, mm_id, '-99') AS trx_lacci,
        CASE WHEN mtd_id = coalesce(own, mtd_id, mm_id) THEN '1#' WHEN mm_id = coalesce(own, mtd_id, mm_id) THEN '2#'
        ELSE '0' END AS find_flag
        FROM owned LEFT JOIN usual_mtd ON subs_id_mtd = subs_id LEFT JOIN usual_mm ON subs_id_mm = subs_id""",
    )
)
def history_fallback_literal(t: Tables) -> DataFrame:
    """The literal rule: blanks block history, equal ids raise the flag."""
    return enrich.fill_location_from_history(
        _payments_with_cell(t),
        t.feed("payment_mtd"),
        t.feed("payment_mm"),
        blank_blocks=True,
        flag_on_equal_id=True,
    ).select("bss_order_id", "trx_lacci", "find_flag")


_LOCATED = """located AS (SELECT bss_order_id, trx_lacci, coalesce(a.lacci_id, b.lacci_id, c.lacci_id) AS lacci_id_laccima,
    coalesce(a.lac, b.lac, c.lac) AS lac, coalesce(a.kelurahan, b.kelurahan, c.kelurahan) AS kelurahan,
    CASE WHEN a.lac IS NOT NULL THEN a.area_sales WHEN b.lac IS NOT NULL THEN b.area_sales ELSE c.area_sales END AS area_name,
    a.lac IS NOT NULL OR b.lac IS NOT NULL OR c.lac IS NOT NULL AS location_found FROM cells
    LEFT JOIN locations a ON a.lacci_id = trx_lacci LEFT JOIN locations b ON b.eci = trx_lacci
    LEFT JOIN locations c ON c.cgi_post = trx_lacci)"""
_LOCATION_SQL = with_feeds(
    ["payments", "locations"],
    f"""{PAYMENT_CELL.format(feed='payments')}, {_LOCATED} SELECT bss_order_id, trx_lacci, lacci_id_laccima, lac,
    kelurahan, area_name FROM located""",
)
_LOCATION_COLUMNS = ("bss_order_id", "trx_lacci", "lacci_id_laccima", "lac", "kelurahan", "area_name")
_LOCATION_TAKE = {"lacci_id_laccima": "lacci_id", **payment.LOCATION_NAMES}


@query(_LOCATION_SQL)
def location_multi_key(t: Tables) -> DataFrame:
    index = locate.location_index(t.feed("locations"), payment.LOCATION_KEYS, _LOCATION_TAKE)
    return locate.lookup_location(
        _payments_with_cell(t), index, spread_by=["bss_order_id"]
    ).select(*_LOCATION_COLUMNS)


@query(_LOCATION_SQL)
def location_multi_key_literal(t: Tables) -> DataFrame:
    return locate.lookup_location_stepwise(
        _payments_with_cell(t), t.feed("locations"), payment.LOCATION_KEYS, _LOCATION_TAKE
    ).select(*_LOCATION_COLUMNS)


@query(
    with_feeds(
        ["payments", "locations"],
        f"""{PAYMENT_CELL.format(feed='payments')}, {_LOCATED},
        packed AS (SELECT bss_order_id, CASE WHEN location_found AND area_name <> 'UNKNOWN'
        THEN '0#' || lacci_id_laccima ELSE '-1#-99 ' END AS lacci_id_flag FROM located)
        SELECT bss_order_id, lacci_id_flag, split_part(lacci_id_flag, '#', 1) AS lacci_closing_flag,
        split_part(lacci_id_flag, '#', 2) AS lacci_id FROM packed""",
    )
)
def closing_flag(t: Tables) -> DataFrame:
    index = locate.location_index(t.feed("locations"), payment.LOCATION_KEYS, _LOCATION_TAKE)
    found = locate.lookup_location(_payments_with_cell(t), index).withColumn("find_flag", F.lit("0"))
    return locate.closing_flag(found).select(
        "bss_order_id", "lacci_id_flag", "lacci_closing_flag", "lacci_id"
    )


def cascade_sql(strict: bool, master: str, history: str, default: str) -> str:
    """One column of the location cascade."""
    known = " AND m_area <> 'UNKNOWN'" if strict else ""
    mtd_known = " AND mtd_area <> 'UNKNOWN'" if strict else ""
    mm_known = " AND mm_area <> 'UNKNOWN'" if strict else ""
    return (
        f"CASE WHEN m_found{known} THEN m_{master} WHEN mtd_found{mtd_known} THEN mtd_{history} "
        f"WHEN mm_found{mm_known} THEN mm_{history} ELSE '{default}' END"
    )


_SUPPLIER_CASCADE = """joined AS (SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_quantity,
    m.lacci_id IS NOT NULL AS m_found, coalesce(m.area_sales, 'UNKNOWN') AS m_area, m.lacci_id AS m_lacci, m.branch AS m_branch,
    h.msisdn IS NOT NULL AS mtd_found, h.lacci_area_name AS mtd_area, h.lacci_id AS mtd_lacci, h.lacci_branch AS mtd_branch,
    p.msisdn IS NOT NULL AS mm_found, p.lacci_area_name AS mm_area, p.lacci_id AS mm_lacci, p.lacci_branch AS mm_branch
    FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey LEFT JOIN locations m
    ON m.ci = cast(20000 + l.l_suppkey AS string) AND l.l_discount < 0.05
    LEFT JOIN history_mtd h ON h.subs_id_mtd = 'S' || cast(o.o_custkey AS string)
    LEFT JOIN history_mm p ON p.subs_id_mm = 'S' || cast(o.o_custkey AS string))"""


@query(
    with_feeds(
        ["locations", "history_mtd", "history_mm"],
        f"""{_SUPPLIER_CASCADE} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
        {cascade_sql(True, 'lacci', 'lacci', '-99')} AS lacci_id,
        CASE WHEN m_found AND m_area <> 'UNKNOWN' THEN '0' WHEN mtd_found AND mtd_area <> 'UNKNOWN' THEN '1'
        WHEN mm_found AND mm_area <> 'UNKNOWN' THEN '2' ELSE '-1' END AS lacci_closing_flag,
        {cascade_sql(False, 'area', 'area', 'NQ')} AS area_sales,
        {cascade_sql(False, 'branch', 'branch', 'NQ')} AS branch FROM joined""",
    )
)
def location_cascade(t: Tables) -> DataFrame:
    key = F.col("o_custkey").cast("string")
    lines = t.lineitem.join(t.orders, F.col("o_orderkey") == F.col("l_orderkey")).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
        F.concat(F.lit("S"), key).alias("subs_id"),
        F.concat(F.lit("628"), F.reverse(F.lpad(key, 8, "0"))).alias("msisdn"),
        F.when(F.col("l_discount") < 0.05, (F.col("l_suppkey") + 20000).cast("string")).alias("trx_lacci"),
        F.lit("ci").alias("kind"),
    )
    for prefix, feed in (("mtd", "history_mtd"), ("mm", "history_mm")):
        lines = enrich.enrich_dominant_location(
            lines,
            t.feed(feed),
            prefix,
            {"msisdn": "msisdn", "subs_id": f"subs_id_{prefix}"},
            HISTORY_COLUMNS,
        )
    matched = locate.match_location(
        lines,
        t.feed("locations"),
        kind="kind",
        kinds=("ci",),
        unknown_area_for=("ci",),
        spread_by=["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"],
    )
    return locate.resolve_location_cascade(matched).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
        "lacci_id", "lacci_closing_flag", "area_sales", "branch",
    )


@query(
    """SELECT o.o_orderkey, c.c_name FROM orders o LEFT JOIN customer c
    ON 'Customer#' || lpad(cast(o.o_custkey AS string), 9, '0') || '_' || right(lpad(cast(o.o_custkey AS string), 9, '0'), 4)
    = c.c_name || '_' || right(c.c_name, 4)"""
)
def derived_key_join(t: Tables) -> DataFrame:
    """A key with its own suffix joins like the key itself."""
    name = F.concat(F.lit("Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0"))
    return lookup.lookup(
        t.orders.select("o_orderkey", name.alias("key")), t.customer, {"key": "c_name"}, {"c_name": "c_name"}
    ).drop("key")


@query(
    with_feeds(
        ["payments", "products"],
        """keyed AS (SELECT coalesce(nullif(mapping_key_type, ''), rkey) AS k, l4_name, l3_name, l2_name, l1_name FROM products),
        one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY l4_name NULLS LAST, l3_name NULLS LAST,
        l2_name NULLS LAST, l1_name NULLS LAST) AS rn FROM keyed) AS numbered WHERE rn = 1)
        SELECT bss_order_id, coalesce(l4_name, 'NQ') AS l4_name, coalesce(l3_name, 'NQ') AS l3_name,
        coalesce(l2_name, 'NQ') AS l2_name, coalesce(l1_name, 'NQ') AS l1_name
        FROM payments LEFT JOIN one ON k = topping_id""",
    )
)
def product_key_normalise(t: Tables) -> DataFrame:
    products = product.normalise_product_key(t.feed("products"))
    return product.add_product(
        t.feed("payments").select("bss_order_id", "topping_id"), products, offer="topping_id"
    ).drop("topping_id")


PRODUCT_CASCADE = """by_service AS (
    SELECT 's1' AS svc, rkey, l4_name, l3_name, l2_name, l1_name FROM products WHERE mapping_key_type IS NULL
    UNION ALL SELECT 's2', rkey, l4_name, l3_name, l2_name, l1_name FROM products WHERE service_type = '2_' AND product_name IS NULL
    UNION ALL SELECT 's3', rkey, l4_name, l3_name, l2_name, l1_name FROM products WHERE service_type = '3_' AND product_name IS NULL
    UNION ALL SELECT 's5', rkey, l4_name, l3_name, l2_name, l1_name FROM products WHERE service_type = '5_'),
    one_product AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY svc, rkey ORDER BY l4_name NULLS LAST,
    l3_name NULLS LAST, l2_name NULLS LAST, l1_name NULLS LAST) AS rn FROM by_service) AS numbered WHERE rn = 1),
    serviced AS (SELECT *, CASE WHEN service_filter LIKE '1!_%' ESCAPE '!' THEN 's1' WHEN service_filter LIKE '2!_%' ESCAPE '!'
    THEN 's2' WHEN service_filter LIKE '3!_%' ESCAPE '!' THEN 's3' WHEN service_filter LIKE '5!_%' ESCAPE '!' THEN 's5'
    ELSE 'sR' END AS service FROM {source}),
    named AS (SELECT s.*, {levels} FROM serviced s
    LEFT JOIN one_product p1 ON p1.svc = service AND p1.rkey = CASE WHEN service IN ('s2', 's3') THEN b_party
    WHEN service = 's1' THEN offer_id WHEN service = 's5' THEN vas_code END
    LEFT JOIN one_product p2 ON p2.svc = service AND service IN ('s2', 's3') AND p2.rkey = offer_id
    LEFT JOIN one_product p3 ON p3.svc = service AND service IN ('s2', 's3') AND p3.rkey = service_filter)""".replace(
    "{levels}",
    ", ".join(
        f"CASE WHEN p1.rkey IS NOT NULL AND p1.{c} IS DISTINCT FROM 'NQ' THEN p1.{c} "
        f"WHEN p2.rkey IS NOT NULL AND p2.{c} IS DISTINCT FROM 'NQ' THEN p2.{c} "
        f"WHEN p3.rkey IS NOT NULL AND p3.{c} IS DISTINCT FROM 'NQ' THEN p3.{c} ELSE 'NQ' END AS {c}"
        for c in product.LEVELS
    ),
)
_PRODUCT_SQL = with_feeds(
    ["usage_feed", "products"],
    """offered AS (SELECT rec_id, service_filter, b_party, vas_code, CASE WHEN instr(bonus_consumed, '#') > 0
    THEN substr(bonus_consumed, 1, instr(bonus_consumed, '#') - 1) ELSE '' END AS offer_id FROM usage_feed), """
    + PRODUCT_CASCADE.format(source="offered")
    + " SELECT rec_id, service_filter, l4_name, l3_name, l2_name, l1_name FROM named",
)


def _usage_offers(t: Tables) -> DataFrame:
    return t.feed("usage_feed").select(
        "rec_id", "service_filter", "b_party", "vas_code", before("bonus_consumed", "#").alias("offer_id")
    )


@query(_PRODUCT_SQL)
def product_cascade(t: Tables) -> DataFrame:
    return product.classify_product_by_service(_usage_offers(t), t.feed("products")).drop(
        "b_party", "vas_code", "offer_id"
    )


@query(_PRODUCT_SQL)
def product_cascade_literal(t: Tables) -> DataFrame:
    return product.classify_product_stepwise(_usage_offers(t), t.feed("products")).drop(
        "b_party", "vas_code", "offer_id"
    )


@query(
    with_feeds(
        ["usage_feed", "product_lines"],
        """offered AS (SELECT rec_id, CASE WHEN instr(bonus_consumed, '#') > 0
        THEN substr(bonus_consumed, 1, instr(bonus_consumed, '#') - 1) ELSE '' END AS offer_id FROM usage_feed),
        lines AS (SELECT substr(trim(l4), 4, 8) AS k, min(l4) AS l4 FROM product_lines GROUP BY 1)
        SELECT rec_id, CASE WHEN k IS NOT NULL THEN l4 ELSE '' END AS productline_bonus_l4
        FROM offered LEFT JOIN lines ON k = substr(trim(offer_id), 3, 8)""",
    )
)
def substring_join(t: Tables) -> DataFrame:
    return product.add_bonus_line(
        _usage_offers(t).select("rec_id", "offer_id"), t.feed("product_lines")
    ).drop("offer_id")


LINE_CLEANING = """renamed AS (SELECT trim(note) AS trim_note,
    CASE l1 WHEN 'UNKNOWN' THEN 'Others' WHEN 'Digital Service' THEN 'Digital Services' ELSE l1 END AS l1,
    CASE l2 WHEN 'UNKNOWN' THEN 'Others' WHEN 'Other VAS Services' THEN 'Other VAS Service'
    WHEN 'SMS Non P to P' THEN 'SMS Non P2P' ELSE l2 END AS l2, l3, l4 FROM product_lines WHERE upper(source) = 'PAYD'),
    cleaned AS (SELECT trim_note, l1, l2, CASE WHEN l1 = 'Voice P2P' AND l2 = 'Internal MO Call' AND l3 = 'Local'
    THEN 'Local (On-Net)' WHEN l3 = 'Other VAS Services' THEN 'Other VAS Service' WHEN l3 = 'Volume Based' THEN 'Volume based'
    ELSE l3 END AS l3, l4 FROM renamed)"""


@query(with_feeds(["product_lines"], f"{LINE_CLEANING} SELECT trim_note, l1, l2, l3, l4 FROM cleaned"))
def taxonomy_cleaning(t: Tables) -> DataFrame:
    return product.prepaid_lines(t.feed("product_lines")).select("trim_note", "l1", "l2", "l3", "l4")


@query(
    with_feeds(
        ["recharges", "product_lines"],
        f"""{LINE_CLEANING} SELECT rec_id, coalesce(l1, 'Others') AS l1, coalesce(l2, 'Others') AS l2,
        coalesce(l3, 'Others') AS l3, coalesce(l4, 'Others') AS l4 FROM recharges LEFT JOIN cleaned
        ON trim_note = substr(provider_id, 3, 5)""",
    )
)
def note_join(t: Tables) -> DataFrame:
    return product.add_line_by_note(
        t.feed("recharges").select("rec_id", "provider_id"),
        product.prepaid_lines(t.feed("product_lines")),
        offer="provider_id",
    ).drop("provider_id")


@query(
    with_feeds(
        ["order_feed", "accounting", "products"],
        """SELECT order_id, a.l1_payu, a.l4_product_category, p.l1_name FROM order_feed
        LEFT JOIN accounting a ON a.service_type = '1_' AND a.rkey = main_plan_id
        LEFT JOIN (SELECT rkey, min(l1_name) AS l1_name FROM products WHERE service_type = '1_' GROUP BY rkey) AS p
        ON p.rkey = main_plan_id""",
    )
)
def dim_filter_join(t: Tables) -> DataFrame:
    """Two dimensions cut to one service type before the join."""
    orders = t.feed("order_feed").select("order_id", "main_plan_id")
    for feed, columns in (("accounting", ("l1_payu", "l4_product_category")), ("products", ("l1_name",))):
        dim = t.feed(feed).filter(F.col("service_type") == "1_")
        orders = lookup.lookup(orders, dim, {"main_plan_id": "rkey"}, {c: c for c in columns})
    return orders.drop("main_plan_id")


ONE_PREFIX = """one_prefix AS (SELECT * FROM (SELECT enriched_prefix, area, area_name, regional, row_number() OVER
    (PARTITION BY enriched_prefix ORDER BY area NULLS LAST, area_name NULLS LAST, regional NULLS LAST) AS rn
    FROM prefixes) AS numbered WHERE rn = 1)"""
REGION_CASE = (
    "CASE regional "
    + " ".join(f"WHEN '{old}' THEN '{new}'" for old, new in marts.REGION_NAMES.items())
    + " ELSE regional END"
)


@query(
    with_feeds(
        ["payments", "prefixes"],
        f"""{ONE_PREFIX} SELECT bss_order_id, CASE WHEN area_name IS NOT NULL AND area_name <> 'NQ' THEN area_name
        ELSE 'UNKNOWN' END AS area_hlr, CASE WHEN regional IS NOT NULL AND regional <> 'NQ' THEN {REGION_CASE}
        ELSE 'UNKNOWN' END AS region_hlr, CASE WHEN regional IS NOT NULL AND regional <> 'NQ' THEN regional
        ELSE 'UNKNOWN' END AS city_hlr FROM payments LEFT JOIN one_prefix ON enriched_prefix = substr(msisdn, 1, 8)""",
    )
)
def prefix_join_gated(t: Tables) -> DataFrame:
    joined = enrich.join_phone_prefix(
        t.feed("payments").select("bss_order_id", "msisdn"),
        t.feed("prefixes"),
        {"area": "area", "area_name": "area_name", "regional": "regional"},
    )
    has_region = marts.present("regional")
    return joined.select(
        "bss_order_id",
        marts.gated("area_name", F.col("prefix_found") & marts.present("area_name")).alias("area_hlr"),
        marts.gated(marts.normalise_region("regional"), F.col("prefix_found") & has_region).alias("region_hlr"),
        marts.gated("regional", has_region).alias("city_hlr"),
    )


@query(
    """SELECT o.o_orderkey, p.c_mktsegment, nullif(nullif(o.o_orderpriority, '5-LOW'), '3-MEDIUM') AS priority
    FROM orders o LEFT JOIN customer p ON p.c_custkey = o.o_custkey
    AND nullif(nullif(o.o_orderpriority, '5-LOW'), '3-MEDIUM') IS NOT NULL"""
)
def null_key_salting(t: Tables) -> DataFrame:
    """Two fifths of the records have no key; spread, they join like unspread."""
    priority = F.nullif(F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")), F.lit("3-MEDIUM"))
    orders = t.orders.select("o_orderkey", priority.alias("priority"), F.col("o_custkey").cast("string").alias("k"))
    keyed = orders.withColumn(
        "k", lookup.spread_key("k", ["o_orderkey"], missing=F.col("priority").isNull())
    )
    customers = t.customer.withColumn("k", F.col("c_custkey").cast("string"))
    joined = lookup.lookup(keyed, customers, {"k": "k"}, {"c_mktsegment": "c_mktsegment"})
    blanked = joined.withColumn("k", F.when(lookup.is_spread("k"), F.lit("")).otherwise(F.col("k")))
    return blanked.drop("k")
