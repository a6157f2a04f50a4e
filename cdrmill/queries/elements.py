"""Scans, sinks, projections, predicates and scalar expressions."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import amounts, text, times
from ..operators import locate, product, quality
from ..schemas import PAYMENT_FEED
from ..session import scratch_dir
from ..sources import audit, readers, writers
from .base import Registry, Tables, with_feeds

registry = Registry()
query = registry.add


def _folder(t: Tables, label: str) -> str:
    return f"{scratch_dir(t.spark)}/{label}-{uuid.uuid4().hex}"


def _day(c: str) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


# --- scans and sinks ---------------------------------------------------------


@query(
    """SELECT o_orderkey AS order_id, o_custkey AS subscriber, o_orderstatus AS state,
    o_orderpriority AS channel, o_orderkey AS order_again FROM orders"""
)
def scan_project_rename(t: Tables) -> DataFrame:
    picked = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderkey")
    return readers.rename(picked, ["order_id", "subscriber", "state", "channel", "order_again"])


@query(
    """SELECT cast(c_custkey AS string) AS c_custkey, nullif(c_mktsegment, 'MACHINERY') AS segment,
    coalesce(nullif(c_mktsegment, 'MACHINERY'), 'NQ') AS filled, cast(c_nationkey AS string) AS nation
    FROM customer"""
)
def scan_delimited_roundtrip(t: Tables) -> DataFrame:
    path = _folder(t, "delimited")
    customers = t.customer.select(
        F.col("c_custkey").cast("string"),
        F.nullif(F.col("c_mktsegment"), F.lit("MACHINERY")).alias("segment"),
        F.col("c_nationkey").cast("string"),
    )
    writers.write_delimited(customers, path)
    back = readers.read_feed(t.spark, path, ["c_custkey", "segment", "nation"], sep="~")
    return back.withColumn("filled", F.col("segment")).fillna("NQ", ["filled"])


@query(with_feeds(["payments"], f"SELECT {', '.join(PAYMENT_FEED)} FROM payments"))
def scan_payment_feed(t: Tables) -> DataFrame:
    """The payment feed written and read as a 21-column pipe-delimited file."""
    path = _folder(t, "payment_feed")
    writers.write_delimited(t.feed("payments"), path, sep="|")
    return readers.read_feed(t.spark, path, PAYMENT_FEED)


def _table_name(t: Tables, label: str) -> str:
    """A new table name, in a database kept in the scratch folder."""
    writers.create_database(t.spark, "cdrmill", f"{scratch_dir(t.spark)}/warehouse")
    return f"cdrmill.{label}_{uuid.uuid4().hex}"


@query("SELECT p_partkey, p_name, p_brand FROM part")
def table_roundtrip(t: Tables) -> DataFrame:
    name = _table_name(t, "part")
    writers.write_table(t.part.select("p_partkey", "p_name", "p_brand"), name)
    return readers.read_table(t.spark, name)


@query("SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders")
def nested_folder_scan(t: Tables) -> DataFrame:
    root = _folder(t, "nested")
    picked = t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority")
    for day, part in quality.split_by(
        picked, "o_orderstatus", ("F", "O", "P"), rest="other"
    ).items():
        part.write.parquet(f"{root}/2023/01/{day}")
    return readers.read_parquet(t.spark, f"{root}/*/*/*", picked.columns)


@query("SELECT s_name, cast(s_nationkey AS string) AS s_nationkey FROM supplier")
def header_csv_scan(t: Tables) -> DataFrame:
    path = _folder(t, "header")
    t.supplier.select("s_suppkey", "s_name", "s_nationkey").write.option("sep", ";").option(
        "header", True
    ).csv(path)
    return readers.read_header_csv(t.spark, path, ["s_name", "s_nationkey"])


@query("SELECT cast(s_suppkey AS string) AS s_suppkey, s_name FROM supplier")
def bulk_load_table(t: Tables) -> DataFrame:
    path, name, columns = _folder(t, "bulk"), _table_name(t, "supplier"), ["s_suppkey", "s_name"]
    writers.write_delimited(t.supplier.select(*columns), path, sep="|")
    writers.drop_tables(t.spark, [name])
    writers.create_text_table(t.spark, name, columns)
    for _ in range(2):
        writers.load_delimited(t.spark, path, name, columns)
    return readers.read_table(t.spark, name)


@query(
    """SELECT o_orderstatus AS route, count(*) AS records,
    round(cast(sum(cast(o_totalprice AS decimal(18,2))) AS double), 2) AS amount
    FROM orders GROUP BY o_orderstatus"""
)
def multi_route_outputs(t: Tables) -> DataFrame:
    path = _folder(t, "routes")
    routed = t.orders.select(F.col("o_orderstatus").alias("route"), "o_orderkey", "o_totalprice")
    writers.write_routed(routed, path, "route")
    counts = quality.route_counts(readers.read_parquet(t.spark, path), "route", "o_totalprice")
    return counts.withColumn("amount", F.round("amount", 2))


@query(
    """SELECT 'input' AS label, count(*) AS records FROM orders
    UNION ALL SELECT lower(o_orderstatus), count(*) FROM orders GROUP BY o_orderstatus"""
)
def audit_counts(t: Tables) -> DataFrame:
    run = audit.Run("orders")
    counted = run.count(t.orders.select("o_orderkey", "o_orderstatus"), "input")
    for status in ("F", "O", "P"):
        only = F.when(F.col("o_orderstatus") == status, F.lit(1))
        seen = audit.Observation(f"orders_{status}")
        run.observed[status.lower()] = seen
        counted = counted.observe(seen, F.count(only).alias("rows"))
    writers.write_routed(counted, _folder(t, "audited"), "o_orderstatus")
    return run.record(t.spark).select(F.explode("counts").alias("label", "records"))


@query(
    """SELECT lpad(cast(o_custkey % 12 + 1 AS string), 2, '0') AS route, substr(cast(o_orderdate AS string), 1, 4) AS year,
    count(*) AS records FROM orders GROUP BY 1, 2"""
)
def typed_partitions(t: Tables) -> DataFrame:
    """Routes "01" to "12" and years stay text through folders by route and date."""
    routed, dated = _folder(t, "routes"), _folder(t, "years")
    route = F.lpad((F.col("o_custkey") % 12 + 1).cast("string"), 2, "0")
    year = F.date_format("o_orderdate", "yyyy")
    writers.write_routed(t.orders.select("o_orderkey", route.alias("route"), year.alias("year")), routed, "route")
    writers.write_by_date(readers.read_partitioned(t.spark, routed), dated, "year")
    back = readers.read_partitioned(t.spark, dated)
    return back.groupBy("route", "year").agg(F.count(F.lit(1)).alias("records"))


@query(
    """SELECT substr(cast(o_orderdate AS string), 1, 10) AS event_date, count(*) AS records
    FROM orders GROUP BY 1"""
)
def dated_output(t: Tables) -> DataFrame:
    path = _folder(t, "dated")
    dated = t.orders.select("o_orderkey", F.trunc("o_orderdate", "year").cast("string").alias("year"),
                            _day("o_orderdate").alias("event_date"))
    writers.write_by_date(dated, path, "year")
    return readers.read_parquet(t.spark, path).groupBy("event_date").agg(
        F.count(F.lit(1)).alias("records")
    )


# --- projections -------------------------------------------------------------


@query(
    """SELECT o_orderkey, 'byU' AS brand, 'JKT' AS site_name, '1' AS pre_post_flag,
    '2023-02-22 01:59:59' AS load_ts, '' AS file_id, 0 AS retry_count FROM orders"""
)
def constant_columns(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey").withColumns(
        {
            "brand": F.lit("byU"),
            "site_name": F.lit("JKT"),
            "pre_post_flag": F.lit("1"),
            "load_ts": F.lit("2023-02-22 01:59:59"),
            "file_id": F.lit(""),
            "retry_count": F.lit(0),
        }
    )


@query(
    """SELECT o_orderkey, o_orderstatus AS status_copy,
    CASE WHEN o_orderstatus = 'F' THEN 'O' ELSE o_orderstatus END AS first_step,
    CASE WHEN (CASE WHEN o_orderstatus = 'F' THEN 'O' ELSE o_orderstatus END) = 'O' THEN 'X' ELSE o_orderstatus END
    AS o_orderstatus FROM orders"""
)
def column_copy_and_overwrite(t: Tables) -> DataFrame:
    status = F.col("o_orderstatus")
    return (
        t.orders.select("o_orderkey", "o_orderstatus", status.alias("status_copy"))
        .withColumn("o_orderstatus", F.when(status == "F", F.lit("O")).otherwise(status))
        .withColumn("first_step", status)
        .withColumn("o_orderstatus", F.when(status == "O", F.lit("X")).otherwise(status))
    )


@query(
    """SELECT o.o_orderkey, o.o_custkey, c.c_mktsegment FROM orders o
    LEFT JOIN customer c ON c.c_custkey = o.o_custkey"""
)
def alias_and_drop(t: Tables) -> DataFrame:
    customers = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    return (
        t.orders.select("o_orderkey", "o_custkey")
        .alias("a")
        .join(customers.alias("b"), F.col("a.o_custkey") == F.col("b.o_custkey"), "left")
        .drop(F.col("b.o_custkey"))
    )


@query(
    """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
    ORDER BY o_totalprice DESC, o_orderkey LIMIT 20"""
)
def preview_limit(t: Tables) -> DataFrame:
    """A look at the 20 largest orders: a top-k, so no full sort."""
    return (
        t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
        .orderBy(F.desc("o_totalprice"), "o_orderkey")
        .limit(20)
    )


# --- predicates and routing --------------------------------------------------


@query(
    with_feeds(
        ["usage_feed"],
        """SELECT CASE WHEN timestamp IS NULL AND a_party IS NULL AND account_delta IS NULL
        THEN 'BAD' ELSE 'GOOD' END AS side, count(*) AS records,
        count(timestamp) AS with_time FROM usage_feed GROUP BY 1""",
    )
)
def bad_quarantine(t: Tables) -> DataFrame:
    good, bad = quality.quarantine_bad(t.feed("usage_feed"), ("timestamp", "a_party", "account_delta"))
    both = good.withColumn("side", F.lit("GOOD")).unionByName(bad.withColumn("side", F.lit("BAD")))
    return both.groupBy("side").agg(
        F.count(F.lit(1)).alias("records"), F.count("timestamp").alias("with_time")
    )


@query(
    with_feeds(
        ["recharges"],
        """SELECT rec_id, CASE WHEN indicator_4g IN ('129', '130') THEN 'eci'
        WHEN indicator_4g IN ('128', '131') THEN 'cgi_post' ELSE 'lacci_id' END AS three_way,
        CASE WHEN indicator_4g IN ('129', '130') THEN 'eci' ELSE 'lacci_id' END AS two_way FROM recharges""",
    )
)
def route_code_set(t: Tables) -> DataFrame:
    return t.feed("recharges").select(
        "rec_id",
        locate.route_by_network("indicator_4g", cgi=True).alias("three_way"),
        locate.route_by_network("indicator_4g", cgi=False).alias("two_way"),
    )


@query(
    with_feeds(
        ["usage_feed"],
        """SELECT CASE WHEN service_filter LIKE '1!_%' ESCAPE '!' THEN 's1'
        WHEN service_filter LIKE '2!_%' ESCAPE '!' THEN 's2' WHEN service_filter LIKE '3!_%' ESCAPE '!' THEN 's3'
        WHEN service_filter LIKE '5!_%' ESCAPE '!' THEN 's5' ELSE 'sR' END AS service, count(*) AS records
        FROM usage_feed GROUP BY 1""",
    )
)
def route_prefix(t: Tables) -> DataFrame:
    return (
        t.feed("usage_feed")
        .groupBy(product.service_group("service_filter").alias("service"))
        .agg(F.count(F.lit(1)).alias("records"))
    )


@query("SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%widget%'")
def like_filter(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", "p_name").filter(F.col("p_name").like("%widget%"))


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_partkey = l_suppkey")
def sql_string_predicate(t: Tables) -> DataFrame:
    return t.lineitem.where("l_partkey = l_suppkey").select("l_orderkey", "l_linenumber", "l_partkey")


@query("SELECT event_id, event_type, value FROM events WHERE upper(event_type) = 'PURCHASE'")
def business_filter(t: Tables) -> DataFrame:
    return t.events.filter(F.upper("event_type") == "PURCHASE").select("event_id", "event_type", "value")


@query(
    """SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders"""
)
def union_branches(t: Tables) -> DataFrame:
    parts = quality.split_by(
        t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority"),
        "o_orderstatus",
        ("F", "O", "P"),
        rest="other",
    )
    return reduce(DataFrame.unionByName, parts.values())


@query(
    """SELECT CASE WHEN s IN ('F', 'P') THEN s ELSE 'other' END AS route, s AS status, count(*) AS records
    FROM (SELECT CASE WHEN o_orderkey % 3 > 0 THEN o_orderstatus END AS s FROM orders) GROUP BY 1, 2"""
)
def split_with_rest(t: Tables) -> DataFrame:
    """Null and unlisted routes are in the route for the rest."""
    given = F.when(F.col("o_orderkey") % 3 > 0, F.col("o_orderstatus"))
    parts = quality.split_by(t.orders.select(given.alias("status")), "status", ("F", "P"), rest="other")
    routed = [part.withColumn("route", F.lit(route)) for route, part in parts.items()]
    return reduce(DataFrame.unionByName, routed).groupBy("route", "status").agg(
        F.count(F.lit(1)).alias("records")
    )


@query(
    """SELECT l_orderkey, l_linenumber, CASE WHEN coalesce(nullif(l_returnflag, 'N'), l_linestatus) = 'F'
    OR (l_quantity > 25 AND l_tax < 0.04) THEN 'y' ELSE 'x' END AS flag,
    CASE WHEN l_discount < 0.02 THEN 'low' WHEN l_discount < 0.06 THEN 'mid' ELSE
    CASE WHEN l_tax > 0.05 THEN 'high-taxed' ELSE 'high' END END AS band FROM lineitem"""
)
def case_and_null_logic(t: Tables) -> DataFrame:
    status = F.coalesce(F.nullif(F.col("l_returnflag"), F.lit("N")), F.col("l_linestatus"))
    taxed = F.when(F.col("l_tax") > 0.05, F.lit("high-taxed")).otherwise(F.lit("high"))
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        F.when((status == "F") | ((F.col("l_quantity") > 25) & (F.col("l_tax") < 0.04)), F.lit("y"))
        .otherwise(F.lit("x"))
        .alias("flag"),
        F.when(F.col("l_discount") < 0.02, F.lit("low"))
        .when(F.col("l_discount") < 0.06, F.lit("mid"))
        .otherwise(taxed)
        .alias("band"),
    )


# --- scalar expressions ------------------------------------------------------


@query(
    with_feeds(
        ["payments"],
        """SELECT bss_order_id, CASE WHEN plan_price = 'NQ' OR plan_price IS NULL THEN '0' ELSE plan_price END
        AS plan_price FROM payments""",
    )
)
def amount_normalise(t: Tables) -> DataFrame:
    return t.feed("payments").select("bss_order_id", amounts.price_or_zero("plan_price").alias("plan_price"))


@query(
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_linestatus = 'O' THEN 0.0
    WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice END AS rev,
    CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN -l_quantity ELSE l_quantity END AS amount FROM lineitem"""
)
def amount_signed(t: Tables) -> DataFrame:
    credit = F.when(F.col("l_returnflag") == "R", F.lit("C"))
    delta = F.when(F.col("l_linestatus") != "O", F.col("l_extendedprice").cast("string"))
    method = F.when(F.col("l_returnflag") == "A", F.lit("BTSOURCE"))
    debit = F.when(F.col("l_linestatus") == "F", F.lit("D"))
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        amounts.signed_usage(delta, credit).alias("rev"),
        amounts.signed_recharge(F.col("l_quantity").cast("string"), method, debit).alias("amount"),
    )


@query(
    with_feeds(
        ["payments"],
        """SELECT bss_order_id, CASE WHEN plan_id = 'SA10359' THEN future_string_1 WHEN plan_id IS NULL THEN topping_id
        ELSE plan_id END AS offer_id, coalesce(plan_id, topping_id) AS plain_offer FROM payments""",
    )
)
def offer_resolve(t: Tables) -> DataFrame:
    return t.feed("payments").select(
        "bss_order_id",
        product.resolve_offer("plan_id", "topping_id", "SA10359", "future_string_1").alias("offer_id"),
        product.resolve_offer("plan_id", "topping_id").alias("plain_offer"),
    )


@query(
    with_feeds(
        ["payments"],
        """parts AS (SELECT *, regexp_replace(substr(cell_id, 10, 7), '^0', '') || '_' ||
        regexp_replace(substr(cell_id, 17), '^0', '') AS c1, regexp_replace(substr(cell_id, 5, 5), '^0', '') || '_' ||
        regexp_replace(substr(cell_id, 10), '^0', '') AS c2 FROM payments)
        SELECT bss_order_id, CASE WHEN indicator_4g IN ('129', '130') THEN c1 WHEN indicator_4g IN ('128', '131')
        THEN cell_id ELSE c2 END AS cell_id, CASE WHEN indicator_4g IN ('129', '130') THEN replace(c1, '_', '|')
        WHEN indicator_4g IN ('128', '131') THEN cell_id ELSE replace(c2, '_', '|') END AS trx_lacci FROM parts""",
    )
)
def payment_cell_keys(t: Tables) -> DataFrame:
    return locate.payment_cell(t.feed("payments")).select("bss_order_id", "cell_id", "trx_lacci")


@query(
    with_feeds(
        ["usage_feed"],
        """trimmed AS (SELECT *, trim(cell_id) AS c FROM usage_feed)
        SELECT rec_id, indicator, trx_lacci, cell_id FROM (SELECT rec_id, future_string3 AS indicator,
        regexp_replace(CASE WHEN future_string3 IN ('129', '130') THEN substr(c, 11, 7) || '|' || substr(c, 18, 3)
        ELSE substr(c, 6, 5) || '|' || substr(c, 11, 5) END, '^0+', '') AS trx_lacci,
        CASE WHEN future_string3 IN ('129', '130') THEN substr(c, 11, 7) || '_' || substr(c, 18, greatest(length(c) - 19, 0))
        ELSE substr(c, 6, 5) || '_' || substr(c, 11, greatest(length(c) - 12, 0)) END AS cell_id FROM trimmed) AS keyed""",
    )
)
def fixed_width_keys(t: Tables) -> DataFrame:
    usage = t.feed("usage_feed").withColumn("c", F.trim("cell_id"))
    return usage.select(
        "rec_id",
        F.col("future_string3").alias("indicator"),
        locate.usage_cell_key("c", "future_string3", cgi_is_raw=False).alias("trx_lacci"),
        locate.usage_cell_id("c", "future_string3").alias("cell_id"),
    )


@query(
    """SELECT c_custkey, replace(c_name, '0', '_') AS swapped, split_part(c_name, '#', 1) AS head,
    split_part(c_name, '#', 2) AS tail, c_name || '_' || right(c_name, 4) AS suffixed FROM customer"""
)
def separator_swap(t: Tables) -> DataFrame:
    return t.customer.select(
        "c_custkey",
        text.swap("c_name", "0", "_").alias("swapped"),
        text.part("c_name", "#", 0).alias("head"),
        text.part("c_name", "#", 1).alias("tail"),
        text.suffix_key("c_name").alias("suffixed"),
    )


@query(
    """SELECT p_partkey, CASE WHEN instr(p_brand, '#') > 0 THEN substr(p_brand, 1, instr(p_brand, '#') - 1) ELSE '' END
    AS before_mark, CASE WHEN instr(p_name, '#') > 0 THEN substr(p_name, 1, instr(p_name, '#') - 1) ELSE '' END
    AS absent_mark FROM part"""
)
def text_before_marker(t: Tables) -> DataFrame:
    return t.part.select(
        "p_partkey",
        text.before("p_brand", "#").alias("before_mark"),
        text.before("p_name", "#").alias("absent_mark"),
    )


@query(
    """SELECT l3 AS name, count(*) AS parts FROM (SELECT upper(trim('  ' || p_name || ' ')) AS l3 FROM part) AS folded
    GROUP BY l3"""
)
def case_trim_upper(t: Tables) -> DataFrame:
    padded = F.concat(F.lit("  "), F.col("p_name"), F.lit(" "))
    return t.part.groupBy(F.upper(F.trim(padded)).alias("name")).agg(F.count(F.lit(1)).alias("parts"))


@query(
    with_feeds(
        ["recharges"],
        """SELECT rec_id, CASE WHEN length(timestamp) = 14 THEN substr(timestamp, 1, 4) || '-' || substr(timestamp, 5, 2)
        || '-' || substr(timestamp, 7, 2) END AS trx_date, CASE WHEN length(timestamp) = 14 THEN substr(timestamp, 9, 2) END
        AS trx_hour FROM recharges""",
    )
)
def event_time_parts(t: Tables) -> DataFrame:
    ts = times.event_time("timestamp")
    return t.feed("recharges").select(
        "rec_id", times.day(ts).alias("trx_date"), times.hour(ts).alias("trx_hour")
    )


@query(
    """SELECT o_orderkey, replace(substr(cast(o_orderdate AS string), 1, 10), '-', '') AS periode,
    substr(cast(o_orderdate AS string), 1, 4) AS trx_year FROM orders"""
)
def date_compaction(t: Tables) -> DataFrame:
    day = _day("o_orderdate")
    return t.orders.select(
        "o_orderkey", times.compact_date(day).alias("periode"), text.fixed(day, 1, 4).alias("trx_year")
    )


@query(
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity = 25 THEN 'same' ELSE 'other' END AS compared,
    l_quantity + l_linenumber AS total, l_linenumber + 1 AS retry_count FROM lineitem"""
)
def typed_comparisons(t: Tables) -> DataFrame:
    """Text amounts compared and added as numbers."""
    quantity, line = F.col("l_quantity").cast("string"), F.col("l_linenumber").cast("string")
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        F.when(amounts.number(quantity) == 25, F.lit("same")).otherwise(F.lit("other")).alias("compared"),
        (amounts.number(quantity) + amounts.number(line)).alias("total"),
        (line.try_cast("int") + 1).alias("retry_count"),
    )


@query(
    with_feeds(
        ["recharges"],
        """SELECT rec_id, rec_id + 1 AS retry_count, CASE WHEN timestamp IS NULL OR expiration_date IS NULL
        THEN '2999-12-31 23:59:59' ELSE substr(expiration_date, 1, 4) || '-' || substr(expiration_date, 5, 2) || '-' ||
        substr(expiration_date, 7, 2) || ' ' || substr(expiration_date, 9, 2) || ':' || substr(expiration_date, 11, 2)
        || ':' || substr(expiration_date, 13, 2) END AS expiry FROM recharges""",
    )
)
def retry_and_expiry(t: Tables) -> DataFrame:
    return t.feed("recharges").select(
        "rec_id",
        (F.col("rec_id") + 1).alias("retry_count"),
        times.expiry("timestamp", "expiration_date").alias("expiry"),
    )


@query(
    with_feeds(
        ["usage_feed"],
        """SELECT rec_id, substr(mcc_mnc, 1, 3) AS mcc, substr(mcc_mnc, 4, length(mcc_mnc) - 5) AS mnc,
        timestamp || event_id || trim(account_delta) AS network_activity_id FROM usage_feed""",
    )
)
def mcc_mnc_activity_id(t: Tables) -> DataFrame:
    return t.feed("usage_feed").select(
        "rec_id",
        text.mcc("mcc_mnc").alias("mcc"),
        text.mnc("mcc_mnc").alias("mnc"),
        text.activity_id("timestamp", "event_id", F.trim("account_delta")).alias("network_activity_id"),
    )
