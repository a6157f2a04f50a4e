"""Numbering, duplicates and completeness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import duplicates, quality, skew
from ..sentinels import NOT_QUALIFIED
from .base import Registry, Tables, with_feeds

registry = Registry()
query = registry.add

LINE = (
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax",
)
LINE_SQL = ", ".join(LINE)


def _lines(t: Tables, *more: str) -> DataFrame:
    return t.lineitem.select(*LINE, *more)


@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS rec_id FROM orders")
def record_numbering(t: Tables) -> DataFrame:
    return skew.number_by(t.orders.select("o_orderkey"), ["o_orderkey"], "rec_id")


@query(
    "SELECT event_id, row_number() OVER (ORDER BY ts, event_id) + 99 AS counter FROM events"
)
def surrogate_counter(t: Tables) -> DataFrame:
    return skew.number_by(t.events.select("ts", "event_id"), ["ts", "event_id"], "counter", 100).drop("ts")


@query(
    """SELECT count(*) AS records, cast(1 AS bigint) AS first_id, count(*) AS last_id, count(*) AS ids FROM lineitem"""
)
def arrival_numbering(t: Tables) -> DataFrame:
    """Numbers in arrival order: consecutive from 1 whatever the partitions."""
    numbered = skew.number_arrivals(t.lineitem.select("l_orderkey", "l_partkey"), "rec_id")
    return numbered.agg(
        F.count(F.lit(1)).alias("records"),
        F.min("rec_id").alias("first_id"),
        F.max("rec_id").alias("last_id"),
        F.count_distinct("rec_id").alias("ids"),
    )


@query(
    f"""SELECT {LINE_SQL}, dense_rank() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_partkey, l_suppkey) AS ranking FROM lineitem"""
)
def dup_rank_usage(t: Tables) -> DataFrame:
    return skew.dense_rank_by(
        _lines(t), ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey"], "ranking"
    ).withColumn("ranking", F.col("ranking").cast("long"))


@query(
    """SELECT l_orderkey, l_partkey, l_linenumber, l_returnflag, dense_rank() OVER
    (PARTITION BY l_returnflag ORDER BY l_orderkey, l_partkey) AS ranking FROM lineitem"""
)
def dup_rank_hot_keys(t: Tables) -> DataFrame:
    """Three keys with a third of the rows each, ranked in pieces."""
    lines = t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_returnflag")
    return skew.dense_rank_by(
        lines, ["l_returnflag"], ["l_orderkey", "l_partkey"], "ranking", hot_rows=1_000
    ).withColumn("ranking", F.col("ranking").cast("long"))


_EVENT_KEYS = """keyed AS (SELECT rec_id, msisdn, delta_balance, substr(timestamp, 1, 8) AS day FROM recharges)"""


@query(
    with_feeds(
        ["recharges"],
        f"""{_EVENT_KEYS}, ranked AS (SELECT *, dense_rank() OVER (PARTITION BY day, msisdn, delta_balance ORDER BY rec_id)
        AS r FROM keyed) SELECT rec_id, r, CASE WHEN r > 1 THEN 'DUP' ELSE 'NODUP' END AS status,
        CASE WHEN r > 1 THEN 'DUP02' ELSE 'UNIQUE' END AS route FROM ranked""",
    )
)
def dup_rank_recharge(t: Tables) -> DataFrame:
    keyed = t.feed("recharges").select(
        "rec_id", "msisdn", "delta_balance", F.substring("timestamp", 1, 8).alias("timestamp_r")
    )
    feed = keyed.withColumns(
        {
            "account": F.lit("a"),
            "event_date": F.col("timestamp_r"),
            "filename": F.lit("f"),
            "status": F.lit(duplicates.NODUP),
        }
    )
    routed = duplicates.route_recharge_duplicates(feed, ["msisdn", "delta_balance", "timestamp_r"])
    return routed.select("rec_id", F.col("r").cast("long").alias("r"), "status", "route")


@query(
    f"""SELECT {LINE_SQL}, dense_rank() OVER (PARTITION BY l_orderkey ORDER BY {', '.join(LINE[1:])}) AS ranking
    FROM lineitem"""
)
def dup_rank_fanout(t: Tables) -> DataFrame:
    return skew.dense_rank_by(_lines(t), ["l_orderkey"], LINE[1:], "ranking").withColumn(
        "ranking", F.col("ranking").cast("long")
    )


@query(
    f"""ranked AS (SELECT {LINE_SQL}, dense_rank() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey)
    AS ranking FROM lineitem) SELECT CASE WHEN ranking = 1 THEN 'first' ELSE 'rest' END AS side, count(*) AS records,
    round(sum(l_quantity), 2) AS quantity FROM ranked GROUP BY 1""".replace("ranked AS", "WITH ranked AS", 1)
)
def rank_filters(t: Tables) -> DataFrame:
    ranked = duplicates.mark_duplicates(
        _lines(t), ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey"], status=None
    )
    first = ranked.filter(F.col("ranking") == 1).withColumn("side", F.lit("first"))
    rest = ranked.filter(F.col("ranking") != 1).withColumn("side", F.lit("rest"))
    return first.unionByName(rest).groupBy("side").agg(
        F.count(F.lit(1)).alias("records"), F.round(F.sum("l_quantity"), 2).alias("quantity")
    )


@query(
    f"""SELECT {LINE_SQL} FROM (SELECT {LINE_SQL}, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_extendedprice, l_partkey, l_suppkey, l_quantity, l_discount, l_tax) AS rn FROM lineitem) AS numbered
    WHERE rn = 1"""
)
def dedup_keep_one(t: Tables) -> DataFrame:
    return skew.keep_one(_lines(t), ["l_orderkey", "l_linenumber"], ["l_extendedprice"])


@query(
    """SELECT l_orderkey, discount, l_partkey, l_suppkey FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey
    ORDER BY discount NULLS LAST, l_partkey, l_suppkey) AS rn FROM (SELECT l_orderkey, l_partkey, l_suppkey,
    CASE WHEN l_discount >= 0.02 THEN l_discount END AS discount FROM lineitem)) WHERE rn = 1"""
)
def dedup_filled_first(t: Tables) -> DataFrame:
    """A filled value goes before a null, also where the null is the smaller."""
    gaps = t.lineitem.select(
        "l_orderkey", "l_partkey", "l_suppkey", F.when(F.col("l_discount") >= 0.02, F.col("l_discount")).alias("discount")
    )
    return skew.keep_one(gaps, ["l_orderkey"], ["discount"])


@query(
    with_feeds(
        ["usage_feed"],
        """SELECT rec_id, CASE WHEN service_filter LIKE '%GPRS%' THEN '' ELSE b_party END AS key_b_party,
        CASE WHEN service_filter LIKE '%GPRS%' THEN '0' ELSE callduration END AS key_call_duration,
        CASE WHEN service_filter LIKE '%GPRS%' THEN chargingid ELSE '' END AS key_charging_id,
        CASE WHEN service_filter LIKE '%GPRS%' THEN total_volume ELSE '0' END AS key_total_volume FROM usage_feed""",
    )
)
def dedup_key_columns(t: Tables) -> DataFrame:
    return t.feed("usage_feed").select(
        "rec_id",
        *[c.alias(k) for k, c in duplicates.dedup_keys(call_duration="callduration").items()],
    )


def _segment(t: Tables) -> DataFrame:
    """Customers with gaps of each kind: null, blank and sentinel."""
    segment = F.nullif(F.col("c_mktsegment"), F.lit("MACHINERY"))
    return t.customer.select(
        "c_custkey",
        segment.alias("segment"),
        F.when(F.col("c_acctbal") < 0, F.lit("  ")).otherwise(F.col("c_name")).alias("name"),
        F.when(F.col("c_acctbal") > 9000, F.lit(NOT_QUALIFIED))
        .otherwise(F.col("c_nationkey").cast("string"))
        .alias("nation"),
    )


_SEGMENT = """gaps AS (SELECT c_custkey, nullif(c_mktsegment, 'MACHINERY') AS segment,
    CASE WHEN c_acctbal < 0 THEN '  ' ELSE c_name END AS name,
    CASE WHEN c_acctbal > 9000 THEN 'NQ' ELSE cast(c_nationkey AS string) END AS nation FROM customer)"""


@query(
    f"""WITH {_SEGMENT} SELECT c_custkey, CASE WHEN segment IS NULL OR trim(segment) = '' OR segment = 'BUILDING'
    OR name IS NULL OR trim(name) = '' OR name = '-99' OR nation IS NULL OR trim(nation) = '' OR nation = 'NQ'
    THEN 'REJECT' ELSE 'GOOD' END AS status_data FROM gaps"""
)
def reject_any_missing(t: Tables) -> DataFrame:
    return quality.reject_if_any_missing(
        _segment(t), {"segment": "BUILDING", "name": "-99", "nation": "NQ"}
    ).select("c_custkey", "status_data")


@query(
    f"""WITH {_SEGMENT} SELECT c_custkey, CASE WHEN coalesce(segment, nation) IS NULL
    OR coalesce(segment, nation) IN ('NQ', '-99') THEN 'YES' ELSE 'NO' END AS status_reject FROM gaps"""
)
def reject_coalesced(t: Tables) -> DataFrame:
    return quality.reject_if_first_missing(_segment(t), ["segment", "nation"]).select(
        "c_custkey", "status_reject"
    )


@query(
    f"""WITH {_SEGMENT} SELECT c_custkey, CASE WHEN segment IS NOT NULL AND nullif(nation, 'NQ') IS NOT NULL
    THEN 'GOOD' ELSE 'REJECT' END AS status_reject FROM gaps"""
)
def good_all_present(t: Tables) -> DataFrame:
    present: Column = F.nullif(F.col("nation"), F.lit(NOT_QUALIFIED))
    return quality.good_if_all_present(
        _segment(t).withColumn("nation", present), ["segment", "nation"]
    ).select("c_custkey", "status_reject")


@query(
    """SELECT replace(substr(cast(o_orderdate AS string), 1, 10), '-', '') AS periode, 'orders' AS filename,
    'J1' AS job_id, '1' AS group_process, CASE WHEN o_orderstatus = 'P' THEN 'REJECT' ELSE 'GOOD' END AS status_data,
    'NODUP' AS status, count(*) AS qty, round(cast(sum(cast(o_totalprice AS decimal(18,2))) AS double), 2) AS rev,
    'ORDERS' AS filetype FROM orders GROUP BY 1, 5"""
)
def control_totals(t: Tables) -> DataFrame:
    orders = t.orders.select(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("event_date"),
        F.lit("orders").alias("filename"),
        F.when(F.col("o_orderstatus") == "P", F.lit("REJECT")).otherwise(F.lit("GOOD")).alias("status_data"),
        F.lit(duplicates.NODUP).alias("status"),
        "o_totalprice",
    )
    return quality.control_totals(
        orders, amount="o_totalprice", job_id="J1", group_process="1", filetype="ORDERS"
    ).withColumn("rev", F.round("rev", 2))


@query("SELECT event_type AS route, count(*) AS records FROM events GROUP BY event_type")
def route_counts(t: Tables) -> DataFrame:
    return quality.route_counts(t.events.withColumnRenamed("event_type", "route"), "route")
