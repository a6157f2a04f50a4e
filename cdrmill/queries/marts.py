"""Aggregated outputs and the daily state."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import marts, state
from ..operators.early_sums import sum_through_lookup
from ..plans.daily_state import daily_state_job
from ..plans.revenue import revenue_job
from ..plans.run import RunInfo
from ..sentinels import UNKNOWN
from ..session import scratch_dir
from ..sources import writers
from .base import Registry, Tables, with_feeds
from .lookups import ONE_PREFIX, REGION_CASE

registry = Registry()
query = registry.add


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 2) for c in columns})


@query(
    """SELECT r_name AS region_sales, n_name AS branch, count(*) AS trx,
    round(cast(sum(cast(o_totalprice AS decimal(18,2))) AS double), 2) AS rev
    FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
    JOIN region ON r_regionkey = n_regionkey WHERE c_mktsegment <> 'MACHINERY' GROUP BY r_name, n_name
    UNION ALL SELECT 'UNKNOWN', 'UNKNOWN', count(*), round(cast(sum(cast(o_totalprice AS decimal(18,2))) AS double), 2)
    FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_mktsegment = 'MACHINERY'"""
)
def region_revenue(t: Tables) -> DataFrame:
    """Order revenue by the subscriber's region; unknown subscribers apart."""
    subscribers = (
        t.customer.filter(F.col("c_mktsegment") != "MACHINERY")
        .join(t.nation, F.col("n_nationkey") == F.col("c_nationkey"))
        .join(t.region, F.col("r_regionkey") == F.col("n_regionkey"))
        .select("c_custkey", F.col("r_name").alias("region_sales"), F.col("n_name").alias("branch"))
    )
    orders = t.orders.select("o_custkey", F.lit(1).alias("trx"), F.col("o_totalprice").alias("rev"))
    names = ("region_sales", "branch")
    summed = sum_through_lookup(
        orders,
        subscribers,
        {"o_custkey": "c_custkey"},
        {f"_{c}": c for c in names},
        {c: F.when(F.col("_found"), F.col(f"_{c}")).otherwise(F.lit(UNKNOWN)) for c in names},
        names,
        ("trx", "rev"),
        hit="_found",
    )
    return summed.withColumn("rev", F.round("rev", 2))


_FACTS = f"""{ONE_PREFIX}, facts AS (SELECT trx_date AS file_date, substr(trx_date, 1, 4) AS trx_year,
    substr(trx_date, 5, 2) AS trx_month, trx_date, brand, '' AS l3_cd,
    CASE WHEN p.enriched_prefix IS NOT NULL AND area_name <> 'NQ' THEN area_name ELSE 'UNKNOWN' END AS area_hlr,
    CASE WHEN p.enriched_prefix IS NOT NULL AND regional <> 'NQ' THEN {REGION_CASE} ELSE 'UNKNOWN' END AS region_hlr,
    CASE WHEN regional <> 'NQ' THEN regional ELSE 'UNKNOWN' END AS city_hlr, l1_name, l2_name, l3_name, area,
    region_sales AS region, cluster_sales AS cluster, offer_name, '' AS node,
    CASE WHEN cust_subtype_desc = 'UNKNOWN' THEN 'B2C' ELSE 'B2B' END AS cust_type, cust_type_desc AS cust_subtype,
    cust_subtype_desc AS cust_subsegment, 0 AS tot_user,
    cast(coalesce(vol, '0') AS double) + cast(coalesce(dur, '0') AS double) AS tot_dur,
    cast(rev AS decimal(18,2)) AS tot_rev, cast(trx AS double) AS tot_trx, trx_date AS event_date,
    'SA_' || source_name AS source_name FROM revenue LEFT JOIN one_prefix p ON p.enriched_prefix = substr(msisdn, 1, 8))"""
_SUMS = {
    "tot_user": "cast(sum(tot_user) AS bigint) AS tot_user",
    "tot_dur": "sum(tot_dur) AS tot_dur",
    "tot_rev": "round(cast(sum(tot_rev) AS double), 2) AS tot_rev",
    "tot_trx": "sum(tot_trx) AS tot_trx",
}


def _mart_sql(keys: tuple[str, ...], sums: tuple[str, ...]) -> str:
    listed = ", ".join(keys)
    return with_feeds(
        ["revenue", "prefixes"],
        f"{_FACTS} SELECT {listed}, {', '.join(_SUMS[c] for c in sums)} FROM facts GROUP BY {listed}",
    )


@query(_mart_sql(marts.HLR_KEYS, marts.HLR_SUMS))
def mart_hlr(t: Tables) -> DataFrame:
    return _rounded(revenue_job(t.feed("revenue"), t.feed("prefixes"))["HLR"], "tot_rev")


@query(_mart_sql(marts.VLR_KEYS, marts.VLR_SUMS))
def mart_vlr(t: Tables) -> DataFrame:
    return _rounded(revenue_job(t.feed("revenue"), t.feed("prefixes"))["VLR"], "tot_rev")


_ROLLUP = ", ".join(f"{source} AS {name}" for name, source in marts.ROLLUP_KEYS.items())


@query(
    with_feeds(
        ["recharge_hourly"],
        f"""SELECT {_ROLLUP}, cast(count(*) AS double) AS trx,
        round(cast(sum(cast(coalesce(recharge_amount, '0') AS decimal(18,2))) AS double), 2) AS recharge_amount,
        load_ts AS job_id, '2023-02-22' AS event_date, '20230222' AS load_date FROM recharge_hourly
        GROUP BY {', '.join(marts.ROLLUP_KEYS.values())}""",
    )
)
def recharge_rollup(t: Tables) -> DataFrame:
    rolled = marts.recharge_rollup(
        t.feed("recharge_hourly"), event_date="2023-02-22", load_date="20230222"
    )
    return _rounded(rolled, "recharge_amount")


@query(
    with_feeds(
        ["locations"],
        """SELECT lacci_id AS k, CASE WHEN region_sales = 'UNKNOWN' THEN 'UNKNOWN' ELSE lacci_id END AS lacci_id,
        CASE WHEN region_sales = 'UNKNOWN' THEN 'UNKNOWN' ELSE branch END AS branch, region_sales,
        CASE WHEN region_sales = 'UNKNOWN' THEN 'UNKNOWN' ELSE kelurahan END AS kelurahan FROM locations""",
    )
)
def unknown_region(t: Tables) -> DataFrame:
    cells = t.feed("locations").select(F.col("lacci_id").alias("k"), "lacci_id", "branch", "region_sales", "kelurahan")
    return marts.propagate_unknown_region(cells, ["lacci_id", "branch", "region_sales", "kelurahan"])


@query(
    f"""SELECT n_name AS k, {REGION_CASE} AS region, CASE WHEN c_mktsegment = 'UNKNOWN' THEN 'B2C' ELSE 'B2B' END AS cust_type
    FROM (SELECT n_name, coalesce(nullif(c_mktsegment, 'BUILDING'), 'UNKNOWN') AS c_mktsegment,
    CASE n_regionkey WHEN 0 THEN 'Bali-Nusra' WHEN 1 THEN 'BALI NUSRA' WHEN 2 THEN 'Jabar-Banten' WHEN 3 THEN 'Papua'
    ELSE n_name END AS regional FROM customer JOIN nation ON n_nationkey = c_nationkey) AS regions"""
)
def region_synonyms(t: Tables) -> DataFrame:
    regional = (
        F.when(F.col("n_regionkey") == 0, F.lit("Bali-Nusra"))
        .when(F.col("n_regionkey") == 1, F.lit("BALI NUSRA"))
        .when(F.col("n_regionkey") == 2, F.lit("Jabar-Banten"))
        .when(F.col("n_regionkey") == 3, F.lit("Papua"))
        .otherwise(F.col("n_name"))
    )
    segment = F.coalesce(F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")), F.lit("UNKNOWN"))
    customers = t.customer.join(t.nation, F.col("n_nationkey") == F.col("c_nationkey"))
    return customers.select(
        F.col("n_name").alias("k"),
        marts.normalise_region(regional).alias("region"),
        marts.customer_type(segment).alias("cust_type"),
    )


def _state_sql() -> str:
    both = "d.subs_id IS NOT NULL AND d.msisdn IS NOT NULL"
    known = f"{both} AND s.subs_id IS NOT NULL"
    columns = [f"CASE WHEN {both} THEN d.{k} ELSE s.{k} END AS {k}" for k in state.KEYS]
    for name, source in state.DAILY_SOURCES.items():
        columns += [
            f"CASE WHEN {both} THEN d.{source} ELSE s.chg_{name} END AS chg_{name}",
            f"CASE WHEN {known} THEN s.usg_{name} WHEN {both} THEN '' ELSE s.usg_{name} END AS usg_{name}",
            f"CASE WHEN {known} THEN d.{source} WHEN {both} THEN '' ELSE s.ifrs_{name} END AS ifrs_{name}",
        ]
    columns.append(f"coalesce(CASE WHEN {both} THEN '1' ELSE s.chg_flag END, '0') AS chg_flag")
    columns += [
        f"coalesce(CASE WHEN {known} THEN s.{p}_flag WHEN {both} THEN '1' ELSE s.{p}_flag END, '0') AS {p}_flag"
        for p in ("usg", "ifrs")
    ]
    return with_feeds(
        ["state", "daily"],
        f"SELECT {', '.join(columns)}, '20230120' AS event_date, 'J2' AS job_id FROM daily d FULL OUTER JOIN state s "
        "ON d.subs_id = s.subs_id AND d.msisdn = s.msisdn",
    )


@query(_state_sql())
def full_outer_merge(t: Tables) -> DataFrame:
    run = RunInfo(filename="daily", load_ts="", job_id="J2", event_date="20230120")
    return daily_state_job(t.feed("state"), t.feed("daily"), run)


@query(_state_sql())
def bucketed_state_merge(t: Tables) -> DataFrame:
    """The same merge over a state table kept in buckets."""
    writers.create_database(t.spark, "cdrmill", f"{scratch_dir(t.spark)}/warehouse")
    names = [f"cdrmill.state_{uuid.uuid4().hex}" for _ in range(2)]
    buckets = t.spark.sparkContext.defaultParallelism
    state.write_state(t.feed("state"), names[0], buckets)
    merged = state.advance_state(t.spark, names[0], t.feed("daily"), names[1], buckets)
    return merged.withColumns({"event_date": F.lit("20230120"), "job_id": F.lit("J2")})
