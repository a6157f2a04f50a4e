"""Daily merge of the per-subscriber location state."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sentinels import BLANK, ZERO

# State column (without its block prefix) -> column of the daily feed.
DAILY_SOURCES: Mapping[str, str] = {
    "lacci_id": "lacci_id",
    "area_name": "lacci_area_name",
    "region_network": "lacci_region_network",
    "cluster_sales": "lacci_cluster_sales",
    "site_id": "lacci_site_id",
    "node": "lacci_node",
    "provinsi": "lacci_provinsi",
    "kabupaten": "lacci_kabupaten",
    "kecamatan": "lacci_kecamatan",
    "kelurahan": "lacci_kelurahan",
    "region_sales": "lacci_region_sales",
    "branch": "lacci_branch",
    "subbranch": "lacci_subbranch",
}
KEYS = ("msisdn", "subs_id")


def merge_daily_state(
    state: DataFrame, daily: DataFrame, sources: Mapping[str, str] = DAILY_SOURCES
) -> DataFrame:
    """Full outer merge on (subs_id, msisdn).

    ``chg_``: the day's value where there is one, else the state's. ``usg_``:
    the state's, blank for a new subscriber. ``ifrs_``: the day's for a known
    subscriber, blank for a new one, else the state's. Flags are "1" for the
    day's subscribers (``chg``) or new ones, default "0".
    """
    blocks = ("chg", "usg", "ifrs")
    a = daily.select(*[F.col(c).alias(f"_a_{c}") for c in dict.fromkeys([*KEYS, *sources.values()])])
    b = state.select(
        *[F.col(c).alias(f"_b_{c}") for c in KEYS],
        *[F.col(f"{p}_{c}").alias(f"_b_{p}_{c}") for p in blocks for c in [*sources, "flag"]],
    )
    # Rows without a subscriber match nothing: they bypass the join.
    keyed = [df.filter(F.col(c).isNotNull()) for df, c in ((a, "_a_subs_id"), (b, "_b_subs_id"))]
    alone = [df.filter(F.col(c).isNull()) for df, c in ((a, "_a_subs_id"), (b, "_b_subs_id"))]
    same = (F.col("_a_subs_id") == F.col("_b_subs_id")) & (F.col("_a_msisdn") == F.col("_b_msisdn"))
    joined = keyed[0].join(keyed[1], same, "full_outer")
    for rows in alone:
        joined = joined.unionByName(rows, allowMissingColumns=True)
    on_day = F.col("_a_subs_id").isNotNull() & F.col("_a_msisdn").isNotNull()
    known = on_day & F.col("_b_subs_id").isNotNull()

    def choose(matched: Column, new: Column, old: Column) -> Column:
        return F.when(known, matched).when(on_day, new).otherwise(old)

    out = {c: F.when(on_day, F.col(f"_a_{c}")).otherwise(F.col(f"_b_{c}")) for c in KEYS}
    blank, one = F.lit(BLANK), F.lit("1")
    for c, source in sources.items():
        day = F.col(f"_a_{source}")
        out[f"chg_{c}"] = choose(day, day, F.col(f"_b_chg_{c}"))
        out[f"usg_{c}"] = choose(F.col(f"_b_usg_{c}"), blank, F.col(f"_b_usg_{c}"))
        out[f"ifrs_{c}"] = choose(day, blank, F.col(f"_b_ifrs_{c}"))
    for p in blocks:
        old = F.col(f"_b_{p}_flag")
        out[f"{p}_flag"] = F.coalesce(choose(one if p == "chg" else old, one, old), F.lit(ZERO))
    order = [*KEYS, *[f"{p}_{c}" for p in blocks for c in [*sources, "flag"]]]
    return joined.select(*[out[c].alias(c) for c in order])


# What the state table is bucketed by. Subscribers are unique in it but for
# their numbers, so buckets are even.
BUCKET_KEY = "subs_id"


def write_state(state: DataFrame, table: str, buckets: int) -> None:
    """Write a state table in buckets by subscriber, for merges to come."""
    writer = state.write.bucketBy(buckets, BUCKET_KEY).sortBy(*reversed(KEYS))
    writer.format("parquet").mode("overwrite").saveAsTable(table)


def advance_state(
    spark: SparkSession,
    table: str,
    daily: DataFrame,
    new_table: str,
    buckets: int,
    sources: Mapping[str, str] = DAILY_SOURCES,
) -> DataFrame:
    """Merge a day into the state ``table`` and write ``new_table`` in the same
    buckets (a table of its own: a run that fails leaves the old one).

    The state is read bucket by bucket and never shuffled; only the day's
    records are, to the buckets of their subscribers. What each task merges is
    one bucket, which it writes as one file.
    """
    write_state(merge_daily_state(spark.read.table(table), daily, sources), new_table, buckets)
    return spark.read.table(new_table)
