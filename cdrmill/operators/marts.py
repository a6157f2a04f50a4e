"""Aggregated outputs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.amounts import number, total
from ..functions.text import as_col, fixed, null_to
from ..sentinels import BLANK, NOT_QUALIFIED, UNKNOWN, ZERO
from .early_sums import sum_through_lookup
from .product import map_values
from .skew import HOT_ROWS

# Digits of a phone number that its prefix has.
PREFIX_WIDTH = 8

# Spellings of a region and its mart name.
REGION_NAMES = {
    "Bali-Nusra": "BALINUSRA",
    "BALI NUSRA": "BALINUSRA",
    "Jabar-Banten": "JABAR",
    "Jateng-Jogya": "JATENG",
    "Jawa-Timur": "JATIM",
    "Kalimantan": "KALIMANTAN",
    "Papua": "PAPUA",
    "PUMA": "PAPUA",
    "SumBagUtara": "SUMBAGUT",
    "Jabotabek": "JABOTABEK",
}

HLR_KEYS = (
    "trx_year", "trx_month", "trx_date", "brand", "l3_cd", "area_hlr", "region_hlr", "city_hlr",
    "l1_name", "l2_name", "l3_name", "event_date", "source_name",
)
HLR_SUMS = ("tot_user", "tot_dur", "tot_rev", "tot_trx")
VLR_KEYS = (
    "file_date", "area", "region", "cluster", "brand", "l1_name", "l2_name", "l3_name",
    "offer_name", "node", "cust_type", "cust_subtype", "cust_subsegment", "event_date", "source_name",
)
VLR_SUMS = ("tot_rev", "tot_trx", "tot_dur")


def normalise_region(region: Column | str) -> Column:
    return map_values(region, REGION_NAMES)


def present(c: Column | str) -> Column:
    c = as_col(c)
    return c.isNotNull() & (c != NOT_QUALIFIED)


def gated(value: Column | str, gate: Column) -> Column:
    return F.when(gate, as_col(value)).otherwise(F.lit(UNKNOWN))


def customer_type(subtype: Column | str) -> Column:
    return F.when(as_col(subtype) == UNKNOWN, F.lit("B2C")).otherwise(F.lit("B2B"))


# Mart keys that come out of the phone prefix, and what they are made of.
PREFIX_COLUMNS = ("area", "area_name", "regional")


def prefix_keys() -> dict[str, Column]:
    """Area, and home area, region and city of a record looked up by prefix:
    columns ``_p_<name>`` and ``_p_found``."""
    area, regional, found = F.col("_p_area_name"), F.col("_p_regional"), F.col("_p_found")
    return {
        "area": F.col("_p_area"),
        "area_hlr": gated(area, found & present(area)),
        "region_hlr": gated(normalise_region(regional), found & present(regional)),
        "city_hlr": gated(regional, present(regional)),
    }


def mart_records(revenue: DataFrame) -> DataFrame:
    """Merged revenue in the marts' own columns, and ``_prefix`` to look up."""
    return revenue.select(
        F.col("trx_date").alias("file_date"),
        fixed("trx_date", 1, 4).alias("trx_year"),
        fixed("trx_date", 5, 2).alias("trx_month"),
        "trx_date",
        "brand",
        F.lit(BLANK).alias("l3_cd"),
        "l1_name",
        "l2_name",
        "l3_name",
        F.col("region_sales").alias("region"),
        F.col("cluster_sales").alias("cluster"),
        "offer_name",
        F.lit(BLANK).alias("node"),
        customer_type("cust_subtype_desc").alias("cust_type"),
        F.col("cust_type_desc").alias("cust_subtype"),
        F.col("cust_subtype_desc").alias("cust_subsegment"),
        F.lit(0).alias("tot_user"),
        (number(null_to("vol", ZERO)) + number(null_to("dur", ZERO))).alias("tot_dur"),
        number("rev").alias("tot_rev"),
        number("trx").alias("tot_trx"),
        F.col("trx_date").alias("event_date"),
        F.concat(F.lit("SA_"), F.col("source_name")).alias("source_name"),
        fixed("msisdn", 1, PREFIX_WIDTH).alias("_prefix"),
    )


def revenue_mart(
    records: DataFrame,
    prefixes: DataFrame,
    keys: Sequence[str],
    sums: Sequence[str],
    *,
    unique: bool = True,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """One mart of ``mart_records``; without ``unique`` each row of a prefix
    multiplies its records."""
    derived = {name: value for name, value in prefix_keys().items() if name in keys}
    return sum_through_lookup(
        records,
        prefixes,
        {"_prefix": "enriched_prefix"},
        {f"_p_{c}": c for c in PREFIX_COLUMNS},
        derived,
        keys,
        sums,
        hit="_p_found",
        unique=unique,
        hot_rows=hot_rows,
    )


def hlr_mart(records: DataFrame, prefixes: DataFrame, **options) -> DataFrame:
    return revenue_mart(records, prefixes, HLR_KEYS, HLR_SUMS, **options)


def vlr_mart(records: DataFrame, prefixes: DataFrame, **options) -> DataFrame:
    return revenue_mart(records, prefixes, VLR_KEYS, VLR_SUMS, **options)


# --- Recharge ---------------------------------------------------------------

# Output name -> input column of the hourly recharge roll-up.
ROLLUP_KEYS: Mapping[str, str] = {
    **{
        c: c
        for c in (
            "trx_date", "trx_hour", "subs_id", "msisdn", "cust_type_desc", "cust_subtype_desc",
        )
    },
    "offer_id": "provider_id",
    **{
        c: c
        for c in (
            "lacci_id", "lac", "ci", "area_sales", "region_sales", "branch", "subbranch",
            "cluster_sales", "provinsi", "kabupaten", "kecamatan", "kelurahan", "node_type",
            "lacci_closing_flag",
        )
    },
    "credit_debit_code": "credit_indicator",
    **{c: c for c in ("split_code", "brand", "load_ts", "load_user", "indicator_4g")},
}
ROLLUP_COLUMNS = (
    "trx_date", "trx_hour", "subs_id", "msisdn", "cust_type_desc", "cust_subtype_desc", "offer_id",
    "lacci_id", "lac", "ci", "area_sales", "region_sales", "branch", "subbranch", "cluster_sales",
    "provinsi", "kabupaten", "kecamatan", "kelurahan", "node_type", "lacci_closing_flag",
    "credit_debit_code", "split_code", "brand", "trx", "recharge_amount", "load_ts", "load_user",
    "job_id", "indicator_4g", "event_date", "load_date",
)


def recharge_rollup(df: DataFrame, *, event_date: str, load_date: str) -> DataFrame:
    """Recharges and their amount per subscriber, hour, location and kind."""
    return (
        df.groupBy(*[F.col(source).alias(name) for name, source in ROLLUP_KEYS.items()])
        .agg(
            F.count(F.lit(1)).cast("double").alias("trx"),
            total(null_to("recharge_amount", ZERO)).alias("recharge_amount"),
        )
        .withColumns(
            {
                "job_id": F.col("load_ts"),
                "event_date": F.lit(event_date),
                "load_date": F.lit(load_date),
            }
        )
        .select(*ROLLUP_COLUMNS)
    )


REGION_COLUMNS = (
    "lacci_id", "node_type", "area_sales", "region_sales", "branch", "subbranch", "cluster_sales",
    "provinsi", "kabupaten", "kecamatan", "kelurahan",
)


def propagate_unknown_region(
    df: DataFrame, columns: Sequence[str] = REGION_COLUMNS, region: str = "region_sales"
) -> DataFrame:
    """An UNKNOWN region makes every location column UNKNOWN.

    The literal chain overwrites the region in between, with itself; so one
    test serves all columns.
    """
    unknown = F.col(region) == UNKNOWN
    return df.withColumns(
        {c: F.when(unknown, F.lit(UNKNOWN)).otherwise(F.col(c)) for c in columns}
    )


# What a fee recharge counts as in merged revenue.
RECHARGE_TAXONOMY = {
    "l1_name": "Digital Services",
    "l2_name": "Transfer Pulsa",
    "l3_name": "Simpati",
    "l4_name": "SA_50007",
}
RECHARGE_CUSTOMER = {"cust_type_desc": "B2C", "cust_subtype_desc": "NON HVC"}

MERGE_KEYS = (
    "trx_date", "msisdn", "subs_id", "lacci_id", "node_type", "area_sales", "region_sales", "branch",
    "subbranch", "cluster_sales", "provinsi", "kabupaten", "kecamatan", "kelurahan", "indicator_4g",
    "lacci_closing_flag", "mm_closing_flag", "l1_name", "l2_name", "l3_name", "l4_name", "offer_id",
    "offer_name", "brand", "cust_type_desc", "cust_subtype_desc", "service_filter", "payment_channel",
    "source_name", "load_ts", "event_date", "load_date",
)
MERGE_COLUMNS = (*MERGE_KEYS[:28], "trx", "rev", "dur", "vol", *MERGE_KEYS[28:])


def recharge_to_revenue(df: DataFrame, *, load_date: str) -> DataFrame:
    """Recharge records in the shape of merged revenue."""
    good = F.col("status_data") == "GOOD"
    constants = {
        "mm_closing_flag": "1",
        "offer_name": BLANK,
        "service_filter": BLANK,
        "payment_channel": BLANK,
        "load_date": load_date,
        **RECHARGE_TAXONOMY,
        **RECHARGE_CUSTOMER,
    }
    return propagate_unknown_region(df).withColumns(
        {
            **{c: F.lit(v) for c, v in constants.items()},
            "source_name": F.when(good, F.lit("RCG_GOOD")).otherwise(F.lit("RCG_REJECT")),
            "event_date": F.when(good, F.col("trx_date")).otherwise(F.col("event_date")),
        }
    )


def recharge_revenue(df: DataFrame) -> DataFrame:
    """Merged recharge revenue, good and reject in one pass by ``source_name``."""
    return (
        df.groupBy(*MERGE_KEYS)
        .agg(
            F.count(F.lit(1)).alias("trx"),
            F.sum("recharge_amount").alias("rev"),
            F.lit(0.0).alias("dur"),
            F.lit(0.0).alias("vol"),
        )
        .select(*MERGE_COLUMNS)
    )
