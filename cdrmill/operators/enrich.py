"""Subscriber, history and phone-prefix enrichment."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import fixed, null_to
from ..sentinels import BLANK, FLAG_DIRECT, FLAG_MM, FLAG_MTD, MISSING_ID, UNKNOWN, ZERO
from .lookup import lookup
from .salted import KeyCounts, add_salt, is_small
from .skew import HOT_ROWS

SUBSCRIBER_COLUMNS = ("subs_id", "cust_type_desc", "cust_subtype_desc")

# Default of each history column for a subscriber without
# history. The key is the part after "mtd_" / "mm_".
HISTORY_DEFAULTS = {
    "lacci_id": MISSING_ID,
    "area_name": UNKNOWN,
    "region_network": BLANK,
    "cluster_sales": BLANK,
    "lac": BLANK,
    "ci": BLANK,
    "node": BLANK,
    "region_sales": BLANK,
    "branch": BLANK,
    "subbranch": BLANK,
    "provinsi": MISSING_ID,
    "kabupaten": BLANK,
    "kecamatan": BLANK,
    "kelurahan": BLANK,
}


def enrich_subscriber(
    df: DataFrame,
    subscribers: DataFrame,
    defaults: Mapping[str, str],
    *,
    key: str = "msisdn",
    dim_key: str = "msisdn",
    null_attributes_too: bool = False,
    unique: bool = True,
    prefer: Sequence[str] = (),
    spread_by: Sequence[str] = (),
    counts: KeyCounts | None = None,
) -> DataFrame:
    """Add the subscriber columns named in ``defaults``.

    A record without a subscriber gets the defaults. ``null_attributes_too``
    also replaces null attributes of a subscriber that was found.
    """
    found = lookup(
        df,
        subscribers,
        {key: dim_key},
        {c: c for c in defaults},
        hit="_found",
        unique=unique,
        prefer=prefer,
        spread_by=spread_by,
        counts=counts,
    )
    values = {}
    for c, default in defaults.items():
        if null_attributes_too:
            values[c] = null_to(c, default)
        else:
            values[c] = F.when(F.col("_found"), F.col(c)).otherwise(F.lit(default))
    return found.withColumns(values).drop("_found")


def enrich_dominant_location(
    df: DataFrame,
    history: DataFrame,
    prefix: str,
    on: Mapping[str, str],
    columns: Mapping[str, str],
    *,
    unique: bool = True,
    take_also: Mapping[str, str] | None = None,
    counts: KeyCounts | None = None,
) -> DataFrame:
    """Add one history block: ``<prefix>_lacci_id``, ... and ``<prefix>_flag``.

    ``columns`` maps the names of HISTORY_DEFAULTS to the columns of
    ``history``. ``take_also`` adds further history columns without a default.
    """
    take = {f"{prefix}_{name}": source for name, source in columns.items()}
    found = lookup(
        df, history, on, {**take, **(take_also or {})}, hit="_found", unique=unique, counts=counts
    )
    values = {
        f"{prefix}_{name}": F.when(F.col("_found"), F.col(f"{prefix}_{name}")).otherwise(
            F.lit(HISTORY_DEFAULTS[name])
        )
        for name in columns
    }
    values[f"{prefix}_flag"] = F.when(F.col("_found"), F.lit("1")).otherwise(F.lit(ZERO))
    return found.withColumns(values).drop("_found")


def fill_location_from_history(
    df: DataFrame,
    mtd: DataFrame,
    mm: DataFrame,
    *,
    key: str = "subs_id",
    location: str = "trx_lacci",
    mtd_columns: tuple[str, str] = ("subs_id_mtd", "lacci_id_mtd"),
    mm_columns: tuple[str, str] = ("subs_id_mm", "lacci_id_mm"),
    blank_blocks: bool = False,
    flag_on_equal_id: bool = False,
    spread_by: Sequence[str] = (),
    counts: KeyCounts | None = None,
) -> DataFrame:
    """Fill a missing location from this month's, then last month's history.

    Adds ``find_flag``: "1#" or "2#" for a location out of history, "0" for the
    record's own (or none). The location defaults to "-99". Records of the
    unknown subscriber "-99" have no history. ``counts`` are those of ``key``.
    """
    own = F.nullif(F.col(location), F.lit("|"))
    if blank_blocks:
        own = F.when(F.col(location) == "|", F.lit(BLANK)).otherwise(F.col(location))
    else:
        own = F.nullif(own, F.lit(BLANK))
    both = df.withColumn("_subs", F.nullif(F.col(key), F.lit(MISSING_ID)))
    own_key = {"_subs": F.nullif(F.col(key), F.lit(MISSING_ID))}
    found_in = KeyCounts(both, ["_subs"]) if counts is None else KeyCounts(counts.rows, own_key, counts.hot_rows)
    if not (is_small(mtd) and is_small(mm)):
        both = add_salt(both, found_in, spread_by)
    for name, history, (subs, where) in (("_mtd", mtd, mtd_columns), ("_mm", mm, mm_columns)):
        both = lookup(both, history, {"_subs": subs}, {name: where}, counts=found_in)
    both = both.withColumn("_own", own).withColumn("_where", F.coalesce("_own", "_mtd", "_mm"))
    if flag_on_equal_id:
        from_mtd = F.col("_mtd") == F.col("_where")
        from_mm = F.col("_mm") == F.col("_where")
    else:
        from_mtd = F.col("_own").isNull() & F.col("_mtd").isNotNull()
        from_mm = F.col("_own").isNull() & F.col("_mm").isNotNull()
    flag = (
        F.when(from_mtd, F.lit(f"{FLAG_MTD}#"))
        .when(from_mm, F.lit(f"{FLAG_MM}#"))
        .otherwise(F.lit(FLAG_DIRECT))
    )
    return both.withColumns(
        {"find_flag": flag, location: null_to("_where", MISSING_ID)}
    ).drop("_subs", found_in.salt, "_mtd", "_mm", "_own", "_where")


def join_phone_prefix(
    df: DataFrame,
    prefixes: DataFrame,
    take: Mapping[str, str],
    *,
    phone: str = "msisdn",
    prefix: str = "enriched_prefix",
    width: int = 8,
    hit: str = "prefix_found",
    unique: bool = True,
    spread_by: Sequence[str] = (),
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Look up the first ``width`` digits of the phone number."""
    keyed = df.withColumn("_prefix", fixed(phone, 1, width))
    counts = KeyCounts(df, {"_prefix": fixed(phone, 1, width)}, hot_rows)
    options = {"hit": hit, "unique": unique, "spread_by": spread_by, "counts": counts}
    return lookup(keyed, prefixes, {"_prefix": prefix}, take, **options).drop("_prefix")
