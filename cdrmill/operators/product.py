"""Product taxonomy."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import as_col, fixed
from ..sentinels import BLANK, NOT_QUALIFIED
from .lookup import lookup
from .salted import KeyCounts
from .skew import HOT_ROWS, keep_one

LEVELS = ("l4_name", "l3_name", "l2_name", "l1_name")

# Service group of a service filter, by its prefix.
SERVICE_PREFIXES = {"1_": "s1", "2_": "s2", "3_": "s3", "5_": "s5"}
OTHER_SERVICE = "sR"


def resolve_offer(
    plan: Column | str,
    topping: Column | str,
    special_plan: str | None = None,
    special_offer: Column | str | None = None,
) -> Column:
    """The plan, else the topping; the ``special_plan`` points elsewhere."""
    offer = F.coalesce(as_col(plan), as_col(topping))
    if special_plan is None:
        return offer
    return F.when(as_col(plan) == special_plan, as_col(special_offer)).otherwise(offer)


def normalise_product_key(df: DataFrame, key: str = "rkey", mapping: str = "mapping_key_type") -> DataFrame:
    """A mapping key that is set replaces the product key."""
    return df.withColumn(key, F.coalesce(F.nullif(F.col(mapping), F.lit(BLANK)), F.col(key)))


def add_product(
    df: DataFrame,
    products: DataFrame,
    *,
    offer: str = "offer_id",
    levels: Sequence[str] = LEVELS,
    unique: bool = True,
    spread_by: Sequence[str] = (),
    counts: KeyCounts | None = None,
) -> DataFrame:
    """Taxonomy by offer, "NQ" where unknown; ``products`` is keyed by ``rkey``."""
    found = lookup(
        df,
        products,
        {offer: "rkey"},
        {c: c for c in levels},
        unique=unique,
        spread_by=spread_by,
        counts=counts,
    )
    return found.fillna(NOT_QUALIFIED, list(levels))


def service_group(service_filter: Column | str) -> Column:
    c = as_col(service_filter)
    group = None
    for prefix, name in SERVICE_PREFIXES.items():
        test = c.startswith(prefix)
        group = F.when(test, F.lit(name)) if group is None else group.when(test, F.lit(name))
    return group.otherwise(F.lit(OTHER_SERVICE))


def products_by_service(products: DataFrame, levels: Sequence[str] = LEVELS) -> DataFrame:
    """The product rows each service group may use, keyed (``svc``, ``rkey``)."""
    nameless = F.col("product_name").isNull()
    allowed = {
        "s1": F.col("mapping_key_type").isNull(),
        "s2": (F.col("service_type") == "2_") & nameless,
        "s3": (F.col("service_type") == "3_") & nameless,
        "s5": F.col("service_type") == "5_",
    }
    services = F.filter(
        F.array(*[F.when(test, F.lit(svc)) for svc, test in allowed.items()]), lambda s: s.isNotNull()
    )
    return products.select(F.explode(services).alias("svc"), "rkey", *levels)


def classify_product_by_service(
    df: DataFrame,
    products: DataFrame,
    *,
    service_filter: str = "service_filter",
    offer: str = "offer_id",
    b_party: str = "b_party",
    vas_code: str = "vas_code",
    levels: Sequence[str] = LEVELS,
    unique: bool = True,
    spread_by: Sequence[str] = (),
    probe: DataFrame | None = None,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Taxonomy of a usage record by its service group.

    Groups 2 and 3 try the called party, the offer and the service filter in
    turn; group 1 the offer; group 5 the VAS code; others stay "NQ". One pass:
    each try is a lookup on (group, key), which is null for groups that do not
    make it. A level still "NQ" after one try takes the next. Keys are counted
    in ``probe``, a frame with the same columns, or in ``df``.

    The dimension is exploded and made unique ahead of the tries, under the same
    names for all three, so they share its one scan and exchange.
    """
    group = service_group(service_filter)
    cascade = F.col("_svc").isin("s2", "s3")
    tries: Mapping[str, Column] = {
        "_key1": F.when(cascade, F.col(b_party))
        .when(F.col("_svc") == "s1", F.col(offer))
        .when(F.col("_svc") == "s5", F.col(vas_code)),
        "_key2": F.when(cascade, F.col(offer)),
        "_key3": F.when(cascade, F.col(service_filter)),
    }
    keyed = products_by_service(products, levels).filter(F.col("rkey").isNotNull())
    if unique:
        keyed = keep_one(keyed, ["svc", "rkey"])
    out = df.withColumn("_svc", group).withColumns(dict(tries))
    rows = (df if probe is None else probe).withColumn("_svc", group)
    for key in tries:
        out = lookup(
            out,
            keyed,
            {"_svc": "svc", key: "rkey"},
            {f"{key}_{c}": c for c in levels},
            hit=f"{key}_hit",
            unique=False,
            spread_by=spread_by,
            counts=KeyCounts(rows, {"_svc": F.col("_svc"), key: tries[key]}, hot_rows),
        )
    filled = {}
    for c in levels:
        value = F.lit(NOT_QUALIFIED)
        for key in reversed(list(tries)):
            named = F.col(f"{key}_hit") & ~F.col(f"{key}_{c}").eqNullSafe(F.lit(NOT_QUALIFIED))
            value = F.when(named, F.col(f"{key}_{c}")).otherwise(value)
        filled[c] = value
    dropped = [f"{key}{tail}" for key in tries for tail in ("", "_hit", *[f"_{c}" for c in levels])]
    return out.withColumns(filled).drop("_svc", *dropped)


def classify_product_stepwise(df: DataFrame, products: DataFrame, levels: Sequence[str] = LEVELS) -> DataFrame:
    """The same by split, join and union; kept to test the one-pass form."""
    plans = {"s1": ["offer_id"], "s2": ["b_party", "offer_id", "service_filter"], "s5": ["vas_code"]}
    plans["s3"] = plans["s2"]
    keyed = products_by_service(products, levels)
    tagged = df.withColumn("_svc", service_group("service_filter"))
    rest = tagged.filter(F.col("_svc") == OTHER_SERVICE)
    done = [rest.withColumns({c: F.lit(NOT_QUALIFIED) for c in levels})]
    for svc, keys in plans.items():
        part = tagged.filter(F.col("_svc") == svc).withColumns(
            {c: F.lit(NOT_QUALIFIED) for c in levels}
        )
        for key in keys:
            part = lookup(
                part,
                keyed.filter(F.col("svc") == svc),
                {key: "rkey"},
                {f"_{c}": c for c in levels},
                hit="_hit",
            )
            part = part.withColumns(
                {
                    c: F.when(F.col("_hit") & (F.col(c) == NOT_QUALIFIED), F.col(f"_{c}")).otherwise(F.col(c))
                    for c in levels
                }
            ).drop("_hit", *[f"_{c}" for c in levels])
        done.append(part)
    return reduce(DataFrame.unionByName, done).drop("_svc")


def add_bonus_line(
    df: DataFrame,
    lines: DataFrame,
    *,
    offer: str = "offer_id",
    out: str = "productline_bonus_l4",
    unique: bool = True,
    spread_by: Sequence[str] = (),
    probe: DataFrame | None = None,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Bonus product line: characters 3-10 of the offer against 4-11 of the
    line's fourth level."""
    keyed = lines.select(fixed(F.trim("l4"), 4, 8).alias("_bonus"), F.col("l4").alias("_l4"))
    key = fixed(F.trim(F.col(offer)), 3, 8)
    found = lookup(
        df.withColumn("_offer8", key),
        keyed,
        {"_offer8": "_bonus"},
        {out: "_l4"},
        hit="_hit",
        unique=unique,
        spread_by=spread_by,
        counts=KeyCounts(df if probe is None else probe, {"_offer8": key}, hot_rows),
    )
    return found.withColumn(
        out, F.when(F.col("_hit"), F.col(out)).otherwise(F.lit(BLANK))
    ).drop("_hit", "_offer8")


def map_values(c: Column | str, names: Mapping[str, str]) -> Column:
    """Replace listed values, keep others."""
    c = as_col(c)
    out = None
    for old, new in names.items():
        out = F.when(c == old, F.lit(new)) if out is None else out.when(c == old, F.lit(new))
    return c if out is None else out.otherwise(c)


# Spellings of product-line levels and their clean form.
L1_NAMES = {"UNKNOWN": "Others", "Digital Service": "Digital Services"}
L2_NAMES = {
    "UNKNOWN": "Others",
    "Other VAS Services": "Other VAS Service",
    "SMS Non P to P": "SMS Non P2P",
}
L3_NAMES = {"Other VAS Services": "Other VAS Service", "Volume Based": "Volume based"}
LOCAL_CALL = ("Voice P2P", "Internal MO Call", "Local")
LOCAL_CALL_NAME = "Local (On-Net)"


def clean_taxonomy(df: DataFrame) -> DataFrame:
    """Clean the levels ``l1`` to ``l3`` of a product line; ``l4`` stays.

    The local-call rule sees the cleaned ``l1`` and ``l2``.
    """
    cleaned = df.withColumns({"l1": map_values("l1", L1_NAMES), "l2": map_values("l2", L2_NAMES)})
    l1, l2, l3 = LOCAL_CALL
    local = (F.col("l1") == l1) & (F.col("l2") == l2) & (F.col("l3") == l3)
    return cleaned.withColumn(
        "l3", F.when(local, F.lit(LOCAL_CALL_NAME)).otherwise(map_values("l3", L3_NAMES))
    )


def prepaid_lines(lines: DataFrame, source: str = "PAYD") -> DataFrame:
    """Cleaned product lines of one source, with the trimmed note as key."""
    return clean_taxonomy(
        lines.withColumn("source", F.upper("source")).filter(F.col("source") == source)
    ).withColumn("trim_note", F.trim("note"))


def add_line_by_note(
    df: DataFrame,
    lines: DataFrame,
    *,
    offer: str = "offer_id",
    unique: bool = True,
    spread_by: Sequence[str] = (),
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Product-line levels by characters 3-7 of the offer, "Others" if unknown."""
    names = ("l1", "l2", "l3", "l4")
    key = fixed(offer, 3, 5)
    found = lookup(
        df.withColumn("_note", key),
        lines,
        {"_note": "trim_note"},
        {c: c for c in names},
        hit="_hit",
        unique=unique,
        spread_by=spread_by,
        counts=KeyCounts(df, {"_note": key}, hot_rows),
    )
    return found.withColumns(
        {c: F.when(F.col("_hit"), F.col(c)).otherwise(F.lit("Others")) for c in names}
    ).drop("_hit", "_note")

