"""Payments and plan activations: two stages, good and reject outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.amounts import price_or_zero
from ..functions.text import fixed
from ..operators.enrich import enrich_subscriber, fill_location_from_history
from ..operators.locate import closing_flag, location_index, lookup_location, payment_cell
from ..operators.product import LEVELS, add_product, normalise_product_key, resolve_offer
from ..operators.quality import reject_if_first_missing
from ..operators.salted import KeyCounts
from ..operators.skew import HOT_ROWS
from ..quirks import INTENDED, Quirks
from ..schemas import ACTIVATION_STAGED, PAYMENT_GOOD, PAYMENT_STAGED
from ..sentinels import BLANK, BRAND, MISSING_ID, NOT_QUALIFIED, PRE_POST, SITE, UNKNOWN
from ..session import stage
from .run import RunInfo

# Fixed value: the plan whose offer stands in the first reserved field.
SPECIAL_PLAN = "SA10359"

SUBSCRIBER_DEFAULTS = {
    "subs_id": MISSING_ID,
    "cust_type_desc": UNKNOWN,
    "cust_subtype_desc": UNKNOWN,
}
LOCATION_KEYS = ("lacci_id", "eci", "cgi_post")
# Location column of the output -> column of the location master.
LOCATION_NAMES = {
    "lac": "lac",
    "ci": "ci",
    "node_type": "node",
    "area_name": "area_sales",
    **{
        c: c
        for c in (
            "region_sales", "branch", "subbranch", "cluster_sales", "provinsi", "kabupaten",
            "kecamatan", "kelurahan",
        )
    },
}
REQUIRED = (*SUBSCRIBER_DEFAULTS, *LEVELS, "lacci_id", "lacci_closing_flag", *LOCATION_NAMES)

# An activation has the activation time in front, its payment time after the
# price and future_string_4 instead of a bundling id.
ACTIVATION_GOOD = (
    "activation_timestamp",
    *PAYMENT_GOOD[1:13],
    "payment_timestamp",
    *["future_string_4" if c == "bundling_id" else c for c in PAYMENT_GOOD[13:]],
)
# What tells records apart.
IDENTITY = ("msisdn", "bss_order_id", "payment_timestamp")
REJECT_EXTRA = ("filename", "trx_lacci", "lacci_id_flag", "retry_count", "status_reject")


def payment_stage1(
    feed: DataFrame,
    subscribers: DataFrame,
    run: RunInfo,
    *,
    activation: bool = False,
    quirks: Quirks = INTENDED,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Constants, price, offer, cell key and subscriber of each payment."""
    day = fixed("payment_timestamp", 1, 10)
    special = {} if activation else {"special_plan": SPECIAL_PLAN, "special_offer": "future_string_1"}
    derived = feed.withColumns(
        {
            "filename": F.lit(run.filename),
            "trx_date": day,
            "trx_hour": fixed("payment_timestamp", 11 if quirks.hour_starts_early else 12, 8),
            "event_date": day,
            "brand": F.lit(BRAND),
            "site_name": F.lit(SITE),
            "pre_post_flag": F.lit(PRE_POST),
            "plan_price": price_or_zero("plan_price"),
            "offer_id": resolve_offer("plan_id", "topping_id", **special),
            "retry_count": F.lit(0),
        }
    )
    enriched = enrich_subscriber(
        payment_cell(derived),
        subscribers,
        SUBSCRIBER_DEFAULTS,
        null_attributes_too=True,
        unique=not quirks.dimension_fan_out,
        spread_by=IDENTITY,
        counts=KeyCounts(feed, ["msisdn"], hot_rows),
    )
    return enriched.select(*(ACTIVATION_STAGED if activation else PAYMENT_STAGED))


def payment_stage2(
    staged: DataFrame,
    mtd: DataFrame,
    mm: DataFrame,
    master: DataFrame,
    products: DataFrame,
    run: RunInfo,
    *,
    activation: bool = False,
    quirks: Quirks = INTENDED,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Location, product and ``status_reject`` (YES / NO) of each payment.

    ``staged`` is read several times: give the table stage 1 was written to.
    """
    located = fill_location_from_history(
        staged,
        mtd,
        mm,
        blank_blocks=quirks.blank_location_blocks_history,
        flag_on_equal_id=quirks.history_flag_on_equal_id,
        spread_by=IDENTITY,
        counts=KeyCounts(staged, ["subs_id"], hot_rows),
    )
    unique = LOCATION_KEYS
    if quirks.dimension_fan_out:
        unique = ("eci", "cgi_post") if activation else ("cgi_post",)
    index = location_index(
        master, LOCATION_KEYS, {"lacci_id_laccima": "lacci_id", **LOCATION_NAMES}, unique
    )
    # "-99" is no location: spread those records, they match nothing.
    searched = located.withColumn("_search", F.nullif("trx_lacci", F.lit(MISSING_ID)))
    matched = lookup_location(
        searched,
        index,
        "_search",
        spread_by=IDENTITY,
        counts=KeyCounts(searched, ["_search"], hot_rows),
    ).drop("_search")
    flagged = closing_flag(matched, padded_unresolved_id=quirks.padded_unresolved_id)
    named = add_product(
        flagged.fillna(NOT_QUALIFIED, list(LOCATION_NAMES)),
        normalise_product_key(products),
        unique=not quirks.dimension_fan_out,
        spread_by=IDENTITY,
        counts=KeyCounts(staged, ["offer_id"], hot_rows),
    )
    audited = named.withColumns(
        {
            "file_id": F.lit(BLANK),
            "load_ts": F.lit(run.load_ts),
            "load_user": F.lit(run.load_user),
        }
    )
    if quirks.reject_on_first_value_only:
        judged = reject_if_first_missing(audited, REQUIRED)
    else:
        missing = F.lit(False)
        for c in REQUIRED:
            missing = missing | F.col(c).isNull() | F.col(c).isin(NOT_QUALIFIED, MISSING_ID)
        judged = audited.withColumn("status_reject", F.when(missing, F.lit("YES")).otherwise(F.lit("NO")))
    good = ACTIVATION_GOOD if activation else PAYMENT_GOOD
    return judged.select(*good, *REJECT_EXTRA)


def payment_routes(judged: DataFrame, *, activation: bool = False) -> dict[str, DataFrame]:
    """The good output drops the working columns, the reject output keeps them."""
    good = ACTIVATION_GOOD if activation else PAYMENT_GOOD
    return {
        "GOOD": judged.filter(F.col("status_reject") == "NO").select(*good),
        "REJECT": judged.filter(F.col("status_reject") == "YES"),
    }


def payment_job(
    feed: DataFrame,
    subscribers: DataFrame,
    mtd: DataFrame,
    mm: DataFrame,
    master: DataFrame,
    products: DataFrame,
    run: RunInfo,
    *,
    activation: bool = False,
    quirks: Quirks = INTENDED,
    hot_rows: int | None = HOT_ROWS,
) -> dict[str, DataFrame]:
    """Both stages, each written out once: the first for the second to look for
    hot keys in, the second for the two outputs."""
    options = {"activation": activation, "quirks": quirks, "hot_rows": hot_rows}
    first = stage(payment_stage1(feed, subscribers, run, **options), "payment_enriched")
    judged = payment_stage2(first, mtd, mm, master, products, run, **options)
    return payment_routes(stage(judged, "payment"), activation=activation)
