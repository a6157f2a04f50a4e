"""Orders: accounting and product-line taxonomy, good and reject outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import fixed
from ..operators.lookup import lookup
from ..operators.product import resolve_offer
from ..operators.quality import GOOD, REJECT, good_if_all_present, split_by
from ..operators.salted import KeyCounts, add_salt, is_small
from ..operators.skew import HOT_ROWS
from ..quirks import INTENDED, Quirks
from ..schemas import ORDER_OUT
from ..sentinels import BRAND, PRE_POST
from .run import RunInfo

ACCOUNTING = ("l1_payu", "l2_service_type", "l3_allowance_type", "l4_product_category", "l5_product")
LINE = ("l1_name", "l2_name", "l3_name", "l4_name")
# Fixed value: the service type whose product rows orders use.
SERVICE_TYPE = "1_"


def order_records(
    feed: DataFrame,
    accounting: DataFrame,
    lines: DataFrame,
    run: RunInfo,
    *,
    quirks: Quirks = INTENDED,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Orders with both taxonomies and ``status_reject`` (GOOD / REJECT)."""
    day = fixed("timestamp_r", 1, 8)
    orders = feed.withColumns(
        {
            "file_id": F.lit(run.filename),
            "trx_date": day,
            "trx_hour": fixed("timestamp_r", 8 if quirks.hour_starts_early else 9, 6),
            "brand": F.lit(BRAND),
            "pre_post_flag": F.lit(PRE_POST),
            "offer_id": resolve_offer("main_plan_id", "topping_plan_id"),
            "load_ts": F.lit(run.load_ts),
            "load_user": F.lit(run.load_user),
            "load_date": F.lit(run.load_date),
            "event_date": day,
        }
    )
    # Both lookups are by offer: one shuffle serves them.
    counts = KeyCounts(orders, ["offer_id"], hot_rows)
    if not (is_small(accounting) and is_small(lines)):
        orders = add_salt(orders, counts, ("order_id", "msisdn", "timestamp_r"))
    for dim, levels in ((accounting, ACCOUNTING), (lines, LINE)):
        orders = lookup(
            orders,
            dim.filter(F.col("service_type") == SERVICE_TYPE),
            {"offer_id": "rkey"},
            {c: c for c in levels},
            unique=not quirks.dimension_fan_out,
            counts=counts,
        )
    return good_if_all_present(orders.drop(counts.salt), [*ACCOUNTING, *LINE])


def order_routes(records: DataFrame) -> dict[str, DataFrame]:
    return {
        route: df.select(*ORDER_OUT)
        for route, df in split_by(records, "status_reject", (GOOD, REJECT)).items()
    }
