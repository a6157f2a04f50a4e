"""Recharges: cleansing, location, duplicates, revenue and totals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.amounts import signed_recharge
from ..functions.text import null_to
from ..functions.times import clock, day, event_time, expiry, hour
from ..operators.duplicates import NODUP, route_recharge_duplicates
from ..operators.locate import (
    match_location,
    resolve_location_cascade,
    resolve_location_overwriting,
    route_by_network,
    usage_cell_key,
)
from ..operators.marts import recharge_revenue, recharge_to_revenue
from ..operators.product import add_line_by_note, prepaid_lines
from ..operators.quality import GOOD, REJECT, control_totals, quarantine_bad, reject_if_any_missing
from ..operators.salted import KeyCounts
from ..operators.skew import HOT_ROWS, number_arrivals
from ..operators.wide import pack_columns, unpack_columns
from ..quirks import INTENDED, Quirks
from ..schemas import RECHARGE_OUT
from ..sentinels import (
    BLANK,
    BRAND,
    MISSING_ID,
    NO_CASE,
    NO_OLD_EXPIRY,
    NOT_QUALIFIED,
    RECHARGE_SENTINELS,
    SITE,
    ZERO,
)
from ..session import stage
from .history import add_subscriber_and_history
from .run import RunInfo

BAD_TEST = ("timestamp", "delta_balance", "msisdn")
SUBSCRIBER_DEFAULTS = {
    "subs_id": MISSING_ID,
    "cust_type_desc": NOT_QUALIFIED,
    "cust_subtype_desc": NOT_QUALIFIED,
}
# The record columns up to and including status.
RECORD = (*RECHARGE_OUT[: RECHARGE_OUT.index("load_date")], "status_data", "status")
# What tells records apart.
IDENTITY = ("filename", "rec_id")
# The recharge method kept, and those of the control totals.
FEE_METHOD = "TPFEE"
GROUP_PROCESS = "2"
FILETYPE = "SA_USAGE_OCS_RCG"


def cleanse(feed: DataFrame, run: RunInfo, quirks: Quirks = INTENDED) -> DataFrame:
    ts = event_time("timestamp")
    folded = feed.withColumns(
        {
            "credit_indicator": F.upper("credit_indicator"),
            "recharge_method": F.upper("recharge_method"),
            "recharge_amount": null_to("recharge_amount", ZERO),
        }
    )
    return folded.withColumns(
        {
            "filename": F.lit(run.filename),
            "timestamp_r": ts,
            "trx_hour": hour(ts),
            "trx_date": day(ts),
            "event_date": clock(ts),
            "old_expiration_date": null_to("old_expiration_date", NO_OLD_EXPIRY),
            "case_id": null_to("case_id", NO_CASE),
            "crmuser_id": null_to("crmuser_id", NO_CASE),
            "expiration_date": expiry("timestamp", "expiration_date", quirks.expiry_from_event_time),
            "recharge_amount": signed_recharge("recharge_amount", "recharge_method", "credit_indicator"),
            "trx_lacci": usage_cell_key(
                "a_number_location", F.trim("indicator_4g"), cgi_is_raw=True
            ),
            "brand": F.lit(BRAND),
            "site_name": F.lit(SITE),
            "file_id": F.lit(BLANK),
            "load_ts": F.lit(run.load_ts),
            "load_user": F.lit(run.load_user),
            "retry_count": F.lit(ZERO),
            "retry_ts": F.lit(run.load_ts),
            "status_data": F.lit(BLANK),
            "status": F.lit(NODUP),
        }
    )


def recharge_records(
    feed: DataFrame,
    subscribers: DataFrame,
    mtd: DataFrame,
    mm: DataFrame,
    master: DataFrame,
    run: RunInfo,
    *,
    quirks: Quirks = INTENDED,
    hot_rows: int | None = HOT_ROWS,
) -> dict[str, DataFrame]:
    """BAD records, and the cleansed, enriched and located others (STAGED)."""
    good, bad = quarantine_bad(feed, BAD_TEST)
    numbered = good if "rec_id" in feed.columns else number_arrivals(good, "rec_id")
    clean = cleanse(numbered, run, quirks)
    enriched = add_subscriber_and_history(
        pack_columns(clean, (*IDENTITY, "msisdn", "trx_lacci", "indicator_4g"), RECORD),
        subscribers,
        mtd,
        mm,
        SUBSCRIBER_DEFAULTS,
        quirks,
        spread_by=IDENTITY,
        counts=KeyCounts(clean, ["msisdn"], hot_rows),
    )
    matched = match_location(
        enriched.withColumn("_kind_of_key", route_by_network("indicator_4g", cgi=True)),
        master,
        kind="_kind_of_key",
        take_also=["file_id"] if quirks.file_id_from_master else [],
        unique=not quirks.dimension_fan_out,
        spread_by=IDENTITY,
        counts=KeyCounts(clean, ["trx_lacci"], hot_rows),
    )
    if quirks.cascade_tests_overwritten_key:
        located = resolve_location_overwriting(matched, "_kind_of_key")
    else:
        located = resolve_location_cascade(matched)
    located = unpack_columns(located)
    if quirks.file_id_from_master:
        located = located.withColumn("file_id", F.col("m_file_id"))
    return {"BAD": bad, "STAGED": located.select(*RECORD)}


def recharge_outputs(
    staged: DataFrame,
    lines: DataFrame,
    run: RunInfo,
    *,
    method: str | None = FEE_METHOD,
    copies: bool = True,
    quirks: Quirks = INTENDED,
    hot_rows: int | None = HOT_ROWS,
) -> dict[str, DataFrame]:
    """Duplicates, good and reject records, merged revenue and totals.

    ``method`` keeps recharges of one method in all but the duplicate outputs;
    None keeps all. ``staged`` is read several times: give a written table.
    ``copies`` tells whether an input record can be in it more than once.
    """
    fan_out_order = [c for c in RECORD if c not in IDENTITY]
    sentinels = dict(RECHARGE_SENTINELS)
    if not quirks.customer_type_nq_is_present:
        sentinels["cust_type_desc"] = NOT_QUALIFIED
    routed = route_recharge_duplicates(staged, fan_out_order, copies=copies, hot_rows=hot_rows)
    routed = stage(routed, "recharge_routed")
    judged = reject_if_any_missing(routed.filter(F.col("route") == "UNIQUE"), sentinels).withColumn(
        "offer_id",
        F.when(F.col("status_data") == GOOD, F.col("provider_id")).otherwise(F.lit(BLANK)),
    )
    if method is not None:
        judged = judged.filter(F.col("recharge_method") == method)

    lined = judged
    if quirks.dimension_fan_out:
        # The line names are not part of the revenue; only their multiplicity is.
        lined = add_line_by_note(judged, prepaid_lines(lines), unique=False)
    revenue = recharge_revenue(recharge_to_revenue(lined, load_date=run.load_date))
    dated = judged.withColumns(
        {"p_event_date": F.col("event_date"), "load_date": F.lit(run.load_date)}
    )
    return {
        **{
            route: routed.filter(F.col("route") == route).drop("route")
            for route in ("DUP01", "DUP02", "DUP03")
        },
        GOOD: dated.filter(F.col("status_data") == GOOD)
        .withColumn("retry_count", F.col("rec_id") + 1)
        .select(*RECHARGE_OUT),
        REJECT: dated.filter(F.col("status_data") == REJECT).select(*RECHARGE_OUT),
        "MERGE_GOOD": revenue.filter(F.col("source_name") == "RCG_GOOD"),
        "MERGE_REJECT": revenue.filter(F.col("source_name") == "RCG_REJECT"),
        "SUM": control_totals(
            judged,
            amount="recharge_amount",
            job_id=run.job_id,
            group_process=GROUP_PROCESS,
            filetype=FILETYPE,
            keep_dashes=quirks.period_keeps_dashes,
        ),
    }


def recharge_job(
    feed: DataFrame,
    subscribers: DataFrame,
    mtd: DataFrame,
    mm: DataFrame,
    master: DataFrame,
    lines: DataFrame,
    run: RunInfo,
    *,
    method: str | None = FEE_METHOD,
    quirks: Quirks = INTENDED,
    hot_rows: int | None = HOT_ROWS,
) -> dict[str, DataFrame]:
    """Records, written out once, then all outputs."""
    options = {"quirks": quirks, "hot_rows": hot_rows}
    first = recharge_records(feed, subscribers, mtd, mm, master, run, **options)
    # Numbered here and looked up in unique dimensions, a record stays single.
    copies = quirks.dimension_fan_out or "rec_id" in feed.columns
    staged = stage(first["STAGED"], "recharge")
    second = recharge_outputs(staged, lines, run, method=method, copies=copies, **options)
    return {"BAD": first["BAD"], **second}
