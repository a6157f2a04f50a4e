"""Revenue marts by home and by visited location."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.marts import hlr_mart, mart_records, vlr_mart
from ..operators.skew import HOT_ROWS
from ..quirks import INTENDED, Quirks


def revenue_job(
    revenue: DataFrame,
    prefixes: DataFrame,
    *,
    quirks: Quirks = INTENDED,
    hot_rows: int | None = HOT_ROWS,
) -> dict[str, DataFrame]:
    """Each mart reads only the columns it groups and sums, so two scans cost
    less than writing the records out in between."""
    records = mart_records(revenue)
    options = {"unique": not quirks.dimension_fan_out, "hot_rows": hot_rows}
    return {"HLR": hlr_mart(records, prefixes, **options), "VLR": vlr_mart(records, prefixes, **options)}
