"""Daily location state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.state import merge_daily_state
from ..quirks import INTENDED, Quirks
from .run import RunInfo


def daily_state_job(
    state: DataFrame, daily: DataFrame, run: RunInfo, *, quirks: Quirks = INTENDED
) -> DataFrame:
    """The next day's state, in the shape of the state read."""
    merged = merge_daily_state(state, daily)
    if quirks.event_date_is_text:
        return merged.withColumn("event_date", F.lit("job_id"))
    return merged.withColumns({"event_date": F.lit(run.event_date), "job_id": F.lit(run.job_id)})
