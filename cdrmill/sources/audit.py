"""Run audit: start, end, and counts taken while the outputs are written."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("job", T.StringType()),
        T.StructField("start_date", T.TimestampType()),
        T.StructField("end_date", T.TimestampType()),
        T.StructField("duration_sec", T.DoubleType()),
        T.StructField("counts", T.MapType(T.StringType(), T.LongType())),
    ]
)


@dataclass
class Run:
    """Counts rows of the DataFrames passed through ``count`` during the write
    that computes them, so counting costs no pass of its own."""

    job: str
    started: datetime = field(default_factory=datetime.now)
    observed: dict[str, Observation] = field(default_factory=dict)

    def count(self, df: DataFrame, label: str) -> DataFrame:
        seen = Observation(f"{self.job}_{label}")
        self.observed[label] = seen
        return df.observe(seen, F.count(F.lit(1)).alias("rows"))

    def record(self, spark: SparkSession) -> DataFrame:
        """One audit row. Call it after the writes."""
        ended = datetime.now()
        counts = {label: int(seen.get["rows"]) for label, seen in self.observed.items()}
        seconds = (ended - self.started).total_seconds()
        return spark.createDataFrame([(self.job, self.started, ended, seconds, counts)], AUDIT_SCHEMA)

    def append_to(self, spark: SparkSession, table: str) -> None:
        self.record(spark).write.mode("append").format("parquet").saveAsTable(table)
