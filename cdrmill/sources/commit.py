"""Audited runs: a job's outputs and its audit row become visible together.

Each attempt writes its routes into folders of its own, counted while they are
written. Then one audit row, which names the run, the attempt and what it wrote,
is appended: that is the commit. Readers take, for every run, the last attempt
that has an audit row. So an attempt that fails leaves nothing to be read, a
rerun replaces what the run gave before, and nothing is ever counted twice.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from .audit import Run

COMMIT_SCHEMA = T.StructType(
    [
        T.StructField("job", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("attempt", T.StringType()),
        T.StructField("start_date", T.TimestampType()),
        T.StructField("end_date", T.TimestampType()),
        T.StructField("duration_sec", T.DoubleType()),
        T.StructField("inputs", T.MapType(T.StringType(), T.LongType())),
        T.StructField("routes", T.MapType(T.StringType(), T.LongType())),
    ]
)

Build = Callable[..., Mapping[str, DataFrame]]


def _audit(folder: str) -> str:
    return f"{folder}/audit"


def _place(folder: str, run_id: str, attempt: str, route: str) -> str:
    return f"{folder}/runs/{run_id}/{attempt}/{route}"


def run_audited(
    spark: SparkSession, folder: str, job: str, run_id: str, build: Build, **inputs: DataFrame
) -> DataFrame:
    """Build the routes from the inputs, write them, commit; returns the audit row.

    ``build`` takes the inputs by name and gives route -> DataFrame. Inputs are
    counted in the first pass over them that the job makes, routes in the pass
    that writes them. Raises what fails; then nothing is committed.
    """
    attempt, run = uuid.uuid4().hex, Run(f"{job}_{run_id}")
    routes = build(**{name: run.count(df, f"input:{name}") for name, df in inputs.items()})
    for route, df in routes.items():
        run.count(df, f"route:{route}").write.parquet(_place(folder, run_id, attempt, route))
    ended = datetime.now()
    counts = {label: int(seen.get["rows"]) for label, seen in run.observed.items()}

    def of(kind: str) -> dict[str, int]:
        return {k.removeprefix(f"{kind}:"): n for k, n in counts.items() if k.startswith(f"{kind}:")}

    seconds = (ended - run.started).total_seconds()
    row = (job, run_id, attempt, run.started, ended, seconds, of("input"), of("route"))
    record = spark.createDataFrame([row], COMMIT_SCHEMA)
    record.coalesce(1).write.mode("append").parquet(_audit(folder))  # one file: the commit
    return record


def commits(spark: SparkSession, folder: str) -> DataFrame:
    """The audit row in force of each job and run."""
    try:
        rows = spark.read.schema(COMMIT_SCHEMA).parquet(_audit(folder))
    except AnalysisException:  # nothing has been committed yet
        return spark.createDataFrame([], COMMIT_SCHEMA)
    last = Window.partitionBy("job", "run_id").orderBy(F.desc("end_date"), F.desc("attempt"))
    return rows.withColumn("_last", F.row_number().over(last)).filter("_last = 1").drop("_last")


def read_route(spark: SparkSession, folder: str, route: str) -> DataFrame | None:
    """One route of all committed runs, ``run_id`` added; None where no run has it."""
    known = commits(spark, folder).filter(F.map_contains_key("routes", F.lit(route)))
    found = None
    for r in known.select("run_id", "attempt").orderBy("run_id").collect():  # one row for each run
        part = spark.read.parquet(_place(folder, r.run_id, r.attempt, route)).withColumn("run_id", F.lit(r.run_id))
        found = part if found is None else found.unionByName(part)
    return found
