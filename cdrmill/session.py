"""Session settings the operators count on, and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings. Skewed joins are split by AQE even where that costs an
# extra shuffle, and a join on (subs_id, msisdn) may reuse a partitioning on
# msisdn alone, so a chain of subscriber lookups shuffles the records once. The
# JVM does not compile methods of over 8000 bytes of code; generated ones that
# long are given up for smaller ones, an operator each.
JOIN_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_local_scratch: dict[str, str] = {}


def build_session(app: str = "cdrmill", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {
        **JOIN_SETTINGS,
        "spark.sql.session.timeZone": "UTC",
        **settings,
    }.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the join settings to a session built elsewhere."""
    for key, value in JOIN_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named in ``spark.checkpoint.dir``.

    A local session without that setting gets a temporary folder of its own; a
    cluster session without it is an error, as a machine-local folder would be
    lost with its machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder")
    app = spark.sparkContext.applicationId
    if app not in _local_scratch:
        path = tempfile.mkdtemp(prefix="cdrmill-")
        atexit.register(shutil.rmtree, path, ignore_errors=True)
        _local_scratch[app] = path
    return _local_scratch[app]


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the scratch folder as Parquet and read it back.

    Cuts the lineage: a lost executor costs a re-read, several outputs share
    one computation, and later steps still prune columns and push filters. The
    shuffles it took are removed with it; nothing reads them again.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/cdrmill/{label}-{uuid.uuid4().hex}"
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)
