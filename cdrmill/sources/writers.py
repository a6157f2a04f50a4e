"""Outputs: delimited folders, catalog tables, several routes at once."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import text_schema


def write_delimited(df: DataFrame, path: str, sep: str = "~", mode: str = "errorifexists") -> None:
    """A headerless delimited folder; fails when it exists, unless told otherwise."""
    df.write.mode(mode).option("sep", sep).csv(path)


def write_table(df: DataFrame, table: str) -> None:
    """Replace a managed Parquet table."""
    df.write.mode("overwrite").format("parquet").saveAsTable(table)


def write_tables(routes: Mapping[str, DataFrame], prefix: str) -> None:
    """One table per route, ``<prefix>_<route>``. Stage the common input first."""
    for route, df in routes.items():
        write_table(df, f"{prefix}_{route.lower()}")


# Part of a partitioned folder that holds its declared schema; readers of the
# folder pass over names that start like this.
SCHEMA_PART = "_schema"


def _declare(df: DataFrame, path: str) -> None:
    """Leave the schema in the folder: partition values are text there, and
    without it "01" would be read back as the number 1."""
    line = df.sparkSession.createDataFrame([(df.schema.json(),)], "value string")
    line.coalesce(1).write.mode("overwrite").text(f"{path}/{SCHEMA_PART}")


def write_routed(df: DataFrame, path: str, route: str, mode: str = "errorifexists") -> None:
    """All routes in one pass: a Parquet folder per route value. Read it with
    ``readers.read_partitioned``."""
    df.write.mode(mode).partitionBy(route).parquet(path)
    _declare(df, path)


def write_by_date(df: DataFrame, path: str, date: str = "event_date", mode: str = "overwrite") -> None:
    """Parquet by date. ``overwrite`` replaces only the dates in ``df``, and
    records of one date are spread over all of that date's writers by AQE. Read
    it with ``readers.read_partitioned``."""
    spread = df.hint("rebalance", F.col(date))
    spread.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(date).parquet(path)
    _declare(df, path)


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """A database, if there is none yet; ``location`` holds its managed tables."""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{place}")


def drop_tables(spark: SparkSession, tables: Sequence[str]) -> None:
    for table in tables:
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def create_text_table(spark: SparkSession, table: str, names: Sequence[str]) -> None:
    """A Parquet table of text columns, if there is none yet."""
    columns = ", ".join(f"`{name}` string" for name in names)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING PARQUET")


def load_delimited(spark: SparkSession, path: str, table: str, names: Sequence[str], sep: str = "|") -> None:
    """Replace a table by the content of a delimited feed."""
    feed = spark.read.schema(text_schema(names)).option("sep", sep).csv(path)
    write_table(feed, table)


def load_parquet(spark: SparkSession, path: str, table: str) -> None:
    """Replace a table by the content of a Parquet folder or glob."""
    write_table(spark.read.parquet(path), table)
