"""Feeds, dimensions and catalog tables as DataFrames."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..schemas import text_schema
from .writers import SCHEMA_PART


def read_parquet(spark: SparkSession, path: str, names: Sequence[str] | None = None) -> DataFrame:
    """A Parquet folder or glob such as ``/data/*/*/*``; ``names`` renames by
    position."""
    df = spark.read.parquet(path)
    return rename(df, names) if names else df


def read_partitioned(spark: SparkSession, path: str) -> DataFrame:
    """A folder of ``writers.write_routed`` or ``write_by_date`` with the columns
    and types it was written with, partition values included."""
    (line,) = spark.read.text(f"{path}/{SCHEMA_PART}/part-*").collect()
    schema = StructType.fromJson(json.loads(line.value))
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def read_feed(
    spark: SparkSession, path: str, names: Sequence[str], sep: str = "|", header: bool = False
) -> DataFrame:
    """A delimited feed of text columns.

    The schema is given, so the files are read once and columns that are not
    used are not parsed.
    """
    return (
        spark.read.schema(text_schema(names))
        .option("sep", sep)
        .option("header", header)
        .option("enforceSchema", not header)
        .csv(path)
    )


def read_header_csv(
    spark: SparkSession, path: str, names: Sequence[str] | None = None, sep: str = ";"
) -> DataFrame:
    """A delimited file whose columns are named by its header line."""
    df = spark.read.option("sep", sep).option("header", True).csv(path)
    return df.select(*names) if names else df


def read_table(spark: SparkSession, table: str, names: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.table(table)
    return rename(df, names) if names else df


def rename(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Name all columns by position."""
    if len(names) != len(df.columns):
        raise ValueError(f"{len(names)} names for {len(df.columns)} columns")
    return df.toDF(*names)
