"""Registry of queries over the star-schema tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..session import stage, tune
from .feeds import FEEDS

Build = Callable[["Tables"], DataFrame]

_landed: dict[tuple[str, str, str], DataFrame] = {}

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


@dataclass(frozen=True)
class Query:
    name: str
    build: Build
    sql: str | None

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.build(Tables(spark, sf_dir))


class Tables:
    """The tables under one folder, and the telecom feeds derived from them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = tune(spark)
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.table(name)
        raise AttributeError(name)

    @cached_property
    def _views(self) -> None:
        for name in TABLES:
            self.table(name).createOrReplaceTempView(name)

    def sql(self, text: str) -> DataFrame:
        self._views  # noqa: B018 - registers the views once
        return self.spark.sql(text)

    def feed(self, name: str) -> DataFrame:
        return self.sql(FEEDS[name])

    def landed(self, name: str) -> DataFrame:
        """A feed written out as a job would find it: files of its own, split
        for all cores whatever the table's layout. Once per session."""
        spark = self.spark
        key = (spark.sparkContext.applicationId, self.sf_dir, name)
        if key not in _landed:
            feed = self.feed(name)
            if not self._split_by_scan(feed):
                feed = feed.repartition(spark.sparkContext.defaultParallelism)
            _landed[key] = stage(feed, f"feed_{name}")
        return _landed[key]


    def _split_by_scan(self, feed: DataFrame) -> bool:
        """Whether the largest table under a feed is read in splits for all cores."""
        spark, leaves = self.spark, feed._jdf.queryExecution().optimizedPlan().collectLeaves()
        largest = max(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
        split = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(
            spark.conf.get("spark.sql.files.maxPartitionBytes")
        )
        return largest >= split * spark.sparkContext.defaultParallelism


def with_feeds(names: Iterable[str], body: str) -> str:
    """``body`` over the named feeds. ``body`` starts with SELECT or with more
    ``name AS (...)`` definitions, followed by SELECT."""
    ctes = ",\n".join(f"{name} AS ({FEEDS[name]})" for name in names)
    joint = "\n" if body.lstrip().upper().startswith("SELECT") else ",\n"
    return f"WITH {ctes}{joint}{body}"


class Registry:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}

    def add(self, sql: str | None = None, name: str | None = None) -> Callable[[Build], Build]:
        def register(build: Build) -> Build:
            key = name or build.__name__
            if key in self.queries:
                raise ValueError(f"query {key} registered twice")
            self.queries[key] = Query(key, build, sql)
            return build

        return register
