"""Shape of the physical plans that matter at scale."""

import re

import pytest
from pyspark.sql import functions as F

from cdrmill.operators import skew
from cdrmill.plans import usage
from cdrmill.plans.run import RunInfo
from cdrmill.session import stage

RUN = RunInfo(filename="f", load_ts="ts")


@pytest.fixture
def no_broadcast(spark):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_three_subscriber_lookups_shuffle_the_records_once(tables, no_broadcast):
    names = ("usage_feed", "subscribers", "history_mtd", "history_mm", "locations")
    feeds = [stage(tables.feed(n), n) for n in names]
    plan = physical(usage.usage_stage1(*feeds, RUN, hot_rows=None)["STAGED"])
    assert len(re.findall(r"Exchange hashpartitioning\(_salted_msisdn", plan)) == 1
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "SinglePartition" not in plan


def test_ranking_never_uses_one_partition(tables):
    lines = tables.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    plan = physical(skew.dense_rank_by(lines, ["l_orderkey"], ["l_partkey"], "r"))
    assert "SinglePartition" not in plan


def test_scans_read_only_what_they_need(tables):
    from cdrmill.queries import marts

    scans = re.findall(r"ReadSchema: (\S+)", physical(marts.region_revenue(tables)))
    orders = next(s for s in scans if "o_totalprice" in s)
    assert orders == "struct<o_custkey:bigint,o_totalprice:double>"


@pytest.mark.parametrize("unique", [True, False])
def test_sums_go_below_the_lookup(tables, no_broadcast, unique):
    """An aggregate under the prefix join of both marts."""
    from cdrmill.plans.revenue import revenue_job
    from cdrmill.quirks import Quirks

    feeds = [stage(tables.feed(n), n) for n in ("revenue", "prefixes")]
    for mart in revenue_job(*feeds, quirks=Quirks(dimension_fan_out=not unique), hot_rows=None).values():
        above, below = physical(mart).split("Join ")
        assert "sum(tot_rev" in above
        assert re.search(r"HashAggregate\(keys=\[_prefix#\d+.*sum\(tot_rev", below)


def test_small_prefixes_take_one_round_of_sums(tables):
    from cdrmill.plans.revenue import revenue_job

    feeds = [stage(tables.feed(n), n) for n in ("revenue", "prefixes")]
    plan = physical(revenue_job(*feeds)["HLR"])
    assert "BroadcastHashJoin" in plan and len(re.findall(r"functions=\[sum\(", plan)) == 1


def test_bucketed_state_is_not_shuffled(spark, tables, rows, no_broadcast, tmp_path):
    from cdrmill.operators import state

    spark.sql(f"CREATE DATABASE IF NOT EXISTS states LOCATION '{tmp_path}/states'")
    old, daily = stage(tables.feed("state"), "state"), stage(tables.feed("daily"), "daily")
    state.write_state(old, "states.day1", 6)
    merged = state.merge_daily_state(spark.read.table("states.day1"), daily)
    plan = physical(merged).split("Join [")[1]
    assert len(re.findall(r"Exchange hashpartitioning\(_a_subs_id#\d+, 6\)", plan)) == 1
    assert len(re.findall("Exchange", plan)) == 1 and "Bucketed: true" in plan
    new = state.advance_state(spark, "states.day1", daily, "states.day2", 6)
    assert rows(new) == rows(state.merge_daily_state(old, daily).select(*new.columns))
    # The next day finds the buckets again, one file each, and those without a subscriber.
    keyed = new.filter("subs_id is not null")
    assert len(keyed.inputFiles()) <= 6 + spark.sparkContext.defaultParallelism * 2
    again = physical(state.merge_daily_state(new, daily)).split("Join [")[1]
    assert len(re.findall("Exchange", again)) == 1
    spark.sql("DROP DATABASE states CASCADE")


def test_product_tries_share_one_dimension(tables, rows, no_broadcast):
    """The three lookups of the cascade scan and shuffle the products once."""
    from cdrmill.operators import product

    usage_feed, products = stage(tables.feed("usage_feed"), "usage_feed"), stage(tables.feed("products"), "products")
    records = usage_feed.select("rec_id", "service_filter", "b_party", "vas_code", "event_type").withColumn(
        "offer_id", F.col("b_party")
    )
    done = product.classify_product_by_service(records, products, hot_rows=None, spread_by=["rec_id"])
    found = rows(done)
    plan = physical(done).split("Initial Plan")[0]
    dimension = [line for line in plan.splitlines() if "FileScan" in line and "mapping_key_type" in line]
    assert len(dimension) == 1 and plan.count("ReusedExchange") >= 2
    assert found == rows(product.classify_product_stepwise(records, products))


def test_located_records_scan_the_master_once(tables, no_broadcast):
    names = ("usage_feed", "subscribers", "history_mtd", "history_mm", "locations")
    feeds = [stage(tables.feed(n), n) for n in names]
    plan = physical(usage.usage_stage1(*feeds, RUN, hot_rows=None)["STAGED"])
    assert len([line for line in plan.splitlines() if "FileScan" in line and "cgi_post" not in line and "eci#" in line]) == 1


def test_rank_of_unique_records_needs_no_window(tables):
    from cdrmill.operators import duplicates

    orders = tables.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    known = duplicates.mark_duplicates(
        orders, ["o_orderkey", "o_custkey"], ["o_totalprice"], status=None, unique_by=["o_orderkey"]
    )
    assert "Window" not in physical(known) and "Exchange" not in physical(known)
    assert duplicates.has_repeats(orders, ["o_custkey"]) and not duplicates.has_repeats(orders, ["o_orderkey"])
