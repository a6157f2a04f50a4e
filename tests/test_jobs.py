"""Whole jobs: invariants, hot keys, the literal reading."""

import dataclasses

import pytest
from pyspark.sql import functions as F

from cdrmill.plans import payment, recharge, usage
from cdrmill.plans.daily_state import daily_state_job
from cdrmill.plans.run import RunInfo
from cdrmill.quirks import AS_WRITTEN, INTENDED
from cdrmill.schemas import LOCATION_STATE, PAYMENT_GOOD, RECHARGE_OUT, USAGE_OUT
from cdrmill.session import stage

RUN = RunInfo(filename="f", load_ts="ts", load_date="20230120", job_id="J", event_date="20230120")


@pytest.fixture(scope="module")
def feeds(tables):
    names = (
        "usage_feed recharges payments subscribers history_mtd history_mm locations products "
        "product_lines payment_mtd payment_mm"
    ).split()
    return {n: stage(tables.feed(n), n) for n in names}


def run_usage(f, feed=None, **options):
    dims = ("subscribers", "history_mtd", "history_mm", "locations", "products", "product_lines")
    return usage.usage_job(f["usage_feed"] if feed is None else feed, *[f[d] for d in dims], RUN, **options)


def run_recharge(f, feed=None, **options):
    dims = ("subscribers", "history_mtd", "history_mm", "locations", "product_lines")
    return recharge.recharge_job(f["recharges"] if feed is None else feed, *[f[d] for d in dims], RUN, **options)


def run_payment(f, **options):
    dims = ("subscribers", "payment_mtd", "payment_mm", "locations", "products")
    return payment.payment_job(f["payments"], *[f[d] for d in dims], RUN, **options)


def same(rows, a, b):
    assert a.keys() == b.keys()
    for route in a:
        assert rows(a[route]) == rows(b[route]), route


@pytest.mark.parametrize("job", [run_usage, run_recharge, run_payment])
def test_hot_keys_change_nothing(feeds, rows, job):
    same(rows, job(feeds, hot_rows=None), job(feeds, hot_rows=3))


@pytest.mark.parametrize("job", [run_usage, run_recharge, run_payment])
def test_shuffled_lookups_change_nothing(spark, feeds, rows, job):
    """The same without any automatic broadcast."""
    expected = {k: rows(v) for k, v in job(feeds, hot_rows=None).items()}
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = {k: rows(v) for k, v in job(feeds, hot_rows=20).items()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert found == expected


def test_usage_loses_no_record(feeds):
    out = run_usage(feeds)
    counts = {k: out[k].count() for k in ("BAD", "GOOD", "REJECT", "DUP02")}
    assert sum(counts.values()) == feeds["usage_feed"].count()
    assert all(counts.values())
    assert out["SUM"].agg(F.sum("qty")).first()[0] == counts["GOOD"] + counts["REJECT"]
    assert out["GOOD"].columns == list(USAGE_OUT)


def test_recharge_loses_no_record(feeds):
    out = run_recharge(feeds, method=None)
    routes = ("BAD", "GOOD", "REJECT", "DUP01", "DUP02", "DUP03")
    counts = {k: out[k].count() for k in routes}
    assert sum(counts.values()) == feeds["recharges"].count()
    assert out["GOOD"].columns == list(RECHARGE_OUT)
    merged = sum(out[k].agg(F.sum("trx")).first()[0] for k in ("MERGE_GOOD", "MERGE_REJECT"))
    assert merged == counts["GOOD"] + counts["REJECT"]


def test_payment_loses_no_record(feeds):
    out = run_payment(feeds)
    assert out["GOOD"].count() + out["REJECT"].count() == feeds["payments"].count()
    assert out["GOOD"].columns == list(PAYMENT_GOOD)


def test_feeds_are_numbered_when_they_are_not(feeds):
    out = run_usage(feeds, feeds["usage_feed"].drop("rec_id"))
    ids = [r[0] for k in ("BAD", "GOOD", "REJECT", "DUP02") for r in out[k].select("rec_id").collect()]
    assert sorted(ids) == list(range(1, feeds["usage_feed"].count() + 1))
    out = run_recharge(feeds, feeds["recharges"].drop("rec_id"), method=None)
    ids = [r[0] for k in ("GOOD", "REJECT", "DUP02") for r in out[k].select("rec_id").collect()]
    assert sorted(ids) == list(range(1, len(ids) + 1))
    assert out["DUP03"].count() == 0


def test_literal_msisdn_comes_from_history(feeds, rows):
    only = dataclasses.replace(INTENDED, msisdn_from_history=True)
    dims = ("subscribers", "history_mtd", "history_mm", "locations")
    args = [feeds["usage_feed"], *[feeds[d] for d in dims], RUN]
    kept = usage.usage_stage1(*args)["STAGED"].select("rec_id", F.col("msisdn").alias("own"), "subs_id")
    swapped = usage.usage_stage1(*args, quirks=only)["STAGED"].select("rec_id", "msisdn")
    both = kept.distinct().join(swapped.distinct(), "rec_id")
    assert both.filter(F.col("msisdn") != F.col("own")).count() == 0
    known = feeds["history_mm"].select(F.col("msisdn").alias("own"), F.col("subs_id_mm").alias("subs_id"))
    assert both.filter("msisdn IS NULL").join(known, ["own", "subs_id"]).count() == 0
    assert both.filter("msisdn IS NULL").count() > 0


def test_literal_recharge_takes_file_id_from_the_cell(feeds):
    only = dataclasses.replace(INTENDED, file_id_from_master=True)
    out = run_recharge(feeds, quirks=only, method=None)
    ids = {r[0] for k in ("GOOD", "REJECT") for r in out[k].select("file_id").distinct().collect()}
    assert None in ids and any(i and i.startswith("F") for i in ids)


def test_literal_jobs_run(feeds):
    assert run_usage(feeds, quirks=AS_WRITTEN)["SUM"].count() > 0
    assert run_recharge(feeds, quirks=AS_WRITTEN)["SUM"].count() > 0


def test_state_has_the_shape_it_reads(tables):
    state, daily = tables.feed("state"), tables.feed("daily")
    once = daily_state_job(state, daily, RUN).filter("subs_id IS NOT NULL")
    assert sorted(once.columns) == sorted(LOCATION_STATE)
    again = daily_state_job(once, daily, RUN).filter("subs_id IS NOT NULL")
    assert again.count() == once.count()
    literal = daily_state_job(state, daily, RUN, quirks=AS_WRITTEN)
    assert len(literal.columns) == 45
    assert literal.select("event_date").distinct().first()[0] == "job_id"


def test_usage_takes_along_what_is_wanted(spark, feeds, rows):
    """Some routes and columns alone: the same rows, from narrower files."""
    whole, columns = run_usage(feeds), ["rec_id", "lacci_id", "l4_name", "trx_date", "productline_bonus_l4"]
    some = run_usage(feeds, routes=["GOOD", "REJECT", "DUP02"], columns=columns)
    assert sorted(some) == ["DUP02", "GOOD", "REJECT"]
    for route, found in some.items():
        assert sorted(found.columns) == sorted(columns)
        assert rows(found, *columns) == rows(whole[route], *columns), route
    read = spark.read.parquet(*{f.rpartition("/")[0] for f in some["GOOD"].inputFiles()})
    assert len(read.columns) < 20
    sums = run_usage(feeds, routes=["SUM"], columns=[])
    assert list(sums) == ["SUM"] and rows(sums["SUM"]) == rows(whole["SUM"])


@pytest.mark.parametrize("fan_out", [False, True])
def test_usage_duplicates_alone(feeds, rows, fan_out):
    """Records of rank 1 are not taken through the lookups; ids that are there
    twice or missing change nothing."""
    quirks = dataclasses.replace(INTENDED, dimension_fan_out=fan_out)
    feed = feeds["usage_feed"]
    more = feed.filter("b_party = 'B2'").withColumn("rec_id", F.lit(None).cast("long"))
    feed = feed.unionByName(feed.filter("rec_id % 3 = 0").withColumn("cost_band", F.lit("x"))).unionByName(more)
    feed = stage(feed, "usage_feed")
    whole = run_usage(feeds, feed, quirks=quirks)["DUP02"]
    alone = run_usage(feeds, feed, quirks=quirks, routes=["DUP02"], columns=["rec_id", "ranking"])["DUP02"]
    assert rows(alone.select(*whole.columns)) == rows(whole)
    assert whole.filter("ranking > 1").count() > 0
    assert "usage_cleansed" not in " ".join(alone.inputFiles())


def test_a_staged_frame_leaves_no_shuffle(spark):
    known = spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses()
    before = known.size()
    assert stage(spark.range(1000).repartition(3, "id"), "numbers").count() == 1000
    assert known.size() <= before + 1  # that of the count
