import pytest
from pyspark.sql import functions as F

from cdrmill.schemas import PAYMENT_FEED
from cdrmill.session import scratch_dir, stage
from cdrmill.sources import audit, commit, readers, writers


def test_delimited_roundtrip_blank_becomes_null(spark, frame, rows, tmp_path):
    path = str(tmp_path / "out")
    writers.write_delimited(frame("a b", [("1", ""), ("2", None), ("3", "x|y")]), path)
    back = readers.read_feed(spark, path, ["a", "b"], sep="~")
    assert rows(back) == sorted([("1", None), ("2", None), ("3", "x|y")], key=repr)
    with pytest.raises(Exception, match="(?i)exists"):
        writers.write_delimited(frame("a b", [("1", "")]), path)


def test_feed_schema_is_positional(spark, tmp_path):
    path = tmp_path / "feed"
    path.write_text("|".join(f"v{i}" for i in range(len(PAYMENT_FEED))) + "\n")
    feed = readers.read_feed(spark, str(path), PAYMENT_FEED)
    assert feed.columns == list(PAYMENT_FEED)
    assert feed.first()["cell_id"] == "v9"


def test_header_csv(spark, frame, tmp_path):
    path = str(tmp_path / "h")
    frame("a b c", [("1", "2", "3")]).write.option("sep", ";").option("header", True).csv(path)
    assert tuple(readers.read_header_csv(spark, path, ["c", "a"]).first()) == ("3", "1")


def test_rename_checks_the_count(frame):
    with pytest.raises(ValueError, match="2 names for 1 columns"):
        readers.rename(frame("a", [("1",)]), ["x", "y"])


def test_dates_are_replaced_one_by_one(spark, frame, rows, tmp_path):
    path = str(tmp_path / "dated")
    writers.write_by_date(frame("v event_date", [("a", "d1"), ("b", "d2")]), path)
    writers.write_by_date(frame("v event_date", [("c", "d2")]), path)
    assert rows(spark.read.parquet(path)) == [("a", "d1"), ("c", "d2")]


def test_audit_counts_during_the_write(spark, frame, tmp_path):
    run = audit.Run("job")
    counted = run.count(frame("a", [("1",), ("2",)]), "input")
    counted = run.count(counted.filter("a = '1'"), "output")
    writers.write_delimited(counted, str(tmp_path / "o"))
    record = run.record(spark).first()
    assert record.counts == {"input": 2, "output": 1}
    assert record.duration_sec >= 0


class Conf:
    def __init__(self, folder=None):
        self.folder = folder

    def get(self, key, default):
        assert key == "spark.checkpoint.dir"
        return self.folder or default


class Cluster:
    class sparkContext:
        master, applicationId = "spark://host:7077", "app"

    def __init__(self, folder=None):
        self.conf = Conf(folder)


def test_scratch_is_the_configured_folder():
    assert scratch_dir(Cluster("hdfs://shared/tmp/")) == "hdfs://shared/tmp"


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(RuntimeError, match="checkpoint"):
        scratch_dir(Cluster())


def test_staged_data_is_in_the_scratch_folder(spark):
    staged = stage(spark.range(5), "x")
    assert staged.count() == 5 and scratch_dir(spark) in staged.inputFiles()[0]


def test_partition_values_keep_their_type(spark, frame, rows, tmp_path):
    for write, name in ((writers.write_routed, "r"), (writers.write_by_date, "d")):
        path = str(tmp_path / name)
        write(frame("part v", [("01", "a"), ("02", "b"), ("2023-01-01", "c")]), path, "part")
        back = readers.read_partitioned(spark, path)
        assert back.dtypes == [("part", "string"), ("v", "string")]
        assert rows(back) == [("01", "a"), ("02", "b"), ("2023-01-01", "c")]
        assert rows(back.filter("part = '01'")) == [("01", "a")]
    assert spark.read.parquet(path).count() == 3  # the declared schema is no data
    writers.write_by_date(frame("part v", [("02", "x")]), path, "part")
    assert rows(readers.read_partitioned(spark, path)) == [("01", "a"), ("02", "x"), ("2023-01-01", "c")]


def test_failed_attempts_leave_nothing_and_reruns_replace(spark, frame, rows, tmp_path):
    folder, feed = str(tmp_path / "job"), frame("k v", [("g", "1"), ("g", "2"), ("b", "3")])

    def build(given, broken=False):
        bad = given.filter("k = 'b'")
        if broken:
            bad = bad.withColumn("v", F.raise_error(F.lit("half-way")).cast("string"))
        return {"GOOD": given.filter("k = 'g'"), "BAD": bad}

    assert commit.commits(spark, folder).count() == 0 and commit.read_route(spark, folder, "GOOD") is None
    with pytest.raises(Exception, match="half-way"):
        commit.run_audited(spark, folder, "j", "r1", lambda given: build(given, True), given=feed)
    assert commit.read_route(spark, folder, "GOOD") is None
    commit.run_audited(spark, folder, "j", "r1", build, given=feed)
    assert rows(commit.read_route(spark, folder, "GOOD"), "v", "run_id") == [("1", "r1"), ("2", "r1")]
    # A rerun on another feed that fails half-way changes nothing; one that ends replaces.
    more = frame("k v", [("g", "9"), ("b", "8"), ("b", "7")])
    with pytest.raises(Exception, match="half-way"):
        commit.run_audited(spark, folder, "j", "r1", lambda given: build(given, True), given=more)
    assert rows(commit.read_route(spark, folder, "GOOD"), "v") == [("1",), ("2",)]
    commit.run_audited(spark, folder, "j", "r1", build, given=more)
    assert rows(commit.read_route(spark, folder, "GOOD"), "v") == [("9",)]
    commit.run_audited(spark, folder, "j", "r2", build, given=feed)
    assert rows(commit.read_route(spark, folder, "BAD"), "v", "run_id") == [("3", "r2"), ("7", "r1"), ("8", "r1")]
    counts = {r.run_id: (r.inputs, r.routes) for r in commit.commits(spark, folder).collect()}
    assert counts == {"r1": ({"given": 3}, {"GOOD": 1, "BAD": 2}), "r2": ({"given": 3}, {"GOOD": 2, "BAD": 1})}
