import random
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cdrmill.operators import skew
from cdrmill.operators.lookup import is_spread, lookup, spread_key
from cdrmill.operators.salted import KeyCounts, add_salt, is_small, replicate


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows under one key, some null keys and values, ties."""
    rng = random.Random(7)
    data = []
    for i in range(3000):
        key = "hot" if i % 3 == 0 else None if i % 11 == 0 else f"k{rng.randrange(40)}"
        value = None if i % 17 == 0 else rng.randrange(400)
        data.append((i, key, value, rng.choice("abc")))
    return spark.createDataFrame(data, "id int, k string, v int, w string").cache()


@pytest.mark.parametrize("hot_rows", [50, 500, 10_000, None])
def test_dense_rank_is_exact_whatever_is_hot(skewed, rows, hot_rows):
    expected = skewed.withColumn("r", F.dense_rank().over(Window.partitionBy("k").orderBy("v", "w")))
    ranked = skew.dense_rank_by(skewed, ["k"], ["v", "w"], "r", hot_rows)
    assert rows(ranked, "id", "r") == rows(expected, "id", "r")
    assert ranked.columns == [*skewed.columns, "r"]


def test_hot_keys_are_cut_into_pieces(skewed):
    plan = skew.dense_rank_by(skewed, ["k"], ["v", "w"], "r", 500)._jdf.queryExecution().toString()
    assert "_piece" in plan
    assert "_piece" not in skew.dense_rank_by(skewed, ["k"], ["v"], "r", None)._jdf.queryExecution().toString()


def test_shares_follow_the_counts(spark, skewed):
    assert [tuple(r) for r in skew.key_shares(skewed, ["k"], 500).collect()] == [("hot", 2)]
    assert skew.key_shares(skewed, ["k"], 5000) is None
    shares = {r.k: r._shares for r in skew.key_shares(skewed, ["k"], 20).collect()}
    assert None in shares and shares["hot"] == 50 and len(shares) > 30


def test_shares_never_exceed_what_is_broadcast(skewed, monkeypatch):
    monkeypatch.setattr(skew, "SPLIT_KEYS", 5)
    found = skew.key_shares(skewed, ["k"], 2).collect()
    assert 1 <= len(found) <= 5 and max(r._shares for r in found) == 2


@pytest.mark.parametrize("order", [["v"], ["id"], ["v", "w", "id"]])
def test_many_pieces(spark, rows, order):
    """4,000 rows of one key in pieces of 20: far over 65 of them."""
    df = spark.range(4000).selectExpr("id", "'hot' AS k", "int(id * 7919 % 4001) AS v", "string(id % 3) AS w")
    cuts, most = skew.cut_points(df, ["k"], order, 20)
    assert most > 150 and cuts.count() == 1
    expected = df.withColumn("r", F.dense_rank().over(Window.partitionBy("k").orderBy(*order)))
    assert rows(skew.dense_rank_by(df, ["k"], order, "r", 20), "id", "r") == rows(expected, "id", "r")


def test_rows_are_copied_with_few_cuts(spark, rows):
    """A join brings a block of cuts, not all of the key's: 200 of them here."""
    df = spark.range(4000).selectExpr("id", "'hot' AS k", "int(id * 7919 % 4001) AS v")
    cuts, most = skew.cut_points(df, ["k"], ["v"], 20)
    assert most > 2 * skew.BLOCK
    placed = skew._place(df, cuts, ["k"], F.struct("v"))
    known = sorted(c._value.v for c in cuts.first()._cuts)
    for r in placed.collect():
        below = sum(c < r.v for c in known)
        assert (r._below, r._own is not None) == (below, r.v in known)
    # Neither as one array nor searched by a function over it.
    plan = skew.dense_rank_by(df, ["k"], ["v"], "r", 20)._jdf.queryExecution().optimizedPlan().toString()
    assert "aggregate(" not in plan and "inline(" in plan and "AS _lasts" in plan


def test_pieces_are_bounded(spark, rows, monkeypatch):
    df = spark.range(4000).selectExpr("id", "string(id % 2) AS k", "int(id * 7919 % 4001) AS v")
    monkeypatch.setattr(skew, "PIECES", 40)
    sizes, picked = [], skew.cut_points
    monkeypatch.setattr(skew, "cut_points", lambda *a: sizes.append(a[3]) or picked(*a))
    expected = df.withColumn("r", F.dense_rank().over(Window.partitionBy("k").orderBy("v")))
    assert rows(skew.dense_rank_by(df, ["k"], ["v"], "r", 20), "id", "r") == rows(expected, "id", "r")
    assert sizes == [100]


def test_one_record_repeats_past_a_piece(spark, rows, monkeypatch):
    """Three quarters of a key's rows agree in all ordering columns: their rank
    is known without an order, so they are dealt to many tasks."""
    df = spark.range(4000).selectExpr("id", "'hot' AS k", "if(id % 4 = 0, int(id), 1001) AS v", "if(id % 4 = 1, null, 'x') AS w")
    (row,) = skew.cut_points(df, ["k"], ["v", "w"], 50)[0].collect()
    own = {(c._value.v, c._value.w): c._own for c in row._cuts}
    assert own[(1001, None)] >= 15 and own[(1001, "x")] >= 30
    expected = df.withColumn("r", F.dense_rank().over(Window.partitionBy("k").orderBy("v", "w")))
    assert rows(skew.dense_rank_by(df, ["k"], ["v", "w"], "r", 50), "id", "r") == rows(expected, "id", "r")


def test_cut_points_are_bounded_in_bytes(spark, rows):
    df = spark.range(3000).selectExpr("id", "'hot' AS k", "lpad(string(id), 200, 'x') AS wide")
    assert skew.cut_points(df, ["k"], ["wide"], 20)[1] > 100
    cuts, most = skew.cut_points(df, ["k"], ["wide"], 20, cut_bytes=5_000)
    assert 5 < most < 30
    expected = df.withColumn("r", F.dense_rank().over(Window.partitionBy("k").orderBy("wide")))
    ranked = skew.dense_rank_by(df, ["k"], ["wide"], "r", 20, cut_bytes=5_000)
    assert rows(ranked, "id", "r") == rows(expected, "id", "r")


def test_keep_one_ignores_arrival(skewed, rows):
    once = skew.keep_one(skewed, ["k"], ["v"])
    again = skew.keep_one(skewed.orderBy(F.desc("id")).repartition(3), ["k"], ["v"])
    assert rows(once) == rows(again)
    brute = {}
    for r in skewed.collect():
        rank = (r.v is None, r.v or 0, r.id)
        if r.k not in brute or rank < brute[r.k][0]:
            brute[r.k] = (rank, r.id)
    assert sorted((r.k or "", r.id) for r in once.collect()) == sorted(
        (k or "", i) for k, (_, i) in brute.items()
    )


@pytest.fixture
def feed(spark, tmp_path):
    """Rows in files of their own, in order of the files."""
    spark.range(0, 5000, 1, 7).selectExpr("id", "id % 3 AS part").write.parquet(str(tmp_path / "feed"))
    return str(tmp_path / "feed")


def test_arrivals_are_numbered_by_file(spark, feed):
    for name in ("1", "1k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", "128m" if name == "1" else "3k")
        numbered = skew.arrivals(spark.read.parquet(feed).filter("part <> 1"), "n", 10)
        found = sorted(tuple(r) for r in numbered.rows.select("n", "id").collect())
        kept = [i for i in range(5000) if i % 3 != 1]
        assert found == list(zip(range(10, 10 + len(kept)), kept))
        numbered.check()
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_numbering_writes_nothing(spark, feed, monkeypatch):
    def refuse(*_):
        raise AssertionError("staged")

    monkeypatch.setattr(skew, "stage", refuse)
    assert skew.number_arrivals(spark.read.parquet(feed), "n").agg(F.max("n")).first()[0] == 5000


def test_changed_feeds_fail(spark, tmp_path):
    """As many bytes as were listed, but more rows than were counted."""
    (tmp_path / "a.csv").write_text("1234567\n" * 10)
    numbered = skew.arrivals(spark.read.schema("v string").csv(str(tmp_path)), "n")
    assert numbered.rows.agg(F.max("n")).first()[0] == 10
    (tmp_path / "a.csv").write_text("1\n" * 40)
    with pytest.raises(Exception, match="the feed changed while it was being numbered"):
        numbered.rows.write.format("noop").mode("overwrite").save()


def test_missing_rows_show_in_the_check(spark, feed):
    numbered = skew.arrivals(spark.read.parquet(feed), "n")
    numbered.expected += 1
    numbered.rows.count()
    with pytest.raises(RuntimeError, match="5000 rows were numbered, 5001"):
        numbered.check()


@pytest.mark.parametrize("hot_rows", [50, skew.HOT_ROWS])
def test_numbers_by_order(skewed, hot_rows):
    ordered = skew.number_by(skewed, ["v", "id"], "n", start=10, hot_rows=hot_rows).collect()
    by_order = sorted(ordered, key=lambda r: (r.v is not None, r.v or 0, r.id))
    assert [r.n for r in by_order] == list(range(10, 3010))


@pytest.fixture(scope="module")
def dimension(spark):
    data = [("hot", "H2"), ("hot", "H1"), (None, "N")] + [(f"k{i}", f"K{i}") for i in range(0, 40, 2)]
    return spark.createDataFrame(data, "dk string, name string")


@pytest.fixture
def no_broadcast(spark):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


@pytest.mark.parametrize("unique", [True, False])
@pytest.mark.parametrize("hot_rows", [None, 3, 20, 500, 10_000])
def test_salted_lookup_equals_plain_lookup(skewed, dimension, rows, no_broadcast, unique, hot_rows):
    plain = skewed.join(
        (skew.keep_one(dimension, ["dk"]) if unique else dimension), F.col("k") == F.col("dk"), "left"
    ).select("id", "name", F.col("dk").isNotNull().alias("found"))
    counts = KeyCounts(skewed, ["k"], hot_rows)
    options = dict(hit="found", unique=unique, spread_by=["id"], counts=counts)
    found = lookup(skewed, dimension, {"k": "dk"}, {"name": "name"}, **options)
    assert found.columns == [*skewed.columns, "name", "found"]
    assert rows(found, "id", "name", "found") == rows(plain)


def test_salts_follow_the_counts(skewed):
    salts = {r.k: r._salts for r in KeyCounts(skewed, ["k"], 20).salts.collect()}
    counts = {r.k: r["count"] for r in skewed.groupBy("k").count().collect()}
    assert salts == {k: -(-n // 20) for k, n in counts.items() if k is not None and n > 20}
    assert salts["hot"] == 50 and KeyCounts(skewed, ["k"], 2_000).salts is None
    assert KeyCounts(skewed, ["k"], None).salts is None
    salted = add_salt(skewed, KeyCounts(skewed, ["k"], 20), ["id"])
    per_salt = salted.filter("k is not null").groupBy("k", "_salted_k").count().agg(F.max("count")).first()[0]
    assert per_salt < 3 * 20
    hot = salted.filter("k = 'hot'").select("_salted_k").distinct()
    assert sorted(r[0] for r in hot.collect()) == sorted(f"\u0001{i}\u0001hot" for i in range(50))


def test_more_groups_than_any_constant(spark, rows, no_broadcast):
    """4,000 records without a key and 4,000 of one key: 2,000 salts of the
    key, whose 20 dimension rows become 40,000; each keyless record is alone."""
    facts = spark.range(8_000).selectExpr("id", "CASE WHEN id % 2 = 0 THEN 'hot' END AS k")
    dim = spark.range(20).selectExpr("'hot' AS dk", "cast(id AS string) AS name")
    counts = KeyCounts(facts, ["k"], 2)
    salted = add_salt(facts, counts, ["id"])
    groups = salted.groupBy(F.col("k").isNull()).agg(F.countDistinct("_salted_k").alias("n")).collect()
    assert {r[0]: r.n for r in groups}[True] == 4_000 and {r[0]: r.n for r in groups}[False] > 1_500
    assert replicate(dim, counts, {"k": "dk"}, "salt").count() == 20 * 2_000
    found = lookup(facts, dim, {"k": "dk"}, {"name": "name"}, unique=False, spread_by=["id"], counts=counts)
    assert found.count() == 4_000 + 4_000 * 20
    assert found.filter("k is not null").groupBy("id").agg(F.countDistinct("name").alias("n")).filter("n <> 20").count() == 0


def test_composite_keys_are_counted_together(spark, rows, no_broadcast):
    facts = spark.range(600).selectExpr("id", "cast(id % 2 AS string) AS a", "if(id % 3 = 0, 'x', cast(id AS string)) AS b")
    dim = spark.createDataFrame([("0", "x", "0x"), ("1", "x", "1x"), ("1", "5", "15")], "da string, db string, name string")
    counts = KeyCounts(facts, ["a", "b"], 10)
    assert {(r.a, r.b): r._salts for r in counts.salts.collect()} == {("0", "x"): 10, ("1", "x"): 10}
    plain = facts.join(dim, (F.col("a") == F.col("da")) & (F.col("b") == F.col("db")), "left").select("id", "name")
    for given in (counts, KeyCounts(facts, ["b"], 10), None):
        found = lookup(facts, dim, {"a": "da", "b": "db"}, {"name": "name"}, counts=given)
        assert rows(found, "id", "name") == rows(plain)


def test_keys_of_two_types(spark, rows, no_broadcast):
    facts = spark.range(300).selectExpr("id", "cast(id % 3 AS string) AS k")
    dim = spark.createDataFrame([(0, "zero"), (1, "one")], "n long, name string")
    found = lookup(facts, dim, {"k": "n"}, {"name": "name"}, counts=KeyCounts(facts, ["k"], 10))
    assert rows(found.groupBy("k", "name").count()) == [("0", "zero", 100), ("1", "one", 100), ("2", None, 100)]


def test_salts_reach_the_shuffle(spark, skewed, dimension, no_broadcast):
    """Not the partitioning that the aggregate of the dimension left behind."""
    plan = lookup(skewed, dimension, {"k": "dk"}, {"name": "name"}, counts=KeyCounts(skewed, ["k"], 20))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_salted_k" in text and "hashpartitioning(_d_salted" in text
    assert "hashpartitioning(k#" not in text


def test_counts_only_where_the_dimension_is_large(spark, skewed, dimension):
    counts = KeyCounts(skewed, ["k"], 20)
    plan = lookup(skewed, dimension.limit(3), {"k": "dk"}, {"name": "name"}, counts=counts)
    assert "salts" not in counts.__dict__ and "_salted" not in plan._jdf.queryExecution().toString()
    assert is_small(dimension.limit(3)) and not is_small(spark.range(10**9))


def test_salts_are_counted_in_a_share_of_the_rows(spark):
    df = spark.range(60_000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE cast(id AS string) END AS k")
    (found,) = KeyCounts(df, ["k"], 10_000).salts.collect()
    assert found.k == "hot" and 2 <= found._salts <= 3


def test_spread_keys_match_nothing_and_differ(skewed):
    spread = skewed.filter(F.col("k").isNull()).select(spread_key("k", ["id"]).alias("s"))
    assert spread.filter(~is_spread("s")).count() == 0
    assert spread.distinct().count() == spread.count()


def test_keep_one_takes_filled_values(spark):
    copies = [("k", None, "z"), ("k", "B2C", "y"), ("k", "B2C", None), ("l", None, None)]
    df = spark.createDataFrame(copies, "k string, a string, b string")
    assert sorted(map(tuple, skew.keep_one(df, ["k"]).collect())) == [("k", "B2C", "y"), ("l", None, None)]
