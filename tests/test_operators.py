import pytest
from pyspark.sql import functions as F

from cdrmill.operators import duplicates, enrich, locate, marts, quality, state
from cdrmill.operators.enrich import HISTORY_DEFAULTS
from cdrmill.sentinels import USAGE_SENTINELS


def test_subscriber_defaults(frame, rows):
    facts = frame("msisdn", [("1",), ("2",), ("3",), (None,)])
    dim = frame("msisdn subs_id kind", [("1", "S1", "B2C"), ("2", "S2", None), ("2", "S3", "x")])
    defaults = {"subs_id": "-99", "kind": "UNKNOWN"}
    strict = enrich.enrich_subscriber(facts, dim, defaults)
    assert rows(strict) == sorted(
        [("1", "S1", "B2C"), ("2", "S2", None), ("3", "-99", "UNKNOWN"), (None, "-99", "UNKNOWN")], key=repr
    )
    filled = enrich.enrich_subscriber(facts, dim, defaults, null_attributes_too=True)
    assert ("2", "S2", "UNKNOWN") in rows(filled)
    assert enrich.enrich_subscriber(facts, dim, defaults, unique=False).count() == 5


@pytest.mark.parametrize("spread", [(), ("id",)])
def test_history_fallback(frame, rows, spread):
    facts = frame(
        "id subs_id trx_lacci",
        [("1", "S1", "own"), ("2", "S1", None), ("3", "S2", None), ("4", "S9", None), ("5", "S1", "|"), ("6", "S1", "m1"), ("7", "-99", "")],
    )
    mtd = frame("subs_id_mtd lacci_id_mtd", [("S1", "m1"), ("S1", "m0")])
    mm = frame("subs_id_mm lacci_id_mm", [("S1", "p1"), ("S2", "p2")])
    intended = enrich.fill_location_from_history(facts, mtd, mm, spread_by=spread)
    assert rows(intended, "id", "trx_lacci", "find_flag") == [
        ("1", "own", "0"), ("2", "m0", "1#"), ("3", "p2", "2#"), ("4", "-99", "0"),
        ("5", "m0", "1#"), ("6", "m1", "0"), ("7", "-99", "0"),
    ]
    literal = enrich.fill_location_from_history(
        facts.filter("id = '5' or id = '6'"), mtd.filter("lacci_id_mtd = 'm1'"), mm, blank_blocks=True, flag_on_equal_id=True
    )
    assert rows(literal, "id", "trx_lacci", "find_flag") == [("5", "", "0"), ("6", "m1", "1#")]


MASTER = "lacci_id eci cgi_post area_sales lac ci node region_sales branch subbranch cluster_sales provinsi kabupaten kecamatan kelurahan"


def cell(name, area="AREA", **keys):
    return (
        keys.get("lacci", f"l_{name}"), keys.get("eci", f"e_{name}"), keys.get("cgi", f"c_{name}"), area,
        *[f"{c}_{name}" for c in MASTER.split()[4:]],
    )


def test_location_index_takes_the_first_key_that_holds(frame, rows):
    # "x" is the eci of one cell and the lacci_id of another.
    master = frame(MASTER, [cell("1", eci="x"), cell("2", lacci="x"), cell("3", cgi="g"), cell("4", cgi="g")])
    facts = frame("id trx_lacci", [("1", "x"), ("2", "e_2"), ("3", "g"), ("4", "none"), ("5", None)])
    take = {"where": "lacci_id", "lac": "lac"}
    keys = ("lacci_id", "eci", "cgi_post")
    one_pass = locate.lookup_location(facts, locate.location_index(master, keys, take))
    expected = [("1", "x", True), ("2", "x", True), ("3", "l_3", True), ("4", None, False), ("5", None, False)]
    assert rows(one_pass, "id", "where", "location_found") == expected
    stepwise = locate.lookup_location_stepwise(facts, master, keys, take)
    assert rows(stepwise, "id", "where", "location_found") == expected


def test_location_index_keeps_duplicates_where_asked(frame, rows):
    master = frame(MASTER, [cell("1", lacci="x"), cell("2", lacci="x"), cell("3", cgi="g"), cell("4", cgi="g")])
    facts = frame("id trx_lacci", [("1", "x"), ("2", "g")])
    take = {"lac": "lac"}
    keys = ("lacci_id", "eci", "cgi_post")
    fanned = locate.lookup_location(facts, locate.location_index(master, keys, take, unique=("cgi_post",)))
    assert rows(fanned, "id", "lac") == [("1", "lac_1"), ("1", "lac_2"), ("2", "lac_3")]
    stepwise = locate.lookup_location_stepwise(facts, master, keys, take, unique=("cgi_post",))
    assert rows(stepwise, "id", "lac") == rows(fanned, "id", "lac")


def test_closing_flag(frame, rows):
    df = frame(
        "id trx_lacci lacci_id_laccima area_name find_flag found",
        [("1", "k", "m", "A", "0", "y"), ("2", "k", "m", "A", "1#", "y"), ("3", "k", "m", "UNKNOWN", "0", "y"),
         ("4", "-99", None, None, "0", None), ("5", "k", "m", None, "2#", "y")],
    ).withColumn("location_found", F.col("found").isNotNull())
    assert rows(locate.closing_flag(df), "id", "lacci_closing_flag", "lacci_id") == [
        ("1", "0", "m"), ("2", "1", "k"), ("3", "-1", "-99 "), ("4", "-1", "-99 "), ("5", "-1", "-99 "),
    ]


def history(df, prefix, area, flag):
    names = {f"{prefix}_{c}": F.lit(f"{prefix}_{c}") for c in HISTORY_DEFAULTS}
    return df.withColumns(names).withColumns({f"{prefix}_area_name": area, f"{prefix}_flag": flag})


@pytest.fixture
def cascade_input(frame):
    """Records by (own cell, MTD area, MM area); area None: no history."""
    data = [
        ("1", "l_1", "A", "A"), ("2", "l_u", "A", "A"), ("3", "none", "UNKNOWN", "A"), ("4", "none", None, "A"),
        ("5", "l_u", None, None), ("6", None, None, None), ("7", "none", "UNKNOWN", None), ("8", "|", "A", None),
    ]
    df = frame("id trx_lacci mtd mm", data).withColumn("kind", F.lit("lacci_id"))
    for p in ("mtd", "mm"):
        flag = F.when(F.col(p).isNull(), F.lit("0")).otherwise(F.lit("1"))
        df = history(df, p, F.col(p), flag)
    master = frame(MASTER, [cell("1"), cell("u", area=None)])
    return locate.match_location(df, master, kind="kind", spread_by=["id"])


def test_cascade(cascade_input, rows):
    done = locate.resolve_location_cascade(cascade_input)
    assert rows(done, "id", "lacci_closing_flag", "lacci_id", "area_sales", "branch") == [
        ("1", "0", "l_1", "AREA", "branch_1"),
        ("2", "1", "mtd_lacci_id", "UNKNOWN", "branch_u"),
        ("3", "2", "mm_lacci_id", "UNKNOWN", "mtd_branch"),
        ("4", "2", "mm_lacci_id", "A", "mm_branch"),
        ("5", "-1", "-99", "UNKNOWN", "branch_u"),
        ("6", "-1", "-99", "NQ", "NQ"),
        ("7", "-1", "-99", "UNKNOWN", "mtd_branch"),
        ("8", "1", "mtd_lacci_id", "A", "mtd_branch"),
    ]


def test_overwriting_cascade_loses_the_unknown_area_match(cascade_input, rows):
    done = locate.resolve_location_overwriting(cascade_input, "kind")
    # Record 2 and 5 match a cell of unknown area: their key column is
    # overwritten, so the names no longer come from that cell.
    found = {r[0]: r[1:] for r in rows(done, "id", "lacci_closing_flag", "lacci_id", "area_sales", "branch")}
    assert found["1"] == ("0", "l_1", "AREA", "branch_1")
    assert found["2"] == ("1", "mtd_lacci_id", "A", "mtd_branch")
    assert found["5"] == ("-1", "-99", "NQ", "NQ")


def test_quarantine(frame):
    df = frame("a b", [(None, None), (None, ""), ("x", None)])
    good, bad = quality.quarantine_bad(df, ["a", "b"])
    assert (good.count(), bad.count()) == (2, 1)


@pytest.mark.parametrize("column", list(USAGE_SENTINELS))
@pytest.mark.parametrize("gap", ["null", "blank", "sentinel"])
def test_each_gap_rejects(spark, column, gap):
    row = {c: "value" for c in USAGE_SENTINELS}
    row[column] = {"null": None, "blank": "  ", "sentinel": USAGE_SENTINELS[column]}[gap]
    df = spark.range(1).select(*[F.lit(v).cast("string").alias(c) for c, v in row.items()])
    assert quality.reject_if_any_missing(df, USAGE_SENTINELS).first().status_data == "REJECT"


def test_first_missing_looks_at_one_value_only(frame, rows):
    df = frame("a b", [("x", "NQ"), (None, "NQ"), (None, None), ("-99", "y")])
    assert rows(quality.reject_if_first_missing(df, ["a", "b"]), "a", "b", "status_reject") == sorted(
        [("x", "NQ", "NO"), (None, "NQ", "YES"), (None, None, "YES"), ("-99", "y", "YES")], key=repr
    )


def test_control_totals_period(frame):
    df = frame("event_date filename status_data status amount", [("2023-01-20 10:00:00", "f", "GOOD", "NODUP", "1.5")] * 2)
    options = dict(amount="amount", job_id="j", group_process="1", filetype="t")
    total = quality.control_totals(df, **options).first()
    assert (total.periode, total.qty, total.rev) == ("20230120", 2, 3.0)
    assert quality.control_totals(df, keep_dashes=True, **options).first().periode == "2023-01-20 10:00:00"


def test_recharge_duplicate_routes(spark, rows):
    data = [
        ("f", 1, "NODUP", "t1", "m", "x"), ("f", 1, "NODUP", "t1", "m", "y"),  # one record, fanned out
        ("f", 2, "NODUP", "t1", "m", "x"), ("f", 3, "NODUP", "t2", "m", "x"), ("f", 4, "DUP", "t2", "m", "x"),
        ("f", 5, "NODUP", None, None, "x"), ("f", 6, "NODUP", None, None, "x"),
    ]
    df = spark.createDataFrame(data, "filename string, rec_id int, status string, timestamp_r string, msisdn string, z string")
    df = df.withColumns({"account": F.lit("a"), "delta_balance": F.lit("1"), "event_date": F.col("timestamp_r")})
    for hot_rows in (None, 1):
        routed = duplicates.route_recharge_duplicates(df, ["z"], hot_rows=hot_rows)
        assert rows(routed, "rec_id", "z", "route", "status") == [
            (1, "x", "UNIQUE", "NODUP"), (1, "y", "DUP03", "DUP"), (2, "x", "DUP02", "DUP"), (3, "x", "UNIQUE", "NODUP"),
            (4, "x", "DUP01", "DUP"), (5, "x", "UNIQUE", "NODUP"), (6, "x", "DUP02", "DUP"),
        ]


def test_region_names(frame, rows):
    df = frame("r", [("Bali-Nusra",), ("BALI NUSRA",), ("PUMA",), ("other",), (None,)])
    assert sorted(str(r[0]) for r in df.select(marts.normalise_region("r")).collect()) == [
        "BALINUSRA", "BALINUSRA", "None", "PAPUA", "other",
    ]


def test_state_merge(spark, frame, rows):
    sources = {"lacci_id": "lacci_id"}
    old = frame(
        "msisdn subs_id chg_lacci_id chg_flag usg_lacci_id usg_flag ifrs_lacci_id ifrs_flag",
        [("1", "S1", "c1", None, "u1", "2", "i1", None), ("2", "S2", "c2", "1", "u2", None, "i2", "3"), (None, "S4", "c4", "1", "u4", "1", "i4", "1")],
    )
    new = frame("msisdn subs_id lacci_id", [("1", "S1", "d1"), ("3", "S3", "d3"), (None, "S4", "d4"), ("5", None, "d5")])
    merged = state.merge_daily_state(old, new, sources)
    assert rows(merged) == sorted(
        [
            ("1", "S1", "d1", "1", "u1", "2", "d1", "0"),
            ("2", "S2", "c2", "1", "u2", "0", "i2", "3"),
            ("3", "S3", "d3", "1", "", "1", "", "1"),
            (None, "S4", "c4", "1", "u4", "1", "i4", "1"),
            (None, None, None, "0", None, "0", None, "0"),
            (None, None, None, "0", None, "0", None, "0"),
        ],
        key=repr,
    )


def test_split_by_keeps_all_rows(frame):
    from cdrmill.operators.quality import split_by

    df = frame("route", [("a",), ("b",), (None,), ("z",)])
    parts = split_by(df, "route", ("a", "b"), rest="rest")
    assert {k: v.count() for k, v in parts.items()} == {"a": 1, "b": 1, "rest": 2}
    assert split_by(df, "route", (), rest="rest")["rest"].count() == 4


@pytest.mark.parametrize("small", [True, False])
@pytest.mark.parametrize("unique", [True, False])
@pytest.mark.parametrize("names", [("home", "kind"), ("kind",)])
def test_sums_through_a_lookup(spark, rows, small, unique, names):
    from cdrmill.operators.early_sums import sum_through_lookup
    from cdrmill.operators.lookup import lookup

    facts = spark.range(900).selectExpr(
        "if(id % 3 = 0, 'hot', if(id % 7 = 0, null, cast(id % 40 AS string))) AS k", "cast(id % 2 AS string) AS kind",
        "1 AS n", "if(id % 5 = 0, null, id) AS v",
    )
    dim = spark.createDataFrame([("hot", "H"), ("hot", "A"), ("1", "one"), ("5", None), (None, "x")], "dk string, name string")
    derived = {"home": F.when(F.col("_hit"), F.coalesce("_name", F.lit("-"))).otherwise(F.lit("none"))}
    derived = {k: v for k, v in derived.items() if k in names}
    found = lookup(facts, dim, {"k": "dk"}, {"_name": "name"}, hit="_hit", unique=unique)
    plain = found.withColumns(derived).groupBy(*names).agg(F.sum("n").alias("n"), F.sum("v").alias("v"))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    if not small:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        summed = sum_through_lookup(
            facts, dim, {"k": "dk"}, {"_name": "name"}, derived, names, ("n", "v"), hit="_hit", unique=unique, hot_rows=2
        )
        assert summed.columns == plain.columns and rows(summed) == rows(plain)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
