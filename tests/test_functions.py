import pytest
from pyspark.sql import functions as F

from cdrmill.functions import amounts, text, times
from cdrmill.operators import locate, product


def values(spark, expr, inputs, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, c {kind}")
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def test_zero_stripping(spark):
    given = ["007", "0", "70", "", None]
    assert values(spark, text.strip_one_zero("c"), given) == ["07", "", "70", "", None]
    assert values(spark, text.strip_zeros("c"), given) == ["7", "", "70", "", None]


def test_before_marker(spark):
    assert values(spark, text.before("c", "#"), ["a#b#c", "#b", "ab", "", None]) == ["a", "", "", "", None]


def test_fixed_width(spark):
    assert values(spark, text.fixed("c", 4, drop=5), ["51010xx", "5101", None]) == ["10", "", None]
    assert values(spark, text.mcc("c"), ["51010xx"]) == ["510"]
    assert values(spark, text.suffix_key("c"), ["12345", "12", None]) == ["12345_2345", "12_12", None]


def test_packing_is_null_when_a_part_is(spark):
    assert values(spark, text.pack("|", "c", F.lit("x")), ["a", None]) == ["a|x", None]
    assert values(spark, text.part("c", "#", 1), ["0#id", "-1#-99 ", "0"]) == ["id", "-99 ", None]


def test_amounts_never_raise(spark):
    assert values(spark, amounts.number("c"), ["12.5", "x", "", None]) == [12.5, None, None, None]
    assert values(spark, amounts.price_or_zero("c"), ["NQ", None, "5"]) == ["0", "0", "5"]
    assert values(spark, amounts.signed_usage("c", F.lit("C")), ["12.5", None]) == [-12.5, 0.0]
    signed = amounts.signed_recharge("c", F.lit("BTSOURCE"), F.lit("D"))
    assert values(spark, signed, ["7"]) == [-7.0]


def test_event_time(spark):
    given = ["20230120235634", "malformed", None]
    ts = times.event_time("c")
    assert values(spark, times.day(ts), given) == ["2023-01-20", None, None]
    assert values(spark, times.hour(ts), given) == ["23", None, None]
    assert values(spark, times.hour(ts, starts_early=True), given) == [" 2", None, None]
    assert values(spark, times.compact_date("c"), ["2023-01-20"]) == ["20230120"]


def test_expiry(spark):
    now = F.lit("20230120235634")
    given = ["20240131000000", "bad", None]
    open_ended = "2999-12-31 23:59:59"
    assert values(spark, times.expiry(now, "c"), given) == ["2024-01-31 00:00:00", open_ended, open_ended]
    literal = times.expiry(now, "c", from_event_time=True)
    assert values(spark, literal, given) == ["2023-01-20 23:56:34"] * 2 + [open_ended]


@pytest.mark.parametrize(
    ("plan", "topping", "first", "offer"),
    [
        ("SA10359", "T", "F1", "F1"),
        (None, "T", "F1", "T"),
        ("P", None, "F1", "P"),
        ("P", "T", "F1", "P"),
        (None, None, "F1", None),
    ],
)
def test_offer(frame, plan, topping, first, offer):
    df = frame("plan topping first", [(plan, topping, first)])
    chosen = product.resolve_offer("plan", "topping", "SA10359", "first")
    assert df.select(chosen).first()[0] == offer


PAYMENT_CELL = "510106123400012340" + "99"


@pytest.mark.parametrize(
    ("code", "cell", "key"),
    [
        ("129", "4000123_4099", "4000123|4099"),
        ("128", PAYMENT_CELL, PAYMENT_CELL),
        ("1", "6123_400012340" + "99", "6123|40001234099"),
        (None, "6123_400012340" + "99", "6123|40001234099"),
    ],
)
def test_payment_cell(frame, code, cell, key):
    # Characters 5-9 are "06123": one leading zero goes.
    df = frame("cell_id indicator_4g", [(PAYMENT_CELL, code)])
    assert tuple(locate.payment_cell(df).select("cell_id", "trx_lacci").first()) == (cell, key)


@pytest.mark.parametrize(
    ("code", "raw", "key"),
    [("130", False, "70000|809"), ("131", False, "1234|00700"), ("131", True, " 51010012340070000809"), ("x", True, "1234|00700")],
)
def test_usage_cell_key(frame, code, raw, key):
    df = frame("cell code", [(" 51010012340070000809", code)])
    assert df.select(locate.usage_cell_key("cell", "code", cgi_is_raw=raw)).first()[0] == key


def test_service_groups(spark):
    given = ["1_VOICE", "2_SMS", "3_DATA", "5_VAS", "4_X", "12_X", None]
    assert values(spark, product.service_group("c"), given) == ["s1", "s2", "s3", "s5", "sR", "sR", "sR"]


def test_taxonomy(frame):
    df = frame(
        "l1 l2 l3 l4 source note",
        [
            ("Voice P2P", "Internal MO Call", "Local", "a", "payd", " 12 "),
            ("UNKNOWN", "SMS Non P to P", "Volume Based", "b", "PAYD", "13"),
            ("x", "y", "z", "c", "other", "14"),
        ],
    )
    found = sorted(tuple(r) for r in product.prepaid_lines(df).select("trim_note", "l1", "l2", "l3").collect())
    assert found == [
        ("12", "Voice P2P", "Internal MO Call", "Local (On-Net)"),
        ("13", "Others", "SMS Non P2P", "Volume based"),
    ]
