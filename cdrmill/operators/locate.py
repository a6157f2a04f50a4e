"""Cell keys and location resolution."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import as_col, fixed, is_blank, null_to, pack, part, strip_one_zero, strip_zeros, swap
from ..sentinels import (
    CODES_CGI,
    CODES_ECI,
    FLAG_DIRECT,
    FLAG_MM,
    FLAG_MTD,
    FLAG_NONE,
    MISSING_ID,
    NOT_QUALIFIED,
    PACKED_UNRESOLVED,
    UNKNOWN,
)
from .lookup import lookup
from .salted import KeyCounts
from .skew import keep_one

Slice = tuple[int, int | None]


@dataclass(frozen=True)
class CellLayout:
    """Where the two parts of a cell key sit in a raw cell id.

    ``eci`` holds the slices for the 4G codes, ``lacci`` those for all others.
    """

    eci: tuple[Slice, Slice]
    lacci: tuple[Slice, Slice]


# Field positions of the two feeds' cell ids.
PAYMENT_LAYOUT = CellLayout(eci=((10, 7), (17, None)), lacci=((5, 5), (10, None)))
USAGE_LAYOUT = CellLayout(eci=((11, 7), (18, 3)), lacci=((6, 5), (11, 5)))


def by_network(indicator: Column | str, eci: Column, lacci: Column, cgi: Column | None) -> Column:
    """Choose by network indicator; without ``cgi`` its codes count as others."""
    code = as_col(indicator)
    choice = F.when(code.isin(*CODES_ECI), eci)
    if cgi is not None:
        choice = choice.when(code.isin(*CODES_CGI), cgi)
    return choice.otherwise(lacci)


def payment_cell(df: DataFrame, cell: str = "cell_id", indicator: str = "indicator_4g") -> DataFrame:
    """Replace ``cell_id`` by its ``a_b`` form and add ``trx_lacci``, ``a|b``.

    Every part loses one leading zero; CGI codes keep the raw id in both.
    """

    def packed(slices: tuple[Slice, Slice]) -> Column:
        return pack("_", *[strip_one_zero(fixed(cell, *s)) for s in slices])

    eci, lacci = packed(PAYMENT_LAYOUT.eci), packed(PAYMENT_LAYOUT.lacci)
    raw = F.col(cell)
    return df.withColumns(
        {
            "trx_lacci": by_network(indicator, swap(eci, "_", "|"), swap(lacci, "_", "|"), raw),
            cell: by_network(indicator, eci, lacci, raw),
        }
    )


def usage_cell_key(cell: Column | str, indicator: Column | str, *, cgi_is_raw: bool) -> Column:
    """Location key of a usage or recharge record: ``a|b`` without leading
    zeros, or for CGI codes the raw id when ``cgi_is_raw``."""
    trimmed = F.trim(as_col(cell))

    def packed(slices: tuple[Slice, Slice]) -> Column:
        return strip_zeros(pack("|", *[fixed(trimmed, *s) for s in slices]))

    raw = as_col(cell) if cgi_is_raw else None
    return by_network(indicator, packed(USAGE_LAYOUT.eci), packed(USAGE_LAYOUT.lacci), raw)


def usage_cell_id(cell: Column | str, indicator: Column | str) -> Column:
    """Display form of a usage record's cell id; the second part runs to a
    fixed distance from the field's length."""
    eci = pack("_", fixed(cell, 11, 7), fixed(cell, 18, drop=19))
    lacci = pack("_", fixed(cell, 6, 5), fixed(cell, 11, drop=12))
    return by_network(indicator, eci, lacci, None)


# --- Payment: one key tried against three columns of the master ------------


def location_index(
    master: DataFrame,
    keys: Sequence[str],
    take: Mapping[str, str],
    unique: Sequence[str] | None = None,
) -> DataFrame:
    """The master keyed by ``loc_key``: for each key value the rows of the
    first column in ``keys`` that holds it.

    Columns named in ``unique`` (by default all) keep one row per key value;
    the others keep duplicates.
    """
    unique = list(keys) if unique is None else list(unique)
    payload = [F.col(source).alias(name) for name, source in take.items()]
    entries = F.array(
        *[F.struct(F.col(k).alias("loc_key"), F.lit(i).alias("loc_priority")) for i, k in enumerate(keys)]
    )
    index = master.select(F.inline(entries), *payload).filter(F.col("loc_key").isNotNull())
    if set(unique) == set(keys):
        return keep_one(index, ["loc_key"], ["loc_priority"])
    # Rows of the best priority, all of them where duplicates are kept.
    best = index.groupBy("loc_key").agg(F.min("loc_priority").alias("loc_priority"))
    found = index.join(best, ["loc_key", "loc_priority"])
    single = F.col("loc_priority").isin(*[i for i, k in enumerate(keys) if k in unique])
    once = keep_one(found.filter(single), ["loc_key"])
    return once.unionByName(found.filter(~single)) if unique else found


def lookup_location(
    df: DataFrame,
    index: DataFrame,
    location: str = "trx_lacci",
    spread_by: Sequence[str] = (),
    counts: KeyCounts | None = None,
) -> DataFrame:
    """One lookup of ``location`` in a ``location_index``; null where missed."""
    take = {c: c for c in index.columns if c not in ("loc_key", "loc_priority")}
    return lookup(
        df,
        index,
        {location: "loc_key"},
        take,
        hit="location_found",
        unique=False,
        spread_by=spread_by,
        counts=counts,
    )


def lookup_location_stepwise(
    df: DataFrame,
    master: DataFrame,
    keys: Sequence[str],
    take: Mapping[str, str],
    location: str = "trx_lacci",
    unique: Sequence[str] | None = None,
) -> DataFrame:
    """The same by split, join per key and union; kept to test the index."""
    unique = list(keys) if unique is None else list(unique)
    left, done = df, []
    for i, key in enumerate(keys):
        found = lookup(
            left, master, {location: key}, dict(take), hit="location_found", unique=key in unique
        )
        if i == len(keys) - 1:
            done.append(found)
        else:
            done.append(found.filter("location_found"))
            left = found.filter(~F.col("location_found")).drop("location_found", *take)
    return reduce(DataFrame.unionByName, done)


def closing_flag(
    df: DataFrame,
    *,
    location: str = "trx_lacci",
    master_id: str = "lacci_id_laccima",
    area: str = "area_name",
    padded_unresolved_id: bool = True,
) -> DataFrame:
    """Add ``lacci_id_flag`` (packed) and its parts ``lacci_closing_flag`` and
    ``lacci_id``, from ``find_flag`` and ``location_found``."""
    resolved = (
        (F.col(location) != MISSING_ID) & F.col("location_found") & (F.col(area) != UNKNOWN)
    )
    unresolved = PACKED_UNRESOLVED if padded_unresolved_id else PACKED_UNRESOLVED.strip()
    packed = (
        F.when(
            resolved & (F.col("find_flag") == FLAG_DIRECT),
            F.concat(F.lit(f"{FLAG_DIRECT}#"), F.col(master_id)),
        )
        .when(resolved & F.col("find_flag").isNotNull(), F.concat("find_flag", location))
        .otherwise(F.lit(unresolved))
    )
    return df.withColumn("lacci_id_flag", packed).withColumns(
        {
            "lacci_closing_flag": part("lacci_id_flag", "#", 0),
            "lacci_id": part("lacci_id_flag", "#", 1),
        }
    )


# --- Usage and recharge: direct match, then history, per column ------------

# Output column -> (master column, history column, default).
# The strict group follows a level only where its area is known.
STRICT_COLUMNS = {
    "lacci_id": ("lacci_id", "lacci_id", MISSING_ID),
    "lac": ("lac", "lac", NOT_QUALIFIED),
    "ci": ("ci", "ci", NOT_QUALIFIED),
    "node_type": ("node", "node", NOT_QUALIFIED),
}
LOOSE_COLUMNS = {
    "area_sales": ("area_sales", "area_name", NOT_QUALIFIED),
    "region_sales": ("region_sales", "region_sales", NOT_QUALIFIED),
    "branch": ("branch", "branch", NOT_QUALIFIED),
    "subbranch": ("subbranch", "subbranch", NOT_QUALIFIED),
    "cluster_sales": ("cluster_sales", "cluster_sales", NOT_QUALIFIED),
    "provinsi": ("provinsi", "provinsi", NOT_QUALIFIED),
    "kabupaten": ("kabupaten", "kabupaten", NOT_QUALIFIED),
    "kecamatan": ("kecamatan", "kecamatan", NOT_QUALIFIED),
    "kelurahan": ("kelurahan", "kelurahan", NOT_QUALIFIED),
}
MASTER_COLUMNS = tuple(
    dict.fromkeys(m for m, _, _ in [*STRICT_COLUMNS.values(), *LOOSE_COLUMNS.values()])
)


def route_by_network(indicator: Column | str, *, cgi: bool) -> Column:
    """Which master column a record's key is looked up in."""
    kind = F.when(as_col(indicator).isin(*CODES_ECI), F.lit("eci"))
    if cgi:
        kind = kind.when(as_col(indicator).isin(*CODES_CGI), F.lit("cgi_post"))
    return kind.otherwise(F.lit("lacci_id"))


def match_location(
    df: DataFrame,
    master: DataFrame,
    *,
    kind: str,
    location: str = "trx_lacci",
    kinds: Sequence[str] = ("eci", "cgi_post", "lacci_id"),
    unknown_area_for: Sequence[str] = ("eci", "cgi_post", "lacci_id"),
    take_also: Sequence[str] = (),
    unique: bool = True,
    spread_by: Sequence[str] = (),
    counts: KeyCounts | None = None,
) -> DataFrame:
    """Look each record up in the master column its ``kind`` names: one join
    for all kinds, on (kind, key).

    Adds the master's columns as ``m_<name>`` and ``m_found``. A null area
    counts as UNKNOWN for the kinds in ``unknown_area_for``.
    """
    columns = list(dict.fromkeys([*MASTER_COLUMNS, *take_also]))

    def entry(key: str) -> Column:
        area = null_to("area_sales", UNKNOWN) if key in unknown_area_for else F.col("area_sales")
        return F.struct(F.lit(key).alias("_kind"), F.col(key).alias("_key"), area.alias("m_area_sales"))

    rest = [F.col(c).alias(f"m_{c}") for c in columns if c != "area_sales"]
    index = master.select(F.inline(F.array(*[entry(key) for key in kinds])), *rest)
    searched = F.when(~(is_blank(location) | (F.col(location) == "|")), F.col(location))
    if counts is not None:
        # Cells are counted alone: a cell is looked up in one or two columns.
        counts = KeyCounts(counts.rows, {"_search": searched}, counts.hot_rows)
    return lookup(
        df.withColumn("_search", searched),
        index,
        {kind: "_kind", "_search": "_key"},
        {f"m_{c}": f"m_{c}" for c in columns},
        hit="m_found",
        unique=unique,
        spread_by=spread_by,
        counts=counts,
    ).drop("_search")


def resolve_location_cascade(df: DataFrame) -> DataFrame:
    """Fill the location columns from the matched master row, else from the
    ``mtd_`` block, else from the ``mm_`` block, else by default.

    Two levels are worked out once per record: where a known area is required
    (ids) and where a match is enough (names). All columns follow one of them.
    """
    direct, mtd, mm = F.col("m_found"), F.col("mtd_flag") == "1", F.col("mm_flag") == "1"
    strict = (
        F.when(direct & (F.col("m_area_sales") != UNKNOWN), F.lit(FLAG_DIRECT))
        .when(mtd & (F.col("mtd_area_name") != UNKNOWN), F.lit(FLAG_MTD))
        .when(mm & (F.col("mm_area_name") != UNKNOWN), F.lit(FLAG_MM))
        .otherwise(F.lit(FLAG_NONE))
    )
    loose = (
        F.when(direct, F.lit(FLAG_DIRECT))
        .when(mtd, F.lit(FLAG_MTD))
        .when(mm, F.lit(FLAG_MM))
        .otherwise(F.lit(FLAG_NONE))
    )

    def follow(level: str, source: tuple[str, str, str]) -> Column:
        master, history, default = source
        return (
            F.when(F.col(level) == FLAG_DIRECT, F.col(f"m_{master}"))
            .when(F.col(level) == FLAG_MTD, F.col(f"mtd_{history}"))
            .when(F.col(level) == FLAG_MM, F.col(f"mm_{history}"))
            .otherwise(F.lit(default))
        )

    filled = {c: follow("_strict", s) for c, s in STRICT_COLUMNS.items()}
    filled["lacci_closing_flag"] = F.col("_strict")
    filled |= {c: follow("_loose", s) for c, s in LOOSE_COLUMNS.items()}
    return df.withColumns({"_strict": strict, "_loose": loose}).withColumns(filled).drop("_strict", "_loose")


def resolve_location_overwriting(df: DataFrame, kind: str, location: str = "trx_lacci") -> DataFrame:
    """The cascade with every test made on the key column as it stands by then.

    For keys looked up in ``lacci_id`` or ``cgi_post`` the key column itself is
    filled first, so the tests after it see the filled value; the ``cgi_post``
    records keep the master's own ``lacci_id``.
    """
    mtd, mm = F.col("mtd_flag") == "1", F.col("mm_flag") == "1"
    mtd_known = mtd & (F.col("mtd_area_name") != UNKNOWN)
    mm_known = mm & (F.col("mm_area_name") != UNKNOWN)
    matched = F.col("m_found")
    known = matched & (F.col("m_area_sales") != UNKNOWN)
    first = F.when(known, F.col(location)).when(mtd_known, F.col("mtd_lacci_id")).when(
        mm_known, F.col("mm_lacci_id")
    ).otherwise(F.lit(MISSING_ID))
    ids = df.withColumn("_filled", first)
    overwrites = F.col(kind) != "eci"
    still = F.when(overwrites, F.col(location) == F.col("_filled")).otherwise(matched)
    # A record the master did not match has no master area to pass the test.
    ids = ids.withColumn("_still", F.coalesce(still, F.lit(False)))
    ids = ids.withColumn(
        "_strictly",
        F.coalesce(F.col("_still") & (F.col("m_area_sales") != UNKNOWN), F.lit(False)),
    )

    def follow(direct: str, source: tuple[str, str, str], known_only: bool) -> Column:
        master, history, default = source
        return (
            F.when(F.col(direct), F.col(f"m_{master}"))
            .when(mtd_known if known_only else mtd, F.col(f"mtd_{history}"))
            .when(mm_known if known_only else mm, F.col(f"mm_{history}"))
            .otherwise(F.lit(default))
        )

    out = {
        "lacci_id": F.when(F.col(kind) == "cgi_post", F.col("m_lacci_id"))
        .when(F.col(kind) == "eci", follow("_strictly", STRICT_COLUMNS["lacci_id"], True))
        .otherwise(F.col("_filled")),
        "lacci_closing_flag": F.when(F.col("_strictly"), F.lit(FLAG_DIRECT))
        .when(mtd_known, F.lit(FLAG_MTD))
        .when(mm_known, F.lit(FLAG_MM))
        .otherwise(F.lit(FLAG_NONE)),
    }
    out |= {c: follow("_strictly", s, True) for c, s in STRICT_COLUMNS.items() if c != "lacci_id"}
    out["area_sales"] = follow("_still", LOOSE_COLUMNS["area_sales"], False)
    out |= {c: follow("_still", s, False) for c, s in LOOSE_COLUMNS.items() if c != "area_sales"}
    return ids.withColumns(out).drop("_filled", "_still", "_strictly")
