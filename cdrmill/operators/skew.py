"""Ranking, first-of-group and numbering that stay parallel on hot keys.

A plain window puts each key into one task, so a key holding a third of the
rows would run in one task too. The operators here count keys over a share of
the rows and cut those with more than a piece's rows by order value. The cut
points are quantiles of a sample of the key's own order values, as many as its
rows ask for; every result is exact whatever the sample was.

A row that agrees with a cut point in all ordering columns has a piece of that
value alone, whose rank needs no order: such a piece is split further, so a
record that repeats without end is many tasks as well.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql.internal import InternalFunction

from ..session import stage

# A key is hot from this many rows on; so many make up a piece of it.
HOT_ROWS = 1_000_000
# Rows of a piece that counting keys needs to see, and of a cut point.
SIGHTINGS = 1_000
PER_CUT = 100
# Keys that are split at most, as they are broadcast; with more hot ones the
# share that makes a key hot rises, so any other has under 1/SPLIT_KEYS of the
# rows, far less than a task's share of a shuffle with that many keys.
SPLIT_KEYS = 100_000
# Pieces of all hot keys, and bytes of cut points that are broadcast; pieces are
# made larger to fit both, so the sample that cuts are picked from stays small.
PIECES = 1 << 12
CUT_BYTES = 64 << 20
# Cut points that travel with a row while it is placed.
BLOCK = 64


def key_shares(
    rows: DataFrame, columns: Mapping[str, Column] | Sequence[str], hot_rows: int = HOT_ROWS
) -> DataFrame | None:
    """Hot keys as a small local frame with ``_shares``: how many pieces of
    ``hot_rows`` rows each makes. None where no key has more than one.

    Keys of about SIGHTINGS in ``hot_rows`` rows are counted, so mostly unique
    keys are not all shuffled for it. This only chooses how rows are dealt to
    tasks; every row is ranked or joined either way.
    """
    if not isinstance(columns, Mapping):
        columns = {c: F.col(c) for c in columns}
    share = min(1.0, SIGHTINGS / hot_rows)
    seen = rows.select(*[e.alias(c) for c, e in columns.items()])
    seen = seen if share == 1.0 else seen.sample(share, seed=17)
    counts = stage(seen.groupBy(*columns).agg(F.count(F.lit(1)).alias("_rows")), "key_counts")
    total = counts.agg(F.sum("_rows")).first()[0] or 0
    # At least total / SPLIT_KEYS rows, so at most SPLIT_KEYS keys have more.
    enough = max(hot_rows * share, total / SPLIT_KEYS, 1.0)
    shares = F.ceil(F.col("_rows") / F.lit(enough)).cast("long").alias("_shares")
    hot = counts.filter(F.col("_rows") > enough).select(*columns, shares)
    found = hot.collect()
    return rows.sparkSession.createDataFrame(found, hot.schema) if found else None


def row_code(df: DataFrame, by: Sequence[str] = ()) -> Column:
    """A hash of the row (``by``: of the columns that tell rows apart), so a
    retried task deals its rows the same way."""
    return F.xxhash64(*(by or [c for c, kind in df.dtypes if "map<" not in kind]))


def _renamed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.withColumnsRenamed({k: f"_k_{k}" for k in keys})


def _same_keys(keys: Sequence[str], extra: Sequence[tuple[str, str]] = ()) -> Column:
    cond = None
    for left, right in [(k, f"_k_{k}") for k in keys] + list(extra):
        test = F.col(left).eqNullSafe(F.col(right))
        cond = test if cond is None else cond & test
    return cond


def cut_points(
    hot_rows_of: DataFrame, keys: Sequence[str], order: Sequence[str], piece: int, cut_bytes: int = CUT_BYTES
) -> tuple[DataFrame, int]:
    """Per key the sorted ``_cuts``, order values about ``piece`` rows apart with
    the number of pieces each value makes by itself, and the most cuts of a key.

    Quantiles of a sample of the rows, equal values counted: partial counts of
    the sample are merged, whatever the number of rows.
    """
    rate = min(1.0, PER_CUT / piece)
    seen = hot_rows_of if rate == 1.0 else hot_rows_of.sample(rate, seed=23)
    values = seen.groupBy(*keys, F.struct(*order).alias("_value")).agg(F.count(F.lit(1)).alias("_n"))
    values = stage(values, "order_values")
    up_to = Window.partitionBy(*keys).orderBy("_value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    per = max(1.0, piece * rate)

    def picked(per: float) -> DataFrame:
        """Values at which the count goes on to the next multiple of ``per``."""
        ahead = values.withColumn("_up_to", F.sum("_n").over(up_to))
        steps = F.floor(F.col("_up_to") / per) > F.floor((F.col("_up_to") - F.col("_n")) / per)
        own = F.greatest(F.lit(1), F.ceil(F.col("_n") / per)).cast("long")
        return ahead.filter(steps).select(*keys, "_value", own.alias("_own"))

    size = F.sum(F.length(F.to_json("_value")) + F.lit(16))
    total = picked(per).agg(size).first()[0] or 0
    if total > cut_bytes:
        per *= total / cut_bytes
    cuts = picked(per).groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("_value", "_own"))).alias("_cuts"))
    cuts = stage(cuts, "cut_points")
    return cuts, cuts.agg(F.max(F.size("_cuts"))).first()[0] or 0


def _search(values: str, value: Column) -> Column:
    """Index of ``value`` in the sorted array ``values``, or -1 less the number of
    values below it. Compiled by Spark; a search written as a function over an
    array is not, and took most of a ranking's time."""
    return F.coalesce(InternalFunction.array_binary_search(F.col(values), value), F.lit(-1))


def _place(rows: DataFrame, cuts: DataFrame, keys: Sequence[str], value: Column) -> DataFrame:
    """Add ``_below``, how many cut points of its key are below a row's ``value``,
    and ``_own`` of the cut point that is the value, else null. A join copies the
    array it brings with each row, so cuts come in blocks of BLOCK: first the last
    ones of a key's blocks, which tell the block, then that block."""
    last = F.filter("_cuts", lambda _, i: i % BLOCK == BLOCK - 1)
    numbers = F.sequence(F.lit(0), ((F.size("_cuts") - 1) / BLOCK).cast("int"))
    block = F.transform(numbers, lambda j: F.struct(j.alias("_in"), F.slice("_cuts", j * BLOCK + 1, BLOCK).alias("_cuts")))
    lasts = _renamed(cuts.select(*keys, last["_value"].alias("_lasts")), keys)
    blocks = _renamed(
        cuts.select(*keys, F.inline(block)).select(
            *keys, "_in", F.col("_cuts")["_value"].alias("_values"), F.col("_cuts")["_own"].alias("_owns")
        ),
        keys,
    )
    found = rows.join(F.broadcast(lasts), _same_keys(keys), "left")
    found = found.withColumn("_at", _search("_lasts", value)).withColumn("_block", F.greatest("_at", -1 - F.col("_at")))
    found = found.drop("_at", "_lasts", *[f"_k_{k}" for k in keys])
    found = found.join(F.broadcast(blocks), _same_keys(keys, [("_block", "_in")]), "left")
    found = found.withColumn("_at", _search("_values", value))
    return found.withColumns(
        {
            "_below": F.col("_block") * BLOCK + F.greatest("_at", -1 - F.col("_at")),
            "_own": F.when(F.col("_at") >= 0, F.get(F.col("_owns"), F.col("_at"))),
        }
    ).drop("_values", "_owns", "_block", "_in", "_at", *[f"_k_{k}" for k in keys])


def dense_rank_by(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    out: str,
    hot_rows: int | None = HOT_ROWS,
    probe: DataFrame | None = None,
    cut_bytes: int = CUT_BYTES,
    kind: str = "int",
) -> DataFrame:
    """``dense_rank`` over ``keys`` ordered by ``order``, hot keys in pieces.

    ``df`` is read more than once: stage it when its lineage is deep, or name a
    shallower ``probe`` with the same keys to look for hot ones in. Without
    ``hot_rows`` no key is looked for.
    """
    keys, order = list(keys), list(order)
    hot = None if hot_rows is None else key_shares(df if probe is None else probe, keys, hot_rows)
    if hot is None:
        return df.withColumn(out, F.dense_rank().over(Window.partitionBy(*keys).orderBy(*order)).cast(kind))

    needed = list(dict.fromkeys(keys + order))
    in_hot = df.select(*needed).join(F.broadcast(_renamed(hot, keys)), _same_keys(keys), "left_semi")
    pieces = hot.agg(F.sum("_shares")).first()[0]
    cuts, _ = cut_points(in_hot, keys, order, max(hot_rows, hot_rows * pieces // PIECES), cut_bytes)

    def into_pieces(rows: DataFrame) -> DataFrame:
        """Even pieces lie between cut points, odd ones hold one cut point's value."""
        alone = F.col("_own").isNotNull()
        part = F.when(alone, F.pmod(row_code(rows), F.col("_own"))).otherwise(F.lit(0))
        return _place(rows, cuts, keys, F.struct(*order)).withColumns(
            {"_piece": F.col("_below") * 2 + alone.cast("int"), "_part": part.cast("long")}
        ).drop("_own", "_below")

    # Distinct order values per piece, summed up to an offset per piece: at
    # most two rows for each cut point.
    per_piece = (
        into_pieces(in_hot)
        .select(*keys, "_piece", F.struct(*order).alias("_value"))
        .distinct()
        .groupBy(*keys, "_piece")
        .agg(F.count(F.lit(1)).alias("_values"))
    )
    earlier = Window.partitionBy(*keys).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = _renamed(
        per_piece.withColumn("_offset", F.coalesce(F.sum("_values").over(earlier), F.lit(0)))
        .drop("_values")
        .withColumnRenamed("_piece", "_of"),
        keys,
    )
    local = F.dense_rank().over(Window.partitionBy(*keys, "_piece", "_part").orderBy(*order))
    return (
        into_pieces(df)
        .withColumn("_local", local)
        .join(F.broadcast(offsets), _same_keys(keys, [("_piece", "_of")]), "left")
        .withColumn(out, (F.col("_local") + F.coalesce("_offset", F.lit(0))).cast(kind))
        .drop("_local", "_piece", "_part", "_of", "_offset", *[f"_k_{k}" for k in keys])
    )


def keep_one(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per key: the smallest by ``order``, then by the other columns,
    a filled value before a null in each.

    An aggregate, so copies of a key collapse before the shuffle and the choice
    does not depend on arrival. It sorts by key: a hash aggregate holds values of
    fixed width alone, which whole rows of text are not. A sort-merge join on the
    key takes the rows as they are sorted.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    first = [c for c in order if c in rest]
    ranked = first + [c for c in rest if c not in first]
    if not ranked:
        return df.distinct()
    filled_first = [part for c in ranked for part in (F.col(c).isNull().alias(f"_no_{c}"), F.col(c))]
    return (
        df.groupBy(*keys)
        .agg(F.min(F.struct(*filled_first)).alias("_row"))
        .select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])
    )


_POSITION_BITS = 33
_SPLIT = ("_partition", "_file", "_block")


@dataclass
class Arrivals:
    """Numbered rows, and how many there are to be."""

    rows: DataFrame
    expected: int
    observed: Observation

    def check(self) -> None:
        """After ``rows`` have been written or counted: fails if some were missing."""
        found = self.observed.get["rows"]
        if found != self.expected:
            raise RuntimeError(f"{found} rows were numbered, {self.expected} were counted")


def arrivals(df: DataFrame, out: str = "rec_id", start: int = 1) -> Arrivals:
    """Number rows 1, 2, ... by file, block and place in it.

    A first pass only counts the rows of each input split; the numbers are
    offsets of the splits plus positions in them, and nothing is written. ``df``
    must be read the same way twice: files with filters and projections, no
    shuffle. A row of a split that was not counted, or at a place behind its
    last, fails the run; missing rows show in ``check``.
    """
    place = F.monotonically_increasing_id()
    placed = df.withColumns(
        {
            "_partition": F.shiftright(place, _POSITION_BITS),
            "_position": place.bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)),
            "_file": F.input_file_name(),
            "_block": F.input_file_block_start(),
        }
    )
    sizes = placed.groupBy(*_SPLIT).agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_position").alias("_first"), F.max("_position").alias("_last")
    )
    splits = sizes.collect()  # a row for each input split, as in the listing of the files
    offsets, ahead = [], start
    for r in sorted(splits, key=lambda r: (r["_file"], r["_block"], r["_partition"])):
        if r["_last"] - r["_first"] + 1 != r["_rows"]:
            raise ValueError(f"the rows of a split of {r['_file']} do not follow one another")
        offsets.append((*[r[c] for c in _SPLIT], r["_first"], r["_last"], ahead))
        ahead += r["_rows"]
    schema = "_s_partition long, _s_file string, _s_block long, _first long, _last long, _offset long"
    known = df.sparkSession.createDataFrame(offsets, schema)
    same = [F.col(c) == F.col(f"_s{c}") for c in _SPLIT]
    joined = placed.join(F.broadcast(known), same[0] & same[1] & same[2], "left")
    counted = F.col("_position").between(F.col("_first"), F.col("_last"))
    number = F.when(counted, F.col("_offset") + F.col("_position") - F.col("_first")).otherwise(
        F.raise_error(F.lit("the feed changed while it was being numbered")).cast("long")
    )
    numbered = joined.withColumn("_number", number)
    spent = [*_SPLIT, "_position", "_first", "_last", "_offset", *[f"_s{c}" for c in _SPLIT]]
    numbered = numbered.drop(*spent, *([out] if out in df.columns else [])).withColumnRenamed("_number", out)
    observed = Observation()
    return Arrivals(numbered.observe(observed, F.count(F.lit(1)).alias("rows")), ahead - start, observed)


def number_arrivals(df: DataFrame, out: str = "rec_id", start: int = 1) -> DataFrame:
    return arrivals(df, out, start).rows


def number_by(
    df: DataFrame, order: Sequence[str], out: str, start: int = 1, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Number rows by a unique order: the rows are one key cut into pieces, so
    nothing is written and no task sees them all. Rows that agree in ``order``
    would share a number."""
    ranked = dense_rank_by(df.withColumn("_all", F.lit(0)), ["_all"], order, "_number", hot_rows, kind="long")
    numbered = ranked.withColumn("_number", (F.col("_number") + F.lit(start - 1)).cast("long"))
    return numbered.drop("_all", *([out] if out in df.columns else [])).withColumnRenamed("_number", out)
