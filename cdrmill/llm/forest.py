"""Near duplicates by an LSH forest over MinHash signatures.

A document's set is that of its distinct runs of SHINGLE lower-cased words.
Documents with one set are a class, represented by its smallest doc_id; the rest
is about classes.

TREES sorted orders of the signatures make the forest. In each order, classes
that agree in the first DEPTH values of the order's key are a region. Walking
down a region in sorted order, a class is compared with the region's leaders
(classes that resembled no leader before), by 128 signature bits; those alike are
neighbours, and who resembles none becomes a leader. Where a region holds more
leaders than LEADERS, it is walked at greater depth: only leaders that agree in
the key's next values stay. The orders are range-partitioned, so a region of any
size is spread over tasks; its leaders in several tasks are compared afterwards.

Neighbours, taken together, are groups. Inside a group all pairs that the
signatures do not rule out, and that are not linked through others already, are
checked on the full sets: exactly the pairs with ``same`` percent in common are
links. A large group is worked on in cells of CELL classes, first each with
itself and with the group's most central classes, then what is still apart with
all the rest, cell by cell. Each task yields a forest of links, not all pairs.

With a similarity of 0.8 two classes miss each other in all orders with a
probability of (1 - 0.8 ** DEPTH) ** TREES = 5e-8.

Documents without words have an empty set and no links. A null doc_id takes no
part: no component, and kept. Rows with one doc_id are one document: repeated
rows share a class, and different texts under one id count as linked. Other
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import attach, each_batch, give_back, mix64, staged, text_chunks, texts_of, word_hashes
from .components import Sets, components

SHINGLE = 2
SAME = 80
TREES = 32
DEPTH = 4
HASHES = TREES * DEPTH
LEADERS = 64
CELL = 512
HUBS = 8
# Signature bits and values that agree in pairs worth a look: 6 and 4 standard
# deviations below what is expected at a similarity of 0.8.
ALIKE_BITS = 95
ALIKE_VALUES = 82
# Bits for each class that a filter of texts tells apart, and their bound (16 MB).
BITS_EACH = 16
MOST_BITS = 1 << 27

_SEEDS = mix64(np.arange(1, 2 * HASHES + 1, dtype=np.uint64))
_FACTORS = (_SEEDS[:HASHES] | np.uint64(1)).astype(np.uint32)
_SHIFTS = _SEEDS[HASHES:].astype(np.uint32)
_PAIR = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, words: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    hashes, _, _, texts = word_hashes(raw, offsets)
    at = np.searchsorted(texts, np.arange(len(offsets)))
    joined = hashes.copy()
    for k in range(1, words):
        n = max(0, len(hashes) - k)
        joined[:n] = mix64(joined[:n] * _PAIR + hashes[len(hashes) - n :])
    out = []
    for a, b in zip(at[:-1], at[1:]):
        if b - a >= words:
            out.append(np.unique(joined[a : b - words + 1]))
        elif b > a:  # fewer words: all of them as one
            whole = np.uint64(b - a)
            for h in hashes[a:b]:
                whole = mix64(np.array([whole], np.uint64) * _PAIR + h)[0]
            out.append(np.array([whole], dtype=np.uint64))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """HASHES minima for each set that is not empty, one row a set."""
    values = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    starts = np.cumsum([0, *(len(s) for s in sets[:-1])])
    out = np.empty((len(sets), HASHES), dtype=np.uint32)
    for k in range(HASHES):
        out[:, k] = np.minimum.reduceat(values * _FACTORS[k] + _SHIFTS[k], starts)
    return out


CLASSED = "doc_id long, n int, high long, low long, signature binary"


def _describe(words: int):
    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for piece in text_chunks(batch):
            sets = shingle_sets(*texts_of(piece.column("text")), words)
            full = [s for s in sets if len(s)]
            rows = iter(signatures(full)) if full else iter(())
            sums = [(mix64(s).sum(dtype=np.uint64), mix64(s ^ _PAIR).sum(dtype=np.uint64)) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("doc_id"),
                    pa.array([len(s) for s in sets], pa.int32()),
                    pa.array(np.array([s[0] for s in sums], np.uint64).view(np.int64)),
                    pa.array(np.array([s[1] for s in sums], np.uint64).view(np.int64)),
                    pa.array([next(rows).tobytes() if len(s) else None for s in sets], pa.binary()),
                ],
                ["doc_id", "n", "high", "low", "signature"],
            )

    return each_batch(work)


ORDERED = "region long, deeper long, rep long, bits binary"


def _orders(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """One row for each class and tree, with the key to sort by."""
    if not batch.num_rows:
        return
    raw = b"".join(batch.column("signature").to_pylist())
    values = np.frombuffer(raw, dtype=np.uint32).reshape(batch.num_rows, HASHES)
    bits = np.packbits((values >> np.uint32(16)) & np.uint32(1) == 1, axis=1)
    bits = [row.tobytes() for row in bits]
    for tree in range(TREES):
        region = np.full(len(values), tree, dtype=np.uint64)
        for k in range(tree * DEPTH, (tree + 1) * DEPTH):
            region = mix64(region * _PAIR + values[:, k])
        deeper = np.zeros(len(values), dtype=np.int64)
        for k in range(4):  # the key goes on with the values of the next tree
            deeper = deeper << 15 | (values[:, ((tree + 1) * DEPTH + k) % HASHES] >> np.uint32(17))
        yield pa.RecordBatch.from_arrays(
            [pa.array(region.view(np.int64)), pa.array(deeper), batch.column("rep"), pa.array(bits, pa.binary())],
            ["region", "deeper", "rep", "bits"],
        )


MET = "region long, deeper long, rep long, bits binary, other long"


def _walk(ends: bool):
    """Sorted rows of ORDERED -> pairs (rep, other) that are alike, without those
    that the task's other pairs connect. With ``ends`` also the leaders of the
    task's first and last region (other null), as these may go on in other tasks."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, leaders, outer = None, [], []
        first, sets = True, Sets()
        for batch in batches:
            regions = batch.column("region").to_numpy()
            n = len(regions)
            if not n:
                continue
            change = np.concatenate([[True], regions[1:] != regions[:-1]])
            last = np.concatenate([change[1:], [True]])
            # Alone in its region; the batch's ends may have more elsewhere.
            busy = ~(change & last)
            busy[0] = busy[-1] = True
            at = np.flatnonzero(busy)
            some = batch.take(pa.array(at))
            pairs = []
            for region, deeper, rep, bits in zip(*(some.column(i).to_pylist() for i in range(4))):
                if region != now:
                    if ends and first and now is not None:
                        outer += [(now, *x) for x in leaders]
                        first = False
                    now, leaders = region, []
                code = int.from_bytes(bits)
                if len(leaders) > LEADERS:
                    leaders = [x for x in leaders if x[0] >> 45 == deeper >> 45]
                    if len(leaders) > LEADERS:
                        leaders = [x for x in leaders if x[0] >> 30 == deeper >> 30]
                alike = [x[1] for x in leaders if HASHES - (x[3] ^ code).bit_count() >= ALIKE_BITS]
                pairs += [(rep, other) for other in alike if sets.join(rep, other)]
                if not alike:
                    leaders.append((deeper, rep, bits, code))
            yield _met([(None, None, a, None, b) for a, b in pairs])
        if ends:
            outer += [(now, *x) for x in leaders]
            yield _met([(region, deeper, rep, bits, None) for region, deeper, rep, bits, _ in outer])
        give_back()

    return work


def _met(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * 5
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds)], ["region", "deeper", "rep", "bits", "other"]
    )


def neighbours(classes: DataFrame) -> DataFrame:
    """Pairs (a, b) of classes that are next to each other in some order."""
    rows = classes.select("rep", "signature").mapInArrow(each_batch(_orders), ORDERED)
    rows = rows.repartitionByRange("region", "deeper", "rep").sortWithinPartitions("region", "deeper", "rep")
    met = staged(rows.mapInArrow(_walk(True), MET), "neighbours")
    outer = met.filter(F.col("other").isNull()).drop("other")
    outer = outer.repartition("region").sortWithinPartitions("region", "deeper", "rep")
    pairs = met.unionByName(outer.mapInArrow(_walk(False), MET)).filter(F.col("other").isNotNull())
    return pairs.select(F.col("rep").alias("a"), F.col("other").alias("b"))


def among(texts: DataFrame, reps: DataFrame, count: int) -> DataFrame:
    """The rows of ``texts`` whose doc_id is a ``rep``, and few others: those that
    share a bit with one. Ahead of a shuffle, so that few texts travel; ``count``
    reps beyond the bound of the bits let more of the others through."""
    blocks = -(-BITS_EACH * max(1, count) // (1 << 15))
    bits = min(MOST_BITS, blocks << 15)

    def bit(column: str) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(bits)) + 1

    marks = reps.select(bit("rep").alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("block"))
    marks = marks.agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("marks"))
    asked = texts.withColumn("bit", bit("doc_id"))
    asked = asked.join(F.broadcast(marks), F.bitmap_bucket_number("bit") == F.col("block"))
    place = F.bitmap_bit_position("bit")
    byte = F.substring("marks", (F.floor(place / 8) + 1).cast("int"), F.lit(1))
    value = F.conv(F.hex(byte), 16, 10).cast("long")
    return asked.filter(F.getbit(value, (place % 8).cast("int")) == 1).select(*texts.columns)


MEMBER = "grp long, rep long, part long, large boolean, signature binary, elements binary"


def _members(words: int):
    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for piece in text_chunks(batch):
            sets = shingle_sets(*texts_of(piece.column("text")), words)
            keep = np.array([len(s) > 0 for s in sets])
            full = [s for s in sets if len(s)]
            if full:
                some = piece.filter(pa.array(keep))
                yield pa.RecordBatch.from_arrays(
                    [
                        some.column("grp"),
                        some.column("rep"),
                        some.column("part"),
                        some.column("large"),
                        pa.array([s.tobytes() for s in signatures(full)], pa.binary()),
                        pa.array([s.tobytes() for s in full], pa.binary()),
                    ],
                    ["grp", "rep", "part", "large", "signature", "elements"],
                )

    return each_batch(work)


LINKED = "grp long, a long, b long, agree int"


class Cell:
    """Classes whose pairs are checked in one task."""

    def __init__(self, reps: list[int], values: list[bytes], elements: list[bytes]):
        self.reps = reps
        self.values = np.frombuffer(b"".join(values), np.uint32).reshape(len(reps), HASHES)
        self.sets = [np.frombuffer(e, np.uint64) for e in elements]
        self.sizes = np.array([len(s) for s in self.sets])

    def linked(self, i: int, j: int, same: int) -> bool:
        both = len(np.intersect1d(self.sets[i], self.sets[j], assume_unique=True))
        return 100 * both >= same * (self.sizes[i] + self.sizes[j] - both)

    def links(self, rows: np.ndarray, columns: np.ndarray, same: int, sets: Sets) -> list[tuple[int, int]]:
        """Links between ``rows`` and ``columns`` that join sets."""
        agree = np.zeros((len(rows), len(columns)), dtype=np.uint8)
        for k in range(HASHES):
            agree += self.values[rows, k][:, None] == self.values[columns, k][None, :]
        small, large = self.sizes[rows][:, None], self.sizes[columns][None, :]
        fits = 100 * np.minimum(small, large) >= same * np.maximum(small, large)
        r, c = np.nonzero((agree >= ALIKE_VALUES) & fits)
        out = []
        for x in np.argsort(-agree[r, c].astype(np.int16), kind="stable"):
            i, j = int(rows[r[x]]), int(columns[c[x]])
            a, b = self.reps[i], self.reps[j]
            if a != b and sets.find(a) != sets.find(b) and self.linked(i, j, same):
                sets.join(a, b)
                out.append((a, b))
        return out

    def central(self) -> list[tuple[int, int]]:
        """The classes closest to the rest: (place, agreement with the values
        most of them have)."""
        most = np.array([np.bincount(np.unique(v, return_inverse=True)[1]).argmax() for v in self.values.T])
        common = np.array([np.unique(v)[m] for v, m in zip(self.values.T, most)])
        agree = (self.values == common).sum(axis=1)
        return [(int(i), int(agree[i])) for i in np.argsort(-agree, kind="stable")[:HUBS]]


def _cells(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[tuple[tuple, dict]]:
    """Rows of each cell, from rows sorted by the keys."""
    now, held = None, []
    for batch in batches:
        for row in batch.to_pylist():
            key = tuple(row[k] for k in keys)
            if key != now:
                if held:
                    yield now, held
                now, held = key, []
            held.append(row)
    if held:
        yield now, held


def _linked(grp: int, links: list[tuple], agree: list[int] | None = None) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array([grp] * len(links), pa.int64()),
            pa.array([x[0] for x in links], pa.int64()),
            pa.array([x[1] for x in links], pa.int64()),
            pa.array(agree or [None] * len(links), pa.int32()),
        ],
        ["grp", "a", "b", "agree"],
    )


def _within(same: int):
    """Links in each cell; and its central classes (a = b, with the agreement)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (grp, _), rows in _cells(batches, ("grp", "part")):
            cell = Cell([r["rep"] for r in rows], [r["signature"] for r in rows], [r["elements"] for r in rows])
            every = np.arange(len(rows))
            yield _linked(grp, cell.links(every, every, same, Sets()))
            if rows[0]["large"]:
                hubs = cell.central()
                yield _linked(grp, [(cell.reps[i], cell.reps[i]) for i, _ in hubs], [a for _, a in hubs])
        give_back()

    return work


def _across(same: int):
    """Links between rows that ask (side 1) and others, where ``root`` differs."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (grp, _, _), rows in _cells(batches, ("grp", "part", "ask")):
            cell = Cell([r["rep"] for r in rows], [r["signature"] for r in rows], [r["elements"] for r in rows])
            sets = Sets()
            for r in rows:
                sets.join(r["rep"], r["root"])
            ask = np.array([r["side"] == 1 for r in rows])
            yield _linked(grp, cell.links(np.flatnonzero(ask), np.flatnonzero(~ask), same, sets))
        give_back()

    return work


def _rooted(members: DataFrame, found: DataFrame) -> DataFrame:
    """Add the root of each member's component."""
    return members.join(found, members["rep"] == found["node"], "left").select(
        members["*"], F.coalesce("root", "rep").alias("root")
    )


def _edges(found: DataFrame) -> DataFrame:
    return found.select(F.col("node").alias("a"), F.col("root").alias("b"))


def _meet(members: DataFrame, asking: DataFrame, plan: DataFrame, total: int, same: int) -> DataFrame:
    """Links between all members of large groups and the asking ones. ``plan``
    has each group's size, its parts (cells of its members) and asks (cells of
    those that ask, their column ``ask``): each ask meets each part."""
    columns = ["grp", "part", "ask", "side", "rep", "root", "signature", "elements"]
    others = attach(members, plan, ["grp"], "size", total, ["rep"]).filter("asks is not null")
    others = others.withColumn("ask", F.explode(F.sequence(F.lit(0), F.col("asks") - 1)))
    askers = attach(asking.drop("part"), plan, ["grp"], "size", total, ["rep"])
    askers = askers.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    both = (
        others.withColumn("side", F.lit(0))
        .select(*columns)
        .unionByName(askers.withColumn("side", F.lit(1)).select(*columns))
    )
    both = both.repartition("grp", "part", "ask").sortWithinPartitions("grp", "part", "ask")
    return both.mapInArrow(_across(same), LINKED).select("a", "b")


def exact_links(texts: DataFrame, groups: DataFrame, words: int, same: int) -> DataFrame:
    """Links (a, b) among the classes of each group, and with the roots of those
    that links connect. ``texts``: doc_id, text; ``groups``: node, root."""
    roots = groups.select(F.col("root").alias("node"), "root").distinct()
    nodes = groups.unionByName(roots).select(F.col("node").alias("rep"), F.col("root").alias("grp"))
    nodes = staged(nodes, "groups")
    sizes = nodes.groupBy("grp").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > CELL)
    large = staged(sizes.withColumn("parts", F.ceil(F.col("size") / F.lit(CELL)).cast("long")), "large")
    count = nodes.count()
    placed = attach(nodes, large, ["grp"], "size", count, ["rep"]).select(
        "grp",
        "rep",
        F.coalesce(F.pmod(F.xxhash64("rep"), "parts"), F.lit(0)).cast("long").alias("part"),
        F.col("parts").isNotNull().alias("large"),
    )
    placed = staged(placed, "placed")
    some = among(texts, placed, count)
    found = some.join(placed, some["doc_id"] == placed["rep"]).select("grp", "rep", "part", "large", "text")
    members = staged(found.mapInArrow(_members(words), MEMBER), "members")
    cells = members.repartition("grp", "part").sortWithinPartitions("grp", "part")
    first = staged(cells.mapInArrow(_within(same), LINKED), "links")
    links = first.filter(F.col("agree").isNull()).select("a", "b")
    if large.isEmpty():
        return links

    # Large groups: all members with the most central ones.
    inside = members.filter("large").drop("large")
    total = inside.count()
    centres = first.filter(F.col("agree").isNotNull()).groupBy("grp").agg(
        F.slice(F.sort_array(F.collect_list(F.struct("agree", F.col("a").alias("rep"))), False), 1, HUBS).alias("best")
    )
    centres = staged(centres.select(F.explode("best.rep").alias("rep")).distinct(), "centres")
    found = components(links)
    rooted = staged(_rooted(inside, found), "rooted")
    asking = rooted.join(centres, "rep", "left_semi").withColumn("ask", F.lit(0))
    plan = large.withColumn("asks", F.lit(1))
    found = components(_edges(found).unionByName(_meet(rooted, asking, plan, total, same)))

    # What is apart from the largest part of its group, with all members.
    rooted = staged(_rooted(inside, found), "rooted")
    parts = rooted.groupBy("grp", "root").agg(F.count(F.lit(1)).alias("n"))
    main = parts.groupBy("grp").agg(F.max(F.struct("n", "root")).alias("main"), F.sum("n").alias("size"))
    main = main.filter(F.col("size") > F.col("main.n")).select(
        "grp",
        "size",
        F.col("main.root").alias("main"),
        F.ceil(F.col("size") / F.lit(CELL)).cast("long").alias("parts"),
        F.ceil((F.col("size") - F.col("main.n")) / F.lit(CELL)).cast("int").alias("asks"),
    )
    plan = staged(main, "apart")
    told = attach(rooted, plan, ["grp"], "size", total, ["rep"])
    apart = told.filter(F.col("root") != F.col("main")).select(
        *rooted.columns, F.pmod(F.xxhash64("rep"), "asks").cast("int").alias("ask")
    )
    more = _meet(rooted, staged(apart, "asking"), plan.drop("main"), total, same)
    return _edges(found).unionByName(more)


JUDGED = "doc_id long, n_shingles long, component_id long, kept boolean"


def near_duplicates(docs: DataFrame, words: int = SHINGLE, same: int = SAME) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id that links reach) and
    kept (whether that is the document itself)."""
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    described = staged(texts.mapInArrow(_describe(words), CLASSED), "described")
    classes = (
        described.filter((F.col("n") > 0) & F.col("doc_id").isNotNull())
        .groupBy("high", "low", "n")
        .agg(
            F.min("doc_id").alias("rep"),
            F.count(F.lit(1)).alias("rows"),
            F.first("signature").alias("signature"),
        )
    )
    classes = staged(classes, "classes")
    groups = components(neighbours(classes))
    found = components(exact_links(texts, groups, words, same))
    # Texts under one id are one node already; classes get their node's component.
    told = classes.join(found, classes["rep"] == found["node"], "left").select(
        "high", "low", "n", "rows", F.coalesce("root", "rep").alias("component_id")
    )
    total = classes.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    full = attach(
        described.drop("signature"), staged(told, "told"), ["high", "low", "n"], "rows", total, ["doc_id"]
    )
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return full.select(
        "doc_id",
        F.col("n").cast("long").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )
