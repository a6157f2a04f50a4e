"""Removal of repeated passages by hashing lines.

A text is cut into units: lines, and in them sentences (or lines alone, or
paragraphs). Units are normalised (lower case, white space as one space) and
hashed to 128 bits; digests are grouped over all documents. The occurrence that
ranks first (smallest doc_id, then place in the text) is kept, all others are
repeats. A run of neighbouring repeats with at least ``min_words`` words is a
repeated passage: it is cut out, and its offsets in the original text are kept.
Shorter runs of sentences stay: a common phrase is no passage.

Every unit with a word is hashed. Sentences of under ``UNIT_WORDS`` words say
little alone: neighbours among them are hashed ``TOGETHER`` words at a time, from each of them
on, and a lone one that is new belongs to a run that goes on behind it. With
``whole_lines`` lines are hashed beside their sentences, and a repeated line is
cut whatever its length; so is a repeated paragraph, whose lines are repeats.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import attach, give_back, staged

MIN_WORDS = 25
UNIT_WORDS = 3
TOGETHER = 8
# A unit with the separators behind it; the units of a text are the whole text.
UNITS = {
    "sentence": r"[^.!?\n]*[.!?\n]+\s*|[^.!?\n]+\Z",
    "line": r"[^\n]*\n+\s*|[^\n]+\Z",
    "paragraph": r"(?:[^\n]|\n(?!\s*\n))*\n\s*\n\s*|(?:[^\n]|\n(?!\s*\n))+\Z",
}
ROWS_AT_ONCE = 50_000


def _units(text: str, pattern: re.Pattern) -> Iterator[tuple[int, int, list[str]]]:
    """Start, end and words of each unit."""
    for found in pattern.finditer(text):
        if found.end() > found.start():
            yield found.start(), found.end(), found.group().lower().split()


def _short_groups(units: Sequence[tuple[int, int, list[str]]]) -> Iterator[list[int]]:
    """Neighbours of under ``UNIT_WORDS`` words, by their numbers."""
    group: list[int] = []
    for number, (_, _, words) in enumerate(units):
        if len(words) >= UNIT_WORDS and group:
            yield group
            group = []
        elif 0 < len(words) < UNIT_WORDS:
            group.append(number)
    if group:
        yield group


def _hashed(text: str, units: Sequence[tuple[int, int, list[str]]], whole_lines: bool):
    """First unit, last unit, words, whether a line: all that is compared."""
    for number, (_, _, words) in enumerate(units):
        if len(words) >= UNIT_WORDS:
            yield number, number, words, False
    for group in _short_groups(units):
        size = end = 0  # words of the units from the first one on
        for at, first in enumerate(group):
            while end < len(group) and size < TOGETHER:
                size += len(units[group[end]][2])
                end += 1
            if size < TOGETHER and at:
                break
            yield first, group[end - 1], [w for k in group[at:end] for w in units[k][2]], False
            size -= len(units[first][2])
    if whole_lines:
        first, line = 0, []
        for number, (start, end, words) in enumerate(units):
            line += words
            if number + 1 == len(units) or "\n" in text[start:end]:
                if line:
                    yield first, number, line, True
                first, line = number + 1, []


def _hash_units(unit: str, whole_lines: bool):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = re.compile(UNITS[unit])
        names = ["_id", "_text", "_unit", "_end", "_line", "_words", "_high", "_low"]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.int32(), pa.int64(), pa.int64()]
        held: list[tuple] = []

        def flush() -> pa.RecordBatch:
            columns = [pa.array(c, k) for c, k in zip(zip(*held), kinds)]
            held.clear()
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in batches:
            for i in range(batch.num_rows):
                doc, key = batch.column("_id")[i].as_py(), batch.column("_text")[i].as_py()
                text = batch.column("text")[i].as_py() or ""
                for first, end, words, line in _hashed(text, list(_units(text, pattern)), whole_lines):
                    # A line is a repeat of lines only.
                    digest = xxhash.xxh3_128_intdigest("\n" * line + " ".join(words))
                    high, low = (x - (1 << 64) if x >> 63 else x for x in divmod(digest, 1 << 64))
                    held.append((doc, key, first, end, line, len(words), high, low))
                    if len(held) >= ROWS_AT_ONCE:
                        yield flush()
        if held:
            yield flush()
        give_back()

    return work


def _keyed(docs: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The asked columns and what names a row: its id and a hash of its text.
    A null id ranks last."""
    last = F.lit((1 << 63) - 1)
    return docs.select(
        *columns,
        F.coalesce(F.col("doc_id").cast("long"), last).alias("_id"),
        F.coalesce(F.xxhash64("text"), F.lit(0)).alias("_text"),
    )


def repeated_units(
    docs: DataFrame, min_words: int = MIN_WORDS, unit: str = "sentence", whole_lines: bool = False
) -> DataFrame:
    """The repeats of each document that has ``min_words`` words or, if asked
    for, a line in them: _id, _text and repeats (first and last unit, whether a
    line, doc_id of the kept occurrence, its end if in the same text)."""
    units = _keyed(docs, ["text"]).mapInArrow(
        _hash_units(unit, whole_lines),
        "_id long, _text long, _unit int, _end int, _line boolean, _words int, _high long, _low long",
    )
    units = staged(units, "units")
    groups = units.groupBy("_high", "_low").agg(
        F.min(F.struct("_id", "_text", "_unit", "_end")).alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    groups = staged(groups.filter(F.col("_rows") > 1), "repeated_units")
    told = attach(
        units, groups, ["_high", "_low"], "_rows", units.count(), ["_id", "_text", "_unit"]
    )
    same_text = (F.col("_first._id") == F.col("_id")) & (F.col("_first._text") == F.col("_text"))
    again = told.filter(
        F.col("_first").isNotNull() & (F.col("_first") != F.struct("_id", "_text", "_unit", "_end"))
    )
    return (
        again.groupBy("_id", "_text")
        .agg(
            # A set: rows that are alike say the same.
            F.collect_set(
                F.struct(
                    F.col("_unit").alias("unit"),
                    F.col("_end").alias("end"),
                    F.col("_line").alias("line"),
                    F.col("_first._id").alias("kept"),
                    F.when(same_text, F.col("_first._end")).alias("kept_end"),
                )
            ).alias("_repeats"),
            F.sum("_words").alias("_repeated"),
            F.max("_line").alias("_lines"),
        )
        .filter((F.col("_repeated") >= min_words) | F.col("_lines"))
        .drop("_repeated", "_lines")
    )


SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kept_doc", pa.int64())])
ADDED = "removed array<struct<start:int,end:int,kept_doc:bigint>>, n_units int, n_removed int"


def find_runs(units: list[tuple[int, int, list[str]]], repeats: list[dict], min_words: int):
    """Runs of repeats as (start, end, doc_id kept, units)."""
    kept: dict[int, int] = {}
    lines: set[int] = set()
    for r in repeats:
        # Units of the kept occurrence itself stay.
        after = r["unit"] if r["kept_end"] is None else max(r["unit"], r["kept_end"] + 1)
        for number in range(after, r["end"] + 1):
            kept[number] = min(r["kept"], kept.get(number, r["kept"]))
            if r["line"]:
                lines.add(number)
    grouped = {n for group in _short_groups(units) if len(group) > 1 for n in group}
    cut, run, run_words = set(lines), [], 0
    for number, (_, _, words) in enumerate(units):
        if number in kept:
            run.append(number)
            run_words += len(words)
        elif run and (len(words) >= UNIT_WORDS or number in grouped):
            if run_words >= min_words:
                cut.update(range(run[0], run[-1] + 1))
            run, run_words = [], 0
    if run and run_words >= min_words:
        cut.update(range(run[0], run[-1] + 1))
    out: list[list] = []
    for number in sorted(cut):
        start, end, _ = units[number]
        if out and out[-1][1] == start:
            out[-1][1], out[-1][3] = end, out[-1][3] + 1
        else:
            out.append([start, end, kept[number], 1])
    return [tuple(r) for r in out]


def _cut(columns: Sequence[str], min_words: int, unit: str):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = re.compile(UNITS[unit])
        for batch in batches:
            texts, spans, n_units, n_removed = [], [], [], []
            for i in range(batch.num_rows):
                text = batch.column("text")[i].as_py()
                repeats = batch.column("_repeats")[i].as_py()
                units = list(_units(text or "", pattern))
                runs = find_runs(units, repeats, min_words) if repeats else []
                ends = [0, *(x for r in runs for x in r[:2]), len(text or "")]
                kept = "".join((text or "")[a:b] for a, b in zip(ends[::2], ends[1::2]))
                texts.append(None if text is None else kept)
                last = (1 << 63) - 1
                spans.append([{"start": a, "end": b, "kept_doc": None if d == last else d} for a, b, d, _ in runs])
                n_units.append(len(units))
                n_removed.append(sum(r[3] for r in runs))
            arrays = [pa.array(texts, pa.string()) if c == "text" else batch.column(c) for c in columns]
            arrays += [pa.array(spans, pa.list_(SPAN)), pa.array(n_units, pa.int32()), pa.array(n_removed, pa.int32())]
            yield pa.RecordBatch.from_arrays(arrays, [*columns, "removed", "n_units", "n_removed"])
            pa.default_memory_pool().release_unused()
        give_back()

    return work


def _schema_of(df: DataFrame, columns: Sequence[str]) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*columns).schema)


def remove_repeats(
    docs: DataFrame,
    min_words: int = MIN_WORDS,
    unit: str = "sentence",
    columns: Sequence[str] = ("doc_id", "text"),
    whole_lines: bool = False,
) -> DataFrame:
    """``columns`` of all documents, the text without its repeated passages, and
    removed (start, end, doc_id of the kept occurrence; in characters of the
    original text), n_units, n_removed.

    With ``whole_lines`` every repeated line goes, however short.

    A null text stays null, an empty one empty. Rows with equal doc_id and text
    are one document: none is a repeat of another, and they are cut alike. A
    null doc_id ranks after all others. Passages that repeat in one document
    are cut too. Other columns are left out; ``columns`` may not hold removed,
    n_units or n_removed.
    """
    columns = list(columns)
    rows = _keyed(docs, list(dict.fromkeys([*columns, "text"])))
    repeats = staged(repeated_units(docs, min_words, unit, whole_lines), "repeats")
    joined = rows.join(repeats, ["_id", "_text"], "left")
    return joined.mapInArrow(_cut(columns, min_words, unit), f"{_schema_of(rows, columns)}, {ADDED}")
