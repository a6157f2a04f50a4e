"""Scoring texts by prediction by partial matching over bytes.

A text is the sequence of its lower-cased words and an end. The model predicts
the bytes of a word, each from the up to ORDER bytes before it in the word (the
word's start counting as one), and then the space that ends it; the end of the
text is a line feed at a word's start. The counts of all contexts of the
training texts form a trie of byte contexts. Prediction starts at the longest
context that the trie has; a byte not seen there is reached by an escape, whose
probability is estimated from the bytes seen once, to the next shorter context,
in which the bytes of the longer one are excluded; after the empty context all
bytes left are equally likely. So the probabilities of all continuations add up
to one.

Each kind of document (language, say) has a trie; a text's probability is the
mixture of the tries, weighted by their share of training texts. It is thus
judged, after a few words, by the trie that fits, whatever its own label.

Contexts do not cross words, so a word has one probability for each kind, found
once for each distinct word and summed by document (``blocks``). Tries of up to
TRIE_ENTRIES entries are broadcast. Larger ones stay where they are counted: all
contexts of a byte but the two shortest end in the same two bytes, so the entries
are dealt to bins by these, words are sent to the bins of their bytes, and what
the bins find of a word is added up. Nothing is left out either way; the driver
and all tasks hold the entries of the two shortest contexts, 257 * 256 a kind at
most, and a task those of one bin.

Null and empty texts are an end alone. Repeated rows and null ids count as rows
of their own; an empty table gives no rows, and one without training texts is
scored by equally likely bytes. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import ANSWERS, block_words, build_blocks, pack_answers, with_answers
from .common import _LOWER, _SPACE, mix64, staged, texts_of

ORDER = 5
TRIE_ENTRIES = 3_000_000
# Kinds with a trie of their own, the most frequent; the rest share one.
KINDS = 8
END = b"\n"
_SCALES = np.multiply.accumulate(np.full(ORDER + 1, 0x9E3779B97F4A7C15, dtype=np.uint64))
_CODES = mix64(np.arange(1001, 1257, dtype=np.uint64))
_LOW_BYTE = np.uint64(0xFF)


def split_words(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """A ``blocks.Split`` into lower-cased words."""
    raw, offsets = texts_of(column)
    plain = _LOWER[raw]
    plain[_SPACE[raw]] = 0x20
    texts = pa.LargeStringArray.from_buffers(
        len(column), pa.py_buffer(offsets.tobytes()), pa.py_buffer(plain.tobytes())
    )
    parts = pc.split_pattern(texts, " ")
    words, at = parts.flatten(), parts.offsets.to_numpy()
    full = pc.not_equal(pc.binary_length(words), 0)
    kept = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))])
    return words.filter(full).cast(pa.string()), kept[at]


class Events:
    """The bytes to predict of some words, and the contexts before them."""

    def __init__(self, words: list[bytes]):
        coded = [b" " + w + (b"" if w == END else b" ") for w in words]
        sizes = np.array([len(c) for c in coded], dtype=np.int64)
        self.data = np.frombuffer(b"".join(coded), dtype=np.uint8)
        starts = np.cumsum(sizes) - sizes
        at = np.arange(len(self.data)) - np.repeat(starts, sizes)  # place in the word
        self.at = np.flatnonzero(at > 0)
        self.depth = at[self.at]
        self.symbols = self.data[self.at].astype(np.uint64)
        self.word = np.repeat(np.arange(len(words)), sizes)[self.at]

    def places(self) -> np.ndarray:
        """What all contexts of two bytes and more of an event share: 1 and more,
        by the two bytes before it; 0 where there is one byte only."""
        before = self.data[self.at - 1].astype(np.int64) << 8 | self.data[np.maximum(self.at - 2, 0)]
        return np.where(self.depth >= 2, before + 1, 0)

    def keep(self, chosen: np.ndarray) -> None:
        """Goes on with some of the events."""
        self.at, self.depth, self.symbols, self.word = (
            x[chosen] for x in (self.at, self.depth, self.symbols, self.word)
        )

    def contexts(self, kind: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(order, mask of the events that have it, context codes); the low byte
        of a code is free for the symbol."""
        sums = np.full(len(self.at), mix64(np.array([kind + 1], np.uint64))[0])
        for order in range(ORDER + 1):
            has = self.depth >= order
            yield order, has, mix64(sums + np.uint64(order)) & ~_LOW_BYTE
            back = self.data[np.maximum(self.at - order - 1, 0)]
            sums = sums + _CODES[back] * _SCALES[order]


COUNTS = "entry long, up long, place int, n long"


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """kind, word, n -> counts of (context, symbol), each with the entry of the
    context one byte shorter and its place (0 for the two shortest contexts)."""
    for batch in batches:
        kinds = batch.column("kind").to_numpy()
        weights = batch.column("n").to_numpy()
        for kind in np.unique(kinds):
            rows = np.flatnonzero(kinds == kind)
            words = batch.column("word").take(pa.array(rows)).to_pylist()
            events, up = Events([w.encode() for w in words]), None
            n, places = weights[rows][events.word], events.places()
            for order, has, code in events.contexts(int(kind)):
                entry = code | events.symbols
                keys, first, group = np.unique(entry[has], return_index=True, return_inverse=True)
                above = entry if up is None else up
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys.view(np.int64)),
                        pa.array(above[has][first].view(np.int64)),
                        pa.array(places[has][first] * (order > 1), pa.int32()),
                        pa.array(np.bincount(group, weights=n[has]).astype(np.int64)),
                    ],
                    ["entry", "up", "place", "n"],
                )
                up = entry


class Trie:
    """Entries (context and symbol) and contexts as sorted arrays."""

    def __init__(self, entry: np.ndarray, up: np.ndarray, n: np.ndarray):
        order = np.argsort(entry)
        self.entry, self.up, self.n = entry[order], up[order], n[order].astype(np.float64)
        nodes = self.entry & ~_LOW_BYTE
        self.node, first = np.unique(nodes, return_index=True)
        if not len(entry):
            self.total = self.once = self.size = self.left = self.left_once = self.left_size = np.zeros(0)
            return
        self.total = np.add.reduceat(self.n, first)
        self.once = np.add.reduceat((self.n == 1).astype(np.float64), first)
        self.size = np.diff(np.append(first, len(nodes))).astype(np.float64)
        # What the shorter context keeps when this one's symbols are excluded.
        above = np.searchsorted(self.entry, self.up)
        shorter = np.searchsorted(self.node, self.up[first] & ~_LOW_BYTE)
        self.left = self.total[shorter] - np.add.reduceat(self.n[above], first)
        self.left_once = self.once[shorter] - np.add.reduceat((self.n[above] == 1).astype(np.float64), first)
        self.left_size = self.size[shorter] - self.size

    @staticmethod
    def _find(sorted_: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Where the keys are, -1 where not. Sorted keys walk the table in order."""
        if not len(sorted_):
            return np.full(len(keys), -1)
        order = np.argsort(keys)
        at = np.empty(len(keys), np.int64)
        at[order] = np.minimum(np.searchsorted(sorted_, keys[order]), len(sorted_) - 1)
        return np.where(sorted_[at] == keys, at, -1)

    def score(self, words: list[bytes], kind: int, bin_: int = 0, bins: int = 1) -> np.ndarray:
        """log10 probability of each word, or the part of it that a bin has."""
        events = Events(words)
        if bins > 1:
            events.keep(bin_of(events.places(), bins).astype(np.int64) == bin_)
        out = np.zeros(len(events.at))
        open_ = np.ones(len(events.at), dtype=bool)
        came = np.full(len(events.at), -1)  # the longer context escaped from
        for _, has, code in reversed(list(events.contexts(kind))):
            rows = np.flatnonzero(open_ & has)
            node = self._find(self.node, code[rows])
            rows, node = rows[node >= 0], node[node >= 0]
            longer = came[rows]
            first = longer < 0
            total = np.where(first, self.total[node], self.left[longer]) if len(rows) else np.zeros(0)
            once = np.where(first, self.once[node], self.left_once[longer]) if len(rows) else np.zeros(0)
            escape = (once + 0.5) / (total + once + 1.0)
            found = self._find(self.entry, code[rows] | events.symbols[rows])
            hit = found >= 0
            out[rows[hit]] += np.log10(self.n[found[hit]] / total[hit] * (1.0 - escape[hit]))
            open_[rows[hit]] = False
            # With no symbol left there is nothing to escape from.
            gone = ~hit & (total > 0)
            out[rows[gone]] += np.log10(escape[gone])
            came[rows[~hit]] = node[~hit]
        unseen = 256.0 - np.where(came >= 0, self.size[came], 0.0) if len(self.node) else 256.0
        out -= np.where(open_, np.log10(np.maximum(unseen, 1.0)), 0.0)
        return np.bincount(events.word, weights=out, minlength=len(words))


def bin_of(places, bins: int):
    """The bin of some places (numbers, or a column of them), before rounding down."""
    return places * 2_654_435_761 % (1 << 32) * bins / (1 << 32)


def learn(words: DataFrame, entries: int = TRIE_ENTRIES) -> tuple[Trie, DataFrame | None, int]:
    """From kind, word, n: a whole trie of ``entries`` at most, nothing and one
    bin; or the two shortest contexts, all other entries and their bins."""
    counts = words.mapInArrow(_count, COUNTS)
    counts = counts.groupBy("entry").agg(F.min("up").alias("up"), F.min("place").alias("place"), F.sum("n").alias("n"))
    counts = staged(counts, "trie")
    size = counts.count()
    short = counts if size <= entries else counts.filter("place = 0")
    table = short.select("entry", "up", "n").toArrow().combine_chunks()
    trie = Trie(*_entries_of(table))
    if size <= entries:
        return trie, None, 1
    # Bins are uneven: a third of what a task may hold, on average.
    return trie, counts.filter("place > 0"), max(2, -(-3 * size // max(1, entries)))


def _entries_of(table: pa.Table | pa.RecordBatch) -> tuple[np.ndarray, ...]:
    entry, up, n = (table.column(c).to_numpy() for c in ("entry", "up", "n"))
    return entry.view(np.uint64), up.view(np.uint64), n


def _to_bins(bins: int):
    """word, n -> the word for each bin that has a byte of it."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            events = Events([w.encode() for w in batch.column("word").to_pylist()])
            codes = np.unique(events.word * bins + bin_of(events.places(), bins).astype(np.int64))
            rows = pa.array(codes // bins)
            yield pa.RecordBatch.from_arrays(
                [pa.array(codes % bins, pa.int32()), batch.column("word").take(rows), batch.column("n").take(rows)],
                ["bin", "word", "times"],
            )

    return work


def score_in_bins(words: DataFrame, trie: Trie, counts: DataFrame, bins: int, kinds: list[int]) -> DataFrame:
    """word, n, scores (one float for each kind) of the distinct ``words`` (word,
    n), by a trie of which ``counts`` are the entries that the driver lacks."""
    shared = words.sparkSession.sparkContext.broadcast(trie)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, pieces, found = -1, [], None
        for batch in batches:
            number, asked = (batch.column(c).to_numpy() for c in ("bin", "asked"))
            cuts = np.flatnonzero(np.diff(2 * number + asked)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(number)]):
                if a == b:
                    continue
                if number[a] != held:
                    held, pieces, found = int(number[a]), [], None
                some = batch.slice(a, b - a)
                if not asked[a]:
                    pieces.append(_entries_of(some))
                    continue
                if found is None:
                    short = shared.value
                    parts = [(short.entry, short.up, short.n), *pieces]
                    found, pieces = Trie(*(np.concatenate(x) for x in zip(*parts))), []
                given = [w.encode() for w in some.column("word").to_pylist()]
                scores = np.stack([found.score(given, k, held, bins) for k in kinds], axis=1)
                yield pa.RecordBatch.from_arrays(
                    [some.column("word"), some.column("times"), pa.array(scores.tolist(), pa.list_(pa.float64()))],
                    ["word", "n", "scores"],
                )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [np.array(x, "<f4").tobytes() for x in batch.column("scores").to_pylist()]
            arrays = [batch.column("word"), batch.column("n"), pa.array(scores, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["word", "n", "scores"])

    nothing = F.lit(None)
    entries = counts.select(
        F.floor(bin_of(F.col("place").cast("long"), bins)).cast("int").alias("bin"),
        F.lit(0).alias("asked"),
        nothing.cast("string").alias("word"),
        nothing.cast("long").alias("times"),
        "entry",
        "up",
        "n",
    )
    asked = words.mapInArrow(_to_bins(bins), "bin int, word string, times long").select(
        "bin",
        F.lit(1).alias("asked"),
        "word",
        "times",
        *(nothing.cast("long").alias(c) for c in ("entry", "up", "n")),
    )
    dealt = entries.unionByName(asked).repartition("bin").sortWithinPartitions("bin", "asked")
    parts = dealt.mapInArrow(work, "word string, n long, scores array<double>")
    sums = F.array(*(F.sum(F.col("scores")[i]) for i in range(len(kinds))))
    told = parts.groupBy("word").agg(F.max("n").alias("n"), sums.alias("scores"))
    return told.mapInArrow(pack, "word string, n long, scores binary")


SCORED = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)


def score_texts(docs: DataFrame, kind: str | None = "lang", entries: int = TRIE_ENTRIES) -> DataFrame:
    """Score ``docs`` (doc_id, text, train: boolean) and learn from those with
    train. ``kind`` names a column whose values have tries of their own.

    Returns doc_id, held_out (not train), n_tokens (words and the end), n_known
    (tokens that training has), train_tokens, base_score (log10 probability by
    token counts, add one) and score (the tries' log10 probability).
    """
    spark = docs.sparkSession
    train = F.coalesce(F.col("train"), F.lit(False))
    if kind is not None and kind in docs.columns:
        known = docs.filter(train & F.col(kind).isNotNull()).groupBy(F.col(kind).cast("string").alias("k"))
        top = known.count().orderBy(F.desc("count"), "k").limit(KINDS - 1).collect()
        number = F.lit(len(top))
        for i, row in enumerate(top):
            number = F.when(F.col(kind).cast("string") == row.k, F.lit(i)).otherwise(number)
    else:
        number = F.lit(0)
    given = docs.select(F.col("doc_id").cast("long"), "text", train.alias("flag"), number.alias("kind"))
    blocks = build_blocks(given, split_words, "ppm_blocks")
    counted = block_words(blocks).groupBy("word", "kind").agg(F.sum("n").alias("n"))
    counted = staged(counted, "ppm_words")

    ends = {r.kind: r.n for r in given.filter("flag").groupBy("kind").agg(F.count(F.lit(1)).alias("n")).collect()}
    kinds = sorted(ends)  # KINDS at most
    n_train = sum(ends.values())
    closing = [(k, END.decode(), n) for k, n in ends.items()]
    trained = counted.select("kind", "word", "n").filter("n > 0")
    closed = trained.unionByName(spark.createDataFrame(closing, "kind int, word string, n long"))
    trie, longer, bins = learn(closed, entries)
    totals = trained.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count_distinct("word")).first()
    n_all, n_distinct = totals[0] + n_train, totals[1] + (n_train > 0)
    shared = spark.sparkContext.broadcast(trie)
    priors = np.log10([ends[k] / n_train for k in kinds]) if kinds else np.zeros(1)
    kinds = kinds or [0]
    n_kinds = len(kinds)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [w.encode() for w in batch.column("word").to_pylist()]
            scores = np.stack([shared.value.score(words, k) for k in kinds], axis=1).astype("<f4")
            raw = scores.tobytes()
            size = 4 * n_kinds
            cells = [raw[i : i + size] for i in range(0, len(raw), size)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("word"), batch.column("n"), pa.array(cells, pa.binary())], ["word", "n", "scores"]
            )

    every = counted.groupBy("word").agg(F.sum("n").alias("n"))
    if longer is None:
        judged = every.mapInArrow(judge, "word string, n long, scores binary")
    else:
        judged = score_in_bins(every, trie, longer, bins, kinds)
    placed = block_words(blocks).select("word", "block", "code").join(judged, "word")

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column("n").to_numpy().astype("<i8")
            scores = batch.column("scores").to_pylist()

            def answer(rows: np.ndarray, n=n, scores=scores) -> bytes:
                return n[rows].tobytes() + b"".join(scores[i] for i in rows)

            yield pack_answers(batch.column("block").to_numpy(), batch.column("code").to_numpy(), answer)

    def place(codes: np.ndarray, found: list[tuple[int, bytes]]):
        counts, scores = np.zeros(len(codes), np.int64), np.zeros((len(codes), n_kinds))
        if found:
            counts[codes] = np.concatenate([np.frombuffer(d, "<i8", count=n) for n, d in found])
            scores[codes] = np.concatenate(
                [np.frombuffer(d, "<f4", offset=8 * n).reshape(n, n_kinds) for n, d in found]
            )
        return counts, scores

    size = n_all + n_distinct + 1.0
    end_scores = np.array([trie.score([END], k)[0] for k in kinds])

    def finish(table, row: dict, units: np.ndarray) -> pa.RecordBatch:
        counts, scores = table
        n_docs = len(row["sizes"])
        doc = np.repeat(np.arange(n_docs), row["sizes"])
        seen = counts[units]
        base = np.bincount(doc, weights=np.log10((seen + 1.0) / size), minlength=n_docs)
        base = base + np.log10((n_train + 1.0) / size)
        known = np.bincount(doc, weights=seen > 0, minlength=n_docs).astype(np.int64) + (n_train > 0)
        by_kind = np.stack(
            [np.bincount(doc, weights=scores[units, k], minlength=n_docs) for k in range(n_kinds)], axis=1
        )
        by_kind = by_kind + (end_scores + priors)
        best = by_kind.max(axis=1, keepdims=True)
        mixed = best[:, 0] + np.log10((10.0 ** (by_kind - best)).sum(axis=1))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(row["doc_ids"], pa.int64()),
                pa.array([not f for f in row["flags"]]),
                pa.array(np.array(row["sizes"], dtype=np.int64) + 1),
                pa.array(known),
                pa.array(np.full(n_docs, n_all, dtype=np.int64)),
                pa.array(base),
                pa.array(mixed),
            ],
            ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
        )

    return with_answers(blocks, placed.mapInArrow(tell, ANSWERS), place, finish, SCORED)
