"""Benchmark decontamination by latent semantic retrieval.

Passages are vectors of words, weighted by their rarity in the corpus (hashed to
TERMS places). A randomised singular value decomposition of the benchmark's
passages, computed by jobs over them, gives the directions in which benchmark
items differ; it is made for each RANK half passages of items, so that the
directions hold all of an item whatever the size of the benchmark. Passages of
documents are folded into them. A document passage is a candidate for an item
when the two have a high cosine there and the directions hold a fair share of
the document's. Items that stand in a text word for word are found without
directions, so also those of common words only. A candidate is judged on the words themselves:
by the longest common subsequence of the item with the text around the passage,
and by whether the item's answer, its last words, is found in order. So a
paraphrase with words changed, put in or left out is still found.

Words are runs of letters and digits, ASCII letters lower-cased. Null or empty
texts and items hold no passages and are never found; an empty table gives no
rows. Repeated rows, ties and null ids are judged row by row. Other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import each_batch, give_back, local_table, staged, text_chunks, texts_of, word_hashes

TERMS = 1 << 18
# Counts travel in pieces of so many terms.
PIECE = 1 << 10
# Half a passage; passages overlap by this many words.
HALF = 16
RANK = 192
EXTRA = 16
POWER_STEPS = 2
# Words in more than this share of passages' places say nothing about them.
COMMON = 1 / 200
COSINE = 0.5
HELD = 0.08
# Half passages screened at a time.
STEP_HALVES = 1 << 14
# Shares of an item's words in order: enough alone, and enough with the answer.
ALIKE = 0.7
ALIKE_WITH_ANSWER = 0.5
ANSWER_WORDS = 8
ANSWER_FOUND = 0.75
# Words of an item by whose hash its exact copies are looked up.
OPENING = 8
_STEP = np.uint64(0x9E3779B97F4A7C15)
# Items that are compared in one pass; they are broadcast.
ITEM_BLOCK = 2_000
# Bytes that part words: ASCII but letters and digits.
_BETWEEN = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def _places(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - 18)).astype(np.int64)


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(TERMS, dtype=np.int64)
    for batch in batches:
        for piece in text_chunks(batch):
            counts += np.bincount(_places(word_hashes(*texts_of(piece.column("text")), _BETWEEN)[0]), minlength=TERMS)
    if counts.any():
        rows = counts.reshape(-1, PIECE).astype("<i8")
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(rows)), pa.int32()), pa.array([r.tobytes() for r in rows], pa.binary())],
            ["piece", "counts"],
        )
    give_back()


def _add_up(size: int, kind: str, key: str):
    """Sum arrays (``counts``) of one key; the keys of a partition are bounded."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        at = pa.int32()
        for batch in batches:
            at = batch.schema.field(0).type
            for k, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = np.frombuffer(raw, dtype=kind, count=size)
                sums[k] = sums[k] + found if k in sums else found.copy()
        yield pa.RecordBatch.from_arrays(
            [pa.array(sums.keys(), at), pa.array([v.tobytes() for v in sums.values()], pa.binary())],
            [key, "counts"],
        )

    return work


def term_weights(docs: DataFrame) -> np.ndarray:
    """The weight of each term: the logarithm of how rare it is among all words
    of all texts, 0 for common terms. TERMS numbers, whatever the corpus."""
    counts = docs.select("text").mapInArrow(_count_terms, "piece int, counts binary")
    sums = counts.repartition("piece").mapInArrow(_add_up(PIECE, "<i8", "piece"), "piece int, counts binary")
    total = np.zeros(TERMS, dtype=np.int64)
    for row in sums.collect():  # TERMS / PIECE rows
        total[row.piece * PIECE : (row.piece + 1) * PIECE] = np.frombuffer(row.counts, "<i8")
    words = max(1, total.sum())
    weights = np.log(words / np.maximum(total, 1))
    weights[total > COMMON * words] = 0.0
    return weights.astype(np.float32)


@dataclass(frozen=True)
class Passages:
    """Passages of some texts: 2 * HALF words from every HALF words on."""

    text: np.ndarray
    first: np.ndarray  # number of the first word in its text
    words: np.ndarray  # all words, as hashes
    starts: np.ndarray  # of each word, its first byte and the byte behind it
    ends: np.ndarray
    word_at: np.ndarray  # of each text, where its words begin (n + 1 numbers)
    places: np.ndarray  # terms of the weighted words, in order, and their half passages
    half: np.ndarray
    length: np.ndarray  # squared lengths
    keep: np.ndarray  # the half passages that begin a passage
    follows: np.ndarray  # of each half passage, whether the text has a next one


def _half_of(texts: np.ndarray, n_texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each word the half passage it is in, the first half passage of each
    text (n + 1 numbers), and where the words of a text begin."""
    word_at = np.searchsorted(texts, np.arange(n_texts + 1))
    sizes = np.diff(word_at)
    halves = -(-sizes // HALF)
    half_at = np.concatenate([[0], np.cumsum(halves)])
    inside = np.arange(len(texts)) - word_at[texts]
    return half_at[texts] + inside // HALF, half_at, word_at


def cut_passages(weights: np.ndarray, raw: np.ndarray, offsets: np.ndarray) -> Passages:
    n_texts = len(offsets) - 1
    hashes, starts, ends, texts = word_hashes(raw, offsets, _BETWEEN)
    half, half_at, word_at = _half_of(texts, n_texts)
    n_halves = int(half_at[-1])
    places = _places(hashes)
    weight = weights[places]
    length = np.bincount(half, weights=weight.astype(np.float64) ** 2, minlength=n_halves)
    # A passage is a half and the next one of the same text.
    text_of = np.repeat(np.arange(n_texts), np.diff(half_at))
    follows = np.concatenate([text_of[1:] == text_of[:-1], [False]]) if n_halves else np.zeros(0, bool)
    length[:-1][follows[:-1]] += length[1:][follows[:-1]].copy()
    # The last half of a longer text is in the passage before it.
    alone = ~follows & np.concatenate([[False], follows[:-1]]) if n_halves else follows
    keep = np.flatnonzero(~alone)
    first = (np.arange(n_halves) - half_at[text_of]) * HALF
    held = np.flatnonzero(weight > 0)
    return Passages(
        text_of[keep], first[keep], hashes, starts, ends, word_at, places[held], half[held], length[keep], keep, follows
    )


class Folder:
    """Folds passages into the latent directions of a block of benchmark passages."""

    def __init__(self, weights: np.ndarray, terms: np.ndarray, directions: np.ndarray):
        self.row = np.full(TERMS, -1, dtype=np.int32)
        self.row[terms] = np.arange(len(terms))
        self.directions = (directions * weights[terms][:, None]).astype(np.float32)

    def fold(self, passages: Passages, rows: np.ndarray) -> np.ndarray:
        """The vectors of the passages numbered ``rows``."""
        first = passages.keep[rows]
        second = first[passages.follows[first]] + 1
        halves = np.unique(np.concatenate([first, second]))
        low = np.searchsorted(passages.half, halves)
        sizes = np.searchsorted(passages.half, halves, side="right") - low
        words = spans(low, sizes)
        row = self.row[passages.places[words]]
        known = np.flatnonzero(row >= 0)
        vectors = np.zeros((len(halves), self.directions.shape[1]), dtype=np.float32)
        if len(known):
            at = np.repeat(np.arange(len(halves)), sizes)[known]
            firsts = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
            vectors[at[firsts]] = np.add.reduceat(self.directions[row[known]], firsts, axis=0)
        out = vectors[np.searchsorted(halves, first)]
        out[passages.follows[first]] += vectors[np.searchsorted(halves, second)]
        return out


def spans(low: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers low, low + 1, ... of each span, one span after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(low - (ends - sizes), sizes)


def _sums(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sum of the values of each key, keys ascending."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    firsts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[firsts], np.add.reduceat(values[order], firsts) if len(keys) else values


class Screen:
    """Which passages can be candidates of which blocks, without folding them.

    The directions of a block hold its items whole, so a folded passage times an
    item is their product by words. A candidate has a cosine of COSINE and more
    than HELD of its length in the directions: its product with the item is more
    than COSINE * sqrt(HELD) of both lengths. Products come from the lists of the
    items that hold a term, so a passage costs what it shares with items, however
    many blocks there are. SLACK is for rounding.
    """

    SLACK = 0.98

    def __init__(self, weights: np.ndarray):
        self.weights = weights
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.block_of = np.zeros(0, dtype=np.int64)

    def add(self, block: int, passages: Passages, real: np.ndarray, norms: np.ndarray) -> None:
        """The items' passages of a block; ``real`` are those with a vector."""
        first = passages.keep[real]
        for halves, whose in (
            (first, np.arange(len(first))),
            (first[passages.follows[first]] + 1, np.flatnonzero(passages.follows[first])),
        ):
            low = np.searchsorted(passages.half, halves)
            sizes = np.searchsorted(passages.half, halves, side="right") - low
            places, item = passages.places[spans(low, sizes)], np.repeat(whose, sizes)
            value = self.weights[places].astype(np.float64) ** 2 / norms[real][item]
            self.parts.append((places, item + len(self.block_of), value))
        self.block_of = np.concatenate([self.block_of, np.full(len(first), block)])

    def close(self) -> None:
        places, items, values = map(np.concatenate, zip(*self.parts)) if self.parts else (np.zeros(0, np.int64),) * 3
        keys, self.value = _sums(places * max(1, len(self.block_of)) + items, values)
        self.item = keys % max(1, len(self.block_of))
        self.at = np.searchsorted(keys // max(1, len(self.block_of)), np.arange(TERMS + 1))
        self.parts = []

    def near(self, passages: Passages) -> dict[int, np.ndarray]:
        """Block -> numbers of the passages that can be candidates there."""
        n_items, n_halves = len(self.block_of), len(passages.follows)
        place_of = np.full(n_halves, -1, dtype=np.int64)
        place_of[passages.keep] = np.arange(len(passages.keep))
        found: list[np.ndarray] = []
        # Some thousand halves at a time: what they share with items is held at once.
        for a in range(0, n_halves, STEP_HALVES):
            b = min(n_halves, a + STEP_HALVES + 1)  # the next half ends the last passage
            low, high = np.searchsorted(passages.half, [a, b])
            places, half = passages.places[low:high], passages.half[low:high]
            sizes = self.at[places + 1] - self.at[places]
            listed = spans(self.at[places], sizes)
            keys, dots = _sums(np.repeat(half, sizes) * n_items + self.item[listed], self.value[listed])
            half = keys // max(1, n_items)
            second = np.flatnonzero((half > a) & passages.follows[half - 1])
            keys, dots = _sums(
                np.concatenate([keys, keys[second] - n_items]), np.concatenate([dots, dots[second]])
            )
            passage = place_of[keys // max(1, n_items)]
            least = self.SLACK * COSINE * np.sqrt(HELD * passages.length[passage])
            over = (passage >= 0) & (dots >= least) & (keys < (a + STEP_HALVES) * n_items)
            found.append(np.stack([self.block_of[keys[over] % max(1, n_items)], passage[over]]))
        blocks, rows = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
        return {int(k): np.unique(rows[blocks == k]) for k in np.unique(blocks)}


def _projected(weights: np.ndarray, keys: np.ndarray | None, basis: np.ndarray | None, seed: int):
    """A passage of work over the blocks of the benchmark: for each block and term
    that occurs (as block * TERMS + term), the sum of (its weight in a passage) *
    (the passage times the basis of the block). Without a basis, a term's basis
    row is drawn from its number."""
    wide = RANK + EXTRA

    def rows_of(found: np.ndarray) -> np.ndarray:
        if basis is None:
            return np.stack([np.random.default_rng([seed, int(p) % TERMS]).standard_normal(wide) for p in found])
        return basis[np.searchsorted(keys, found)]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, _, _, texts = word_hashes(*texts_of(batch.column("text")), _BETWEEN)
            half, _, _ = _half_of(texts, batch.num_rows)
            places = _places(hashes)
            held = weights[places] > 0
            half, places, block = half[held], places[held], batch.column("block").to_numpy()[texts[held]]
            found, place = np.unique(block.astype(np.int64) * TERMS + places, return_inverse=True)
            if not len(found):
                continue
            value = weights[places].astype(np.float64)
            n = int(half.max()) + 1
            matrix_rows = rows_of(found)
            vectors = np.zeros((n, matrix_rows.shape[1]))
            np.add.at(vectors, half, matrix_rows[place] * value[:, None])
            sums = np.zeros((len(found), matrix_rows.shape[1]))
            np.add.at(sums, place, vectors[half] * value[:, None])
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.int64()), pa.array([s.astype("<f8").tobytes() for s in sums], pa.binary())],
                ["term", "counts"],
            )

    return work


def latent_directions(parts: DataFrame, n_blocks: int, weights: np.ndarray, seed: int = 11) -> list[Folder]:
    """Randomised SVD of the passages A of each block of ``parts`` (block, text;
    see ``item_parts``): the range of A'A is sampled with random vectors and
    sharpened by POWER_STEPS more products, each a job over all blocks. A block
    has RANK half passages at most, so its directions hold all of their energy.
    A product has one row per block and term (a block's words at most), which is
    what tasks need of the result, too."""
    keys = basis = None
    wide, product = RANK + EXTRA, np.zeros((0, RANK + EXTRA))
    for step in range(POWER_STEPS + 1):
        made = parts.mapInArrow(_projected(weights, keys, basis, seed), "term long, counts binary")
        sums = made.repartition("term").mapInArrow(_add_up(wide, "<f8", "term"), "term long, counts binary")
        rows = sorted((r.term, r.counts) for r in sums.collect())  # words of the parts at most
        keys = np.array([r[0] for r in rows], dtype=np.int64)
        product = np.stack([np.frombuffer(r[1], "<f8") for r in rows]) if rows else product
        cuts = np.searchsorted(keys, np.arange(n_blocks + 1) * TERMS)
        if step < POWER_STEPS:
            basis = np.zeros((len(keys), wide))
            for a, b in zip(cuts[:-1], cuts[1:]):
                q = np.linalg.qr(product[a:b])[0]
                basis[a:b, : q.shape[1]] = q
    out = []
    for a, b in zip(cuts[:-1], cuts[1:]):
        if a == b:
            out.append(Folder(weights, np.zeros(0, np.int64), np.zeros((0, 1))))
            continue
        # product = A'A Q: within the basis, A'A is Q' product; its eigenvectors order the directions.
        inner = basis[a:b].T @ product[a:b]
        values, vectors = np.linalg.eigh((inner + inner.T) / 2)
        order = np.argsort(-values)[:RANK]
        kept = order[values[order] > 1e-9 * max(values.max(), 1e-12)]
        out.append(Folder(weights, keys[a:b] % TERMS, basis[a:b] @ vectors[:, kept]))
    return out


def item_parts(texts: Sequence[str]) -> list[list[tuple[int, str]]]:
    """Items in blocks of RANK half passages at most, as (number of the item,
    text). An item of more is cut; its parts share a half passage, so that each
    passage is whole in one."""
    raw, offsets = texts_of(pa.array(texts, pa.large_string()))
    _, starts, ends, owner = word_hashes(raw, offsets, _BETWEEN)
    word_at = np.searchsorted(owner, np.arange(len(texts) + 1))
    blocks: list[list[tuple[int, str]]] = []
    room = 0
    for item in range(len(texts)):
        first, last = int(word_at[item]), int(word_at[item + 1])
        while first < last:
            end = min(last, first + RANK * HALF)
            halves = -(-(end - first) // HALF)
            if halves > room:
                blocks.append([])
                room = RANK
            blocks[-1].append((item, raw[starts[first] : ends[end - 1]].tobytes().decode()))
            room -= halves
            first = last if end == last else end - HALF
    return blocks


def common_words(item: Sequence[int], text: Sequence[int]) -> int:
    """Length of the longest common subsequence, by bits of one whole number."""
    where: dict[int, int] = {}
    for i, word in enumerate(item):
        where[word] = where.get(word, 0) | 1 << i
    full = (1 << len(item)) - 1
    state = full
    for word in text:
        hit = state & where.get(word, 0)
        if hit:
            state = (state + hit | state - hit) & full
    return len(item) - state.bit_count()


def _windows(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of each ``size`` words in a row."""
    n = max(0, len(words) - size + 1)
    out = np.zeros(n, dtype=np.uint64)
    for k in range(size):
        out = out * _STEP + words[k : k + n]
    return out


class Judge:
    """Finds a block of benchmark items in texts."""

    def __init__(
        self,
        weights: np.ndarray,
        folders: Sequence[Folder],
        parts: Sequence[Sequence[tuple[int, str]]],
        ids: Sequence[int],
        texts: Sequence[str],
    ):
        self.weights, self.ids, self.blocks = weights, ids, []
        self.screen = Screen(weights)
        for folder, block in zip(folders, parts):
            passages = cut_passages(weights, *texts_of(pa.array([t for _, t in block], pa.large_string())))
            vectors = folder.fold(passages, np.arange(len(passages.keep)))
            norms = np.linalg.norm(vectors, axis=1)
            real = norms > 0
            if real.any():
                self.screen.add(len(self.blocks), passages, real, norms)
                item = np.array([i for i, _ in block])[passages.text[real]]
                self.blocks.append((folder, item, (vectors[real] / norms[real][:, None]).T))
        self.screen.close()
        whole = cut_passages(weights, *texts_of(pa.array(texts, pa.large_string())))
        hashes = [whole.words[a:b] for a, b in zip(whole.word_at[:-1], whole.word_at[1:])]
        self.words = [h.tolist() for h in hashes]
        # The first words of items, by how many they are: sorted hashes and their items.
        opening: dict[int, list[tuple[int, int]]] = {}
        for i, h in enumerate(hashes):
            if len(h):
                size = min(len(h), OPENING)
                opening.setdefault(size, []).append((int(_windows(h[:size], size)[0]), i))
        self.opening = {}
        for size, pairs in opening.items():
            pairs.sort()
            keys = np.array([p[0] for p in pairs], dtype=np.uint64)
            self.opening[size] = keys, [p[1] for p in pairs]

    def verbatim(self, passages: Passages) -> dict[tuple[int, int], tuple[int, int]]:
        """First and last word of the items that stand in the texts word for word."""
        found: dict[tuple[int, int], tuple[int, int]] = {}
        for size, (keys, items) in self.opening.items():
            codes = _windows(passages.words, size)
            low = np.searchsorted(keys, codes)
            hits = np.flatnonzero(keys[np.minimum(low, len(keys) - 1)] == codes)
            texts = np.searchsorted(passages.word_at, hits, side="right") - 1
            for at, text in zip(hits.tolist(), texts.tolist()):
                begin, end = int(passages.word_at[text]), int(passages.word_at[text + 1])
                k = int(low[at])
                while k < len(keys) and keys[k] == codes[at]:
                    words = self.words[items[k]]
                    stop = at + len(words)
                    if (text, items[k]) not in found and stop <= end and passages.words[at:stop].tolist() == words:
                        found[text, items[k]] = (at - begin, stop - begin)
                    k += 1
        return found

    def find(self, raw: np.ndarray, offsets: np.ndarray) -> list[tuple]:
        """(text, item, cosine, alike, answer, first word, last word) of what is found."""
        passages = cut_passages(self.weights, raw, offsets)
        found: dict[tuple[int, int], tuple] = {}
        exact = self.verbatim(passages)
        nearest = dict.fromkeys(exact, 0.0)
        near_of = self.screen.near(passages)
        nothing = np.zeros(0, dtype=np.int64)
        for block, (folder, items, item_vectors) in enumerate(self.blocks):
            members = set(items.tolist())
            copies = [pair for pair in exact if pair[1] in members]
            copied = np.zeros(len(offsets) - 1, dtype=bool)
            copied[[text for text, _ in copies]] = True
            asked = np.union1d(near_of.get(block, nothing), np.flatnonzero(copied[passages.text]) if copies else nothing)
            for at in range(0, len(asked), 4096):
                rows = asked[at : at + 4096]
                vectors = folder.fold(passages, rows)
                squares = np.einsum("ij,ij->i", vectors, vectors, dtype=np.float64)
                # The directions hold all of an item: what they hold of a passage is its share of items.
                held = squares > HELD * np.maximum(passages.length[rows], 1e-9)
                some = held | (copied[passages.text[rows]] & (squares > 0))
                rows, vectors, squares, fair = rows[some], vectors[some], squares[some], held[some]
                cosine = (vectors / np.sqrt(squares).astype(np.float32)[:, None]) @ item_vectors
                for text, item in copies:
                    low, high = np.searchsorted(passages.text[rows], [text, text + 1])
                    if low < high:
                        best = float(cosine[low:high, items == item].max())
                        nearest[text, item] = max(nearest[text, item], best)
                for r, c in zip(*np.nonzero((cosine >= COSINE) & fair[:, None])):
                    text, item = int(passages.text[rows[r]]), int(items[c])
                    near = float(cosine[r, c])
                    if (text, item) in exact:
                        continue
                    words = self.words[item]
                    start, end = passages.word_at[text], passages.word_at[text + 1]
                    first = int(passages.first[rows[r]])
                    low, high = max(0, first - len(words)), min(int(end - start), first + 2 * HALF + len(words))
                    around = passages.words[start + low : start + high].tolist()
                    alike = common_words(words, around) / len(words)
                    answer = words[-ANSWER_WORDS:]
                    has_answer = common_words(answer, around) >= ANSWER_FOUND * len(answer)
                    if alike >= ALIKE or (alike >= ALIKE_WITH_ANSWER and has_answer):
                        old = found.get((text, item))
                        if old is None or (alike, near) > (old[1], old[0]):
                            found[text, item] = (near, alike, has_answer, low, high)
        found.update({k: (nearest[k], 1.0, True, low, high) for k, (low, high) in exact.items()})
        return [(t, i, *v) for (t, i), v in sorted(found.items())]


def _judges(docs: DataFrame, benchmark: DataFrame) -> Iterator[Judge]:
    """One judge for each block of ITEM_BLOCK items, in order of id."""
    items = benchmark.filter(F.col("text").isNotNull()).select(F.col("item_id").cast("long"), "text")
    weights = term_weights(docs)
    ordered = items.withColumn("_key", F.struct("item_id", F.xxhash64("text"))).select("_key", "text").distinct()
    ordered, last = staged(ordered, "items"), None
    while True:
        rest = ordered if last is None else ordered.filter(F.col("_key") > F.lit(last))
        rows = rest.orderBy("_key").limit(ITEM_BLOCK).select("_key.*", "text").collect()
        if rows:
            texts = [r[2] for r in rows]
            parts = item_parts(texts)
            listed = [(b, text) for b, block in enumerate(parts) for _, text in block]
            columns = {"block": pa.array([b for b, _ in listed], pa.int32()), "text": [text for _, text in listed]}
            given = local_table(docs.sparkSession, columns, "block int, text string")
            yield Judge(weights, latent_directions(given, len(parts), weights), parts, [r[0] for r in rows], texts)
        if len(rows) < ITEM_BLOCK:
            return
        last = F.struct(F.lit(rows[-1][0]).cast("long"), F.lit(rows[-1][1]).cast("long"))


FOUND = (
    "doc_id long, item_id long, cosine double, alike double, answer_found boolean, first_word int, last_word int"
)


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents that hold benchmark items, a row for each pair: doc_id,
    item_id, cosine of the nearest passages, alike (share of the item's words
    found in order), answer_found, and the words of the document between which
    the item lies."""
    spark, out = docs.sparkSession, None
    given = docs.select(F.col("doc_id").cast("long"), "text")
    for judge in _judges(docs, benchmark):
        shared = spark.sparkContext.broadcast(judge)

        def work(batch: pa.RecordBatch, shared=shared) -> Iterator[pa.RecordBatch]:
            for piece in text_chunks(batch):
                ids, known = piece.column("doc_id").to_pylist(), shared.value
                found = known.find(*texts_of(piece.column("text")))
                rows = [
                    (ids[t], known.ids[i], near, alike, bool(answer), low, high)
                    for t, i, near, alike, answer, low, high in found
                ]
                columns = list(zip(*rows)) if rows else [()] * 7
                kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.bool_(), pa.int32(), pa.int32()]
                names = [f.split()[0] for f in FOUND.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        part = given.mapInArrow(each_batch(work), FOUND)
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], FOUND) if out is None else out


def drop_leaks(docs: DataFrame, benchmark: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``columns`` (text among them) of the documents that hold no benchmark item."""
    rest = docs.select(*columns)
    for judge in _judges(docs, benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(judge)

        def work(batch: pa.RecordBatch, shared=shared) -> Iterator[pa.RecordBatch]:
            for piece in text_chunks(batch):
                clean = np.ones(piece.num_rows, dtype=bool)
                clean[[f[0] for f in shared.value.find(*texts_of(piece.column("text")))]] = False
                yield piece.filter(pa.array(clean))

        rest = rest.mapInArrow(each_batch(work), rest.schema)
    return rest
