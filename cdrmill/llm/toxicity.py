"""Toxicity by a support vector machine with a gap-weighted subsequence kernel.

The kernel compares two strings by the sequences of LENGTH letters that both
hold, in order but not necessarily side by side: an occurrence with g other
letters in between counts DECAY**g, and spans SPAN letters at most. Inserted
characters thus weaken a match and do not destroy it. Texts are read as letters
(case, look-alike digits and signs folded, other characters as one separator,
single letters in a row joined), so that "i d i o t" and "i.d.i.o.t" are whole.

Training is by sentences of labelled texts, windows of WINDOW letters. The
kernel is taken against landmarks (Nystroem): words that mark the classes, and
frequent ones. A label says that some window of its text is toxic, not which:
rounds of training choose the highest scoring window of each toxic text, and the
highest of each clean one to learn from. As kernel values against landmarks are
linear in the subsequence weights, the trained machine is one table of weights,
LETTERS ** LENGTH numbers whatever the data; scoring looks up each position of
the whole text, and a text scores as its highest window, turned into a
probability.

Null and empty texts score as a text without any subsequence. Ties, repeated
rows and null ids are scored row by row. Without labels of both classes all
texts get the share of toxic labels (0 without labels).
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import give_back, text_chunks, texts_of

LENGTH = 4
SPAN = 6
DECAY = 0.8
WINDOW = 8
LANDMARKS = 256
ROUNDS = 4
# A toxic text teaches by windows that are above this share of the clean texts'
# highest windows; a text whose label is wrong has none.
STANDS_OUT = 0.995
# Of the texts that hold a marking word, even within a longer one, at least this
# share is toxic; and chance would make any word so with less than this probability.
MARKED_SHARE = 0.7
BY_CHANCE = 0.1
AROUND = 12
# Characters put into marking words, to learn from them too.
INSERTED = "*xq"
COST = 0.2
# Labelled texts of each class that are learnt from, at most.
TRAINING_TEXTS = 1_500
THRESHOLD = 0.7
# Text that is scored at a time: its arrays stay in the processor's cache.
SCORED_BYTES = 1 << 18
# Symbols: separator 0, letters 1-26, bytes beyond ASCII 27.
LETTERS = 28
# Digits and signs that stand for letters.
LOOKALIKES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}

_CODE = np.zeros(256, dtype=np.uint8)
for _i in range(26):
    _CODE[ord("a") + _i] = _CODE[ord("A") + _i] = _i + 1
for _sign, _letter in LOOKALIKES.items():
    _CODE[ord(_sign)] = _CODE[ord(_letter)]
_CODE[128:] = 27

# Offsets of the letters after the first, and the weight of such an occurrence.
PATTERNS = [(c, DECAY ** (c[-1] - LENGTH + 1)) for c in combinations(range(1, SPAN), LENGTH - 1)]


def letters(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of many texts, and n+1 offsets of the texts in them. Runs of
    separators are one; between single letters there is none; SPAN separators
    end a text, so that no subsequence goes on in the next."""
    n = len(offsets) - 1
    codes = np.insert(_CODE[raw], offsets[1:], 0)
    ends = offsets[1:] + np.arange(n)  # where these separators are
    gap = codes == 0
    kept = ~gap
    kept[1:] |= ~gap[:-1]
    kept[ends] = True
    full = np.concatenate([[True, True], gap, [True, True]])
    single = ~full[2:-2] & full[1:-3] & full[3:-1]
    # Of a run of separators only the first stands: single letters on its both sides?
    after = np.concatenate([single[1:], [False]])
    before = np.concatenate([[False], single[:-1]])
    joint = gap & after & before
    joint[ends] = False
    kept &= ~joint
    sizes = np.add.reduceat(kept, np.concatenate([[0], ends[:-1] + 1])) if n else np.zeros(0, np.int64)
    at = np.concatenate([[0], np.cumsum(sizes)])
    codes = np.insert(codes[kept], np.repeat(at[1:], SPAN - 1), 0)
    return codes, at + np.arange(n + 1) * (SPAN - 1)


def occurrences(codes: np.ndarray) -> Iterator[tuple[np.ndarray, float]]:
    """For each pattern the subsequence that starts at each symbol, and the
    weight. A separator in it leaves a zero among its digits."""
    n = len(codes)
    wide = np.concatenate([codes, np.zeros(2 * SPAN, codes.dtype)]).astype(np.int64)
    first, second, third, fourth = (wide * LETTERS**k for k in range(LENGTH))
    m = n + SPAN
    heads = {a: first[:m] + second[a : a + m] for a in {o[0] for o, _ in PATTERNS}}
    tails = {g: third[:m] + fourth[g : g + m] for g in {o[2] - o[1] for o, _ in PATTERNS}}
    for (a, b, c), weight in PATTERNS:
        yield heads[a][:n] + tails[c - b][b : b + n], weight


def _whole(index: np.ndarray) -> np.ndarray:
    """Which subsequences hold no separator."""
    out = np.ones(len(index), dtype=bool)
    for k in range(LENGTH):
        out &= index // LETTERS**k % LETTERS != 0
    return out


def highest_windows(codes: np.ndarray, offsets: np.ndarray, weights: np.ndarray):
    """Score of the highest window of each text, where it starts, and the
    scores of all windows."""
    n = len(offsets) - 1
    if not n:
        return np.zeros(0), np.zeros(0, np.int64), np.zeros(0)
    score = np.zeros(len(codes), dtype=np.float32)
    for index, weight in occurrences(codes):
        score += weights[index] * np.float32(weight)
    sums = np.zeros(len(codes) + WINDOW + 1)
    np.cumsum(score, out=sums[1 : len(codes) + 1])
    sums[len(codes) + 1 :] = sums[len(codes)]
    text_end = np.repeat(offsets[1:], np.diff(offsets))
    windows = sums[np.minimum(np.arange(len(codes)) + WINDOW, text_end)] - sums[: len(codes)]
    best = np.maximum.reduceat(windows, offsets[:-1])
    hits = np.flatnonzero(windows >= np.repeat(best, np.diff(offsets)))
    return best, hits[np.searchsorted(hits, offsets[:-1])], windows


def all_windows(codes: np.ndarray, offsets: np.ndarray, weights: np.ndarray):
    """``highest_windows`` over many texts, a bounded piece at a time."""
    parts, start = [], 0
    windows = np.empty(len(codes), dtype=np.float32)
    while start < len(offsets) - 1:
        end = int(np.searchsorted(offsets, offsets[start] + SCORED_BYTES, side="right")) - 1
        end = min(max(end, start + 1), len(offsets) - 1)
        low, high = offsets[start], offsets[end]
        best, at, windows[low:high] = highest_windows(codes[low:high], offsets[start : end + 1] - low, weights)
        parts.append((best, at + low))
        start = end
    return *(np.concatenate(x) for x in zip(*parts)), windows


def standing_out(windows: np.ndarray, bar: float) -> np.ndarray:
    """Windows above ``bar`` that are the highest among those they overlap."""
    taken, free = [], np.ones(len(windows) + 2 * WINDOW, dtype=bool)
    above = np.flatnonzero(windows > bar)
    for i in above[np.argsort(-windows[above], kind="stable")]:
        if free[i + WINDOW]:
            taken.append(i)
            free[i + 1 : i + 2 * WINDOW] = False
    return np.array(sorted(taken), dtype=np.int64)


@dataclass(frozen=True)
class Machine:
    """Weights of all subsequences, and probabilities by score."""

    weights: np.ndarray
    scores: np.ndarray
    chances: np.ndarray

    def probability(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        best = highest_windows(*letters(raw, offsets), self.weights)[0]
        # The second part, at most 0.001, keeps the order within a flat stretch.
        return 0.999 * np.interp(best, self.scores, self.chances) + 0.0005 * (1.0 + np.tanh(best / 8.0))


def _constant(share: float) -> Machine:
    return Machine(np.zeros(LETTERS**LENGTH, np.float32), np.zeros(1), np.array([share]))


def _packed(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    return texts_of(pa.array(texts, pa.large_string()))


WORD = re.compile(r"[^\W\d_]{4,}")


def choose_landmarks(
    texts: Sequence[str], toxic: np.ndarray, stands_for: tuple[float, float] = (1.0, 1.0)
) -> tuple[list[str], set[str]]:
    """Words that mark the classes most, then frequent ones; and those that
    mark toxic texts strongly. Copies of a text count once."""
    counts = [Counter(), Counter()]
    distinct = sorted({(text.lower(), bool(label)) for text, label in zip(texts, toxic)})
    for text, label in distinct:
        counts[label].update(set(WORD.findall(text)))
    label = np.array([label for _, label in distinct])
    n = [int((label == k).sum()) for k in (0, 1)]
    words = sorted(set(counts[0]) | set(counts[1]))
    if not words:
        return [], set()
    has = np.array([[c[w] for w in words] for c in counts], dtype=np.float64)
    odds = np.log((has[1] + 0.5) / (n[1] + 1)) - np.log((has[0] + 0.5) / (n[0] + 1))
    strength = odds * np.sqrt(has[0] + has[1])
    marked = np.argsort(-strength, kind="stable")[: LANDMARKS // 2]
    opposed = np.argsort(strength, kind="stable")[: LANDMARKS // 4]
    frequent = np.argsort(-has[0], kind="stable")[: LANDMARKS // 4]
    chosen = dict.fromkeys([*marked, *opposed, *frequent])
    # The kernel does not see where a word begins, so texts count that hold it
    # anywhere; those with the same letters around it, near copies, count once.
    share, strong = n[1] / len(label), set()
    for i in marked:
        found = ((text, text.find(words[i]), y) for text, y in distinct)
        near = {(text[max(0, at - AROUND) : at + len(words[i]) + AROUND], y) for text, at, y in found if at >= 0}
        held = np.array([int(y) for _, y in near])
        toxic_share = held.mean()
        if toxic_share <= share or np.average(held, weights=np.take(stands_for, held)) < MARKED_SHARE:
            continue
        # Chernoff's bound on so many toxic texts among those with the word.
        gain = toxic_share * np.log(toxic_share / share)
        if toxic_share < 1:
            gain += (1 - toxic_share) * np.log((1 - toxic_share) / (1 - share))
        if len(words) * np.exp(-len(held) * gain) < BY_CHANCE:
            strong.add(words[i])
    return [words[i] for i in chosen], strong


class Kernel:
    """Kernel values against landmarks."""

    def __init__(self, landmarks: Sequence[str]):
        codes, offsets = letters(*_packed(landmarks))
        of = np.repeat(np.arange(len(landmarks)), np.diff(offsets))
        rows, features, values = [], [], []
        for index, weight in occurrences(codes):
            real = _whole(index)
            rows.append(of[real])
            features.append(index[real])
            values.append(np.full(int(real.sum()), weight))
        self.features, place = np.unique(np.concatenate(features), return_inverse=True)
        self.table = np.zeros((len(self.features) + 1, len(landmarks)))
        np.add.at(self.table, (place, np.concatenate(rows)), np.concatenate(values))
        self.column = np.full(LETTERS**LENGTH, len(self.features), dtype=np.int64)
        self.column[self.features] = np.arange(len(self.features))
        self.table /= np.maximum(np.sqrt((self.table**2).sum(axis=0)), 1e-9)  # k(l, l) = 1
        gram = self.table.T @ self.table
        values, vectors = np.linalg.eigh(gram)
        kept = values > 1e-6 * values.max()
        self.root = vectors[:, kept] / np.sqrt(values[kept])  # K ** -1/2 on its range
        self.mapped = self.table @ self.root

    def features_of(self, codes: np.ndarray, offsets: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Nystroem features of the windows that start at some symbols."""
        if not len(at):
            return np.zeros((0, self.mapped.shape[1]))
        end = offsets[np.searchsorted(offsets, at, side="right")]
        spans = at[:, None] + np.arange(WINDOW)
        near = np.concatenate([codes, np.zeros(WINDOW + SPAN, codes.dtype)])
        out = np.zeros((len(at), self.mapped.shape[1]), dtype=np.float32)
        # The windows alone, one after another with their surroundings.
        cut = near[at[:, None] + np.arange(WINDOW + SPAN)]
        for index, weight in occurrences(cut.ravel()):
            column = self.column[index].reshape(len(at), -1)[:, :WINDOW]
            column = np.where(spans < end[:, None], column, len(self.features))
            for k in range(WINDOW):
                held = np.flatnonzero(column[:, k] < len(self.features))
                out[held] += weight * self.mapped[column[held, k]]
        return out

    def weights(self, machine: np.ndarray) -> np.ndarray:
        """The weight of each subsequence, from those of the features."""
        out = np.zeros(LETTERS**LENGTH, dtype=np.float32)
        out[self.features] = (self.mapped[:-1] @ machine).astype(np.float32)
        return out


def support_vectors(x: np.ndarray, y: np.ndarray, cost: float = COST, steps: int = 30) -> np.ndarray:
    """Linear machine with squared hinge loss (Newton steps on the rows inside
    the margin); the last weight is the offset."""
    w = np.zeros(x.shape[1] + 1)
    keep = np.eye(len(w))
    keep[-1, -1] = 1e-3
    for _ in range(steps):
        square, goal = np.zeros_like(keep), np.zeros_like(w)
        for at in range(0, len(x), 4096):  # so many rows are held as doubles
            some, sign = x[at : at + 4096].astype(np.float64), y[at : at + 4096]
            some = np.hstack([some, np.ones((len(some), 1))])
            inside = sign * (some @ w) < 1
            square += some[inside].T @ some[inside]
            goal += some[inside].T @ sign[inside]
        new = np.linalg.solve(keep + 2 * cost * square, 2 * cost * goal)
        if np.allclose(new, w, atol=1e-9):
            break
        w = new
    return w


def _calibrate(score: np.ndarray, toxic: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities by score: the rising step function that fits the labels
    best (neighbours out of order are pooled), as points to interpolate."""
    order = np.argsort(score, kind="stable")
    pools: list[list[float]] = []  # lowest and highest score, toxic texts, texts
    for s, t, w in zip(score[order], toxic[order], weights[order]):
        pools.append([float(s), float(s), float(t) * w, w])
        while len(pools) > 1 and pools[-2][2] * pools[-1][3] >= pools[-1][2] * pools[-2][3]:
            _, high, marked, n = pools.pop()
            pools[-1] = [pools[-1][0], high, pools[-1][2] + marked, pools[-1][3] + n]
    table = np.array(pools)
    # Between two pools the step is in the middle of the gap, as the margin's is.
    table[1:, 0] = (table[1:, 0] + table[:-1, 1]) / 2
    chances = (table[:, 2] + 0.5) / (table[:, 3] + 1.0)
    return table[:, :2].ravel(), np.maximum.accumulate(np.repeat(chances, 2))


def train(texts: Sequence[str], toxic: Sequence[bool], stands_for: tuple[float, float] = (1.0, 1.0)) -> Machine:
    """Learn from labelled texts; a clean one and a toxic one stand for so many."""
    toxic = np.asarray(toxic, dtype=bool)
    weights = np.take(stands_for, toxic.astype(int)).astype(float)
    share = float(np.average(toxic, weights=weights)) if len(toxic) else 0.0
    landmarks, strong = choose_landmarks(texts, toxic, stands_for) if 0 < share < 1 else ([], set())
    if not strong:
        return _constant(share)
    table = _fit(Kernel(landmarks), strong, texts, toxic)
    best = all_windows(*letters(*_packed(texts)), table)[0]
    return Machine(table, *_calibrate(best, toxic, weights))


def _fit(kernel: Kernel, strong: set[str], texts: Sequence[str], toxic: np.ndarray) -> np.ndarray:
    """The table of weights after ROUNDS of choosing windows and training."""
    codes, offsets = letters(*_packed(texts))
    sizes = np.diff(offsets)
    # The first choice in toxic texts: windows that begin with a marking word.
    pieces = [
        text[found.start() : found.end() + SPAN]
        for text, label in zip(texts, toxic)
        if label
        for found in WORD.finditer(text)
        if found.group().lower() in strong
    ]
    # And the same words with a character put in.
    pieces += [
        word[:k] + extra + word[k:]
        for word in sorted(strong)
        for k in range(1, len(word))
        for extra in INSERTED
    ]
    first, ends = letters(*_packed(pieces))
    positive = kernel.features_of(first, ends, ends[:-1])
    chance = np.random.default_rng(7)
    learnt = [(offsets[:-1] + (chance.random(len(sizes)) * sizes).astype(np.int64))[~toxic]]
    table = np.zeros(LETTERS**LENGTH, dtype=np.float32)
    for _ in range(ROUNDS):
        if not len(positive):
            break
        negative = kernel.features_of(codes, offsets, np.unique(np.concatenate(learnt)))
        x = np.concatenate([positive, negative])
        y = np.concatenate([np.ones(len(positive)), -np.ones(len(negative))])
        del positive, negative  # they are in x
        table = kernel.weights(support_vectors(x, y)[:-1])
        del x, y
        best, at, windows = all_windows(codes, offsets, table)
        # Clean texts: the highest window of each round, and one by chance.
        learnt.append(at[~toxic])
        learnt.append((offsets[:-1] + (chance.random(len(sizes)) * sizes).astype(np.int64))[~toxic])
        # Toxic texts: the windows that stand out from clean texts, beside the first.
        bar = np.quantile(best[~toxic], STANDS_OUT) if (~toxic).any() else np.inf
        found = standing_out(np.where(np.repeat(toxic, sizes), windows, -np.inf), bar)
        del windows
        positive = np.concatenate(
            [kernel.features_of(first, ends, ends[:-1]), kernel.features_of(codes, offsets, found)]
        )
    return table


def known_labels(labels: DataFrame, usable: Column) -> DataFrame:
    """_labelled and _toxic of each usable id. One whose labels disagree is left out."""
    return (
        labels.filter(usable & F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
        .groupBy(F.col("doc_id").alias("_labelled"))
        .agg(F.min("toxic").alias("_toxic"), F.max("toxic").alias("_most"))
        .filter("_toxic = _most")
        .drop("_most")
    )


def labelled_texts(docs: DataFrame, labels: DataFrame, usable: Column, limit: int) -> DataFrame:
    """text and toxic of up to ``limit`` usable labelled rows of each class, by
    a hash of the id."""
    known = known_labels(labels, usable)
    parts = [
        known.filter(test).orderBy(F.xxhash64("_labelled"), "_labelled").limit(limit)
        for test in (F.col("_toxic") == 1, F.col("_toxic") != 1)
    ]
    chosen = F.broadcast(parts[0].unionByName(parts[1]))  # 2 * limit rows at most
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found = texts.join(chosen, texts["doc_id"] == chosen["_labelled"]).groupBy("doc_id", "_toxic")
    # One text for each labelled id, however many rows carry the id.
    return found.agg(F.min("text").alias("text")).select("doc_id", "text", (F.col("_toxic") == 1).alias("toxic"))


MACHINE = "weights binary, scores binary, chances binary"


def _train_rows(stands_for: tuple[float, float], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, text, toxic of the whole sample -> one row of MACHINE."""
    rows = [row for batch in batches for row in zip(*(column.to_pylist() for column in batch.columns))]
    rows.sort()
    made = train([text for _, text, _ in rows], [toxic for _, _, toxic in rows], stands_for)
    parts = [made.weights.astype("<f4"), made.scores.astype("<f8"), made.chances.astype("<f8")]
    names = [field.split()[0] for field in MACHINE.split(", ")]
    del rows
    yield pa.RecordBatch.from_arrays([pa.array([part.tobytes()], pa.binary()) for part in parts], names)
    give_back()


def learn(docs: DataFrame, labels: DataFrame, usable: Column, limit: int = TRAINING_TEXTS) -> Machine:
    """Train on a bounded sample of the labelled rows that are ``usable`` (a
    test on the labels' columns). The sample has up to ``limit`` rows of each
    class; probabilities are by the classes' shares of all usable labels. A task
    trains: the driver gets the machine, of one size whatever the data, and no text."""
    told = known_labels(labels, usable).groupBy(F.col("_toxic") == 1).count().collect()  # two rows at most
    stands_for = {bool(is_toxic): max(1.0, n / limit) for is_toxic, n in told}
    shares = (stands_for.get(False, 1.0), stands_for.get(True, 1.0))
    sample = labelled_texts(docs, labels, usable, limit).repartition(1)  # 2 * limit texts at most
    found = sample.mapInArrow(partial(_train_rows, shares), MACHINE).collect()
    if not found:  # Spark may run no task for no rows
        return train([], [], shares)
    (row,) = found
    return Machine(*(np.frombuffer(bytes(data), kind) for data, kind in zip(row, ("<f4", "<f8", "<f8"))))


def score_texts(
    docs: DataFrame,
    machine: Machine,
    columns: Sequence[str] = ("doc_id",),
    score: str = "score",
) -> DataFrame:
    """``columns`` of all rows and the probability that the whole text is toxic."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)
    columns = list(columns)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in text_chunks(batch, "_scored", SCORED_BYTES):
                found = shared.value.probability(*texts_of(piece.column("_scored")))
                arrays = [piece.column(i) for i in range(len(columns))]
                yield pa.RecordBatch.from_arrays([*arrays, pa.array(found)], [*columns, score])
            pa.default_memory_pool().release_unused()
        give_back()

    given = docs.select(*columns, F.col("text").alias("_scored"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*columns).schema)
    return given.mapInArrow(work, f"{fields}, `{score}` double")
