"""Documents as blocks of codes over a block's own distinct words.

A per-word lookup over a corpus (word -> ids, word -> count) would shuffle every
word of every text twice. Here each task codes its documents in blocks of
bounded text: a block keeps its distinct words once and its documents as
sequences of word numbers. Only a block's distinct words are shuffled, by word,
so that each distinct word of the corpus meets all its blocks in one place; the
answers go back by block and stand at the word's number. A word has one row for
each block, however often it occurs, so there are no hot words.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import CHUNK_BYTES, give_back, staged, texts_of

# Text that a block holds (or one longer document).
BLOCK_BYTES = 24 << 20
# Units in a row of codes, words in a row of words.
UNITS_PER_ROW = 1 << 18
WORDS_PER_ROW = 1 << 10

BLOCKS = (
    "block long, kind int, part int, doc_ids array<bigint>, flags array<boolean>, sizes array<int>, codes binary, "
    "start int, words array<string>, counts array<bigint>"
)
_SCHEMA = pa.schema(
    [
        ("block", pa.int64()),
        ("kind", pa.int32()),
        ("part", pa.int32()),
        ("doc_ids", pa.list_(pa.int64())),
        ("flags", pa.list_(pa.bool_())),
        ("sizes", pa.list_(pa.int32())),
        ("codes", pa.binary()),
        ("start", pa.int32()),
        ("words", pa.list_(pa.string())),
        ("counts", pa.list_(pa.int64())),
    ]
)

# Units of a column of texts, and where each text's units begin (n + 1 numbers).
Split = Callable[[pa.Array], tuple[pa.Array, np.ndarray]]


def pack(values: np.ndarray) -> bytes:
    """uint32 numbers, compressed with their bytes in planes."""
    planes = np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpack(data: bytes, n: int) -> np.ndarray:
    raw = pa.decompress(data, decompressed_size=4 * n, codec="zstd", asbytes=True)
    planes = np.frombuffer(raw, dtype=np.uint8).reshape(4, n)
    return np.ascontiguousarray(planes.T).view("<u4").reshape(n)


def pack_rising(values: np.ndarray) -> bytes:
    """Rising numbers by their steps, and how many there are."""
    return len(values).to_bytes(4, "little") + pack(np.diff(values, prepend=0))


def unpack_rising(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data[4:], int.from_bytes(data[:4], "little")), dtype=np.int64)


def squeeze(data: bytes) -> bytes:
    return len(data).to_bytes(4, "little") + pa.compress(data, codec="zstd", asbytes=True)


def unsqueeze(data: bytes) -> bytes:
    return pa.decompress(data[4:], decompressed_size=int.from_bytes(data[:4], "little"), codec="zstd", asbytes=True)


def number_words(units: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The word number of each unit, and the words in order of their numbers."""
    coded = units.dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False)
    words = coded.dictionary
    # Frequent words get small numbers, which compress well.
    order = np.argsort(-np.bincount(codes, minlength=len(words)), kind="stable")
    number = np.empty(len(order), dtype=np.int64)
    number[order] = np.arange(len(order))
    return number[codes], words.take(pa.array(order))


def _rows(block: int, kind: int, ids: list, flags: np.ndarray, sizes: np.ndarray, units: pa.Array):
    """The rows of one block, its words among them."""
    codes, words = number_words(units)
    row = dict.fromkeys(_SCHEMA.names) | {"block": block, "kind": kind}
    yield from _text_rows(row, ids, flags, sizes, codes)
    counted = np.bincount(codes[np.repeat(flags, sizes)], minlength=len(words))
    for at in range(0, len(words), WORDS_PER_ROW):
        yield row | {
            "start": at,
            "words": words.slice(at, WORDS_PER_ROW).to_pylist(),
            "counts": counted[at : at + WORDS_PER_ROW].tolist(),
        }


def _text_rows(row: dict, ids: list, flags: np.ndarray, sizes: np.ndarray, codes: np.ndarray):
    """The documents of one block."""
    ends = np.concatenate([[0], np.cumsum(sizes)])
    start = part = 0
    while start < len(ids):
        end = int(np.searchsorted(ends, ends[start] + UNITS_PER_ROW, side="right")) - 1
        end = min(max(end, start + 1), len(ids))
        yield row | {
            "part": part,
            "doc_ids": ids[start:end],
            "flags": flags[start:end].tolist(),
            "sizes": sizes[start:end].tolist(),
            "codes": pack(codes[ends[start] : ends[end]]),
        }
        start, part = end, part + 1


def name_of(ids: list, words: pa.Array) -> int:
    """A name for a block by its documents' ids and its words, so that a reading of other rows finds nothing."""
    seed = xxhash.xxh3_64_intdigest(repr(ids))
    sizes = pc.binary_length(words).to_numpy(zero_copy_only=False).astype("<u4")
    raw, _ = texts_of(words)
    return xxhash.xxh3_64_intdigest(sizes.tobytes() + raw.tobytes(), seed=seed) - (1 << 63)


def named_texts(block: int, kind: int, ids: list, flags: np.ndarray, sizes: np.ndarray, units: pa.Array):
    """The documents of one block, for answers that another reading of them brings."""
    codes, words = number_words(units)
    row = dict.fromkeys(_SCHEMA.names) | {"block": name_of(ids, words), "kind": kind}
    for made in _text_rows(row, ids, flags, sizes, codes):
        yield pa.RecordBatch.from_pylist([made], _SCHEMA)


def _batches(*block):
    for row in _rows(*block):
        yield pa.RecordBatch.from_pylist([row], _SCHEMA)


def build(split: Split, block_bytes: int, finish: Callable[..., Iterator[pa.RecordBatch]] = _batches):
    """Cut the texts of a task into blocks; ``finish`` makes the rows of one."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        made, held, size = 0, {}, 0

        def flush():
            nonlocal made, held, size
            for kind, pieces in sorted(held.items()):
                ids = [x for p in pieces for x in p[0]]
                flags, sizes = (np.concatenate([p[i] for p in pieces]) for i in (1, 2))
                units = pa.concat_arrays([p[3] for p in pieces])
                yield from finish((task << 32) | made, kind, ids, flags, sizes, units)
                made += 1
            held, size = {}, 0
            pa.default_memory_pool().release_unused()

        for batch in batches:
            _, offsets = texts_of(batch.column("text"))
            start = 0
            while start < batch.num_rows:
                # Split a piece at a time: that takes several times its size.
                room = min(block_bytes - size, CHUNK_BYTES)
                end = int(np.searchsorted(offsets, offsets[start] + room, side="right")) - 1
                end = min(max(end, start + 1), batch.num_rows)
                piece = batch.slice(start, end - start)
                kinds = piece.column("kind").to_numpy(zero_copy_only=False)
                for kind in np.unique(kinds):
                    some = piece.filter(pa.array(kinds == kind))
                    units, at = split(some.column("text").fill_null(""))
                    flags = some.column("flag").to_numpy(zero_copy_only=False)
                    row = (some.column("doc_id").to_pylist(), flags, np.diff(at), units)
                    held.setdefault(int(kind), []).append(row)
                size += int(offsets[end] - offsets[start])
                start = end
                if size >= block_bytes:
                    yield from flush()
        yield from flush()
        give_back()

    return work


def flagged(docs: DataFrame) -> DataFrame:
    """What ``build`` reads: doc_id, text, flag (false unless given), kind (0 unless given)."""
    return docs.select(
        "doc_id",
        "text",
        F.coalesce(F.col("flag"), F.lit(False)).alias("flag") if "flag" in docs.columns else F.lit(False).alias("flag"),
        F.coalesce(F.col("kind"), F.lit(0)).cast("int").alias("kind") if "kind" in docs.columns else F.lit(0).alias("kind"),
    )


def build_blocks(
    docs: DataFrame, split: Split, label: str, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Blocks of ``docs`` (doc_id, text, and where given flag and kind), written
    out. A block holds documents of one kind; ``counts`` are occurrences in
    documents whose flag is true."""
    return staged(flagged(docs).mapInArrow(build(split, block_bytes), BLOCKS), label)


def block_words(blocks: DataFrame) -> DataFrame:
    """One row for each word of each block: block, kind, code, word, n."""
    return blocks.filter(F.col("words").isNotNull()).select(
        "block", "kind", "start", F.posexplode(F.arrays_zip("words", "counts")).alias("at", "w")
    ).select(
        "block",
        "kind",
        (F.col("start") + F.col("at")).alias("code"),
        F.col("w.words").alias("word"),
        F.col("w.counts").alias("n"),
    )


ANSWERS = "block long, codes binary, answers binary"


def pack_answers(block: np.ndarray, code: np.ndarray, pick: Callable[[np.ndarray], bytes]) -> pa.RecordBatch:
    """Rows of ANSWERS for words of several blocks; ``pick`` gives the answer
    bytes for some of the words."""
    order = np.argsort(block, kind="stable")
    cuts = np.flatnonzero(np.diff(block[order])) + 1
    groups = np.split(order, cuts) if len(order) else []
    return pa.RecordBatch.from_arrays(
        [
            pa.array([int(block[g[0]]) for g in groups], pa.int64()),
            pa.array([code[g].astype("<u4").tobytes() for g in groups], pa.binary()),
            pa.array([pick(g) for g in groups], pa.binary()),
        ],
        ["block", "codes", "answers"],
    )


def with_answers(
    blocks: DataFrame,
    answers: DataFrame,
    place: Callable[[np.ndarray, list[tuple[int, bytes]]], Any],
    finish: Callable[[Any, dict, np.ndarray], pa.RecordBatch],
    schema: str,
    codes_of: Callable[[bytes], np.ndarray] = partial(np.frombuffer, dtype="<u4"),
) -> DataFrame:
    """Bring answers back to their blocks; ``codes_of`` reads their word numbers.

    ``place(codes, answers)`` makes a block's table from its word numbers and
    the answers to them, as (how many, bytes). ``finish(table, row, units)``
    turns a row of documents, its units given as word numbers, into results.
    """
    nothing = F.lit(None)
    told = answers.select(
        "block",
        F.lit(-1).alias("part"),
        "codes",
        "answers",
        nothing.cast("array<bigint>").alias("doc_ids"),
        nothing.cast("array<boolean>").alias("flags"),
        nothing.cast("array<int>").alias("sizes"),
    )
    texts = blocks.filter(F.col("codes").isNotNull()).select(
        "block", "part", "codes", nothing.cast("binary").alias("answers"), "doc_ids", "flags", "sizes"
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, codes, found, table = None, [], [], None
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if row["block"] != block:
                    block, codes, found, table = row["block"], [], [], None
                if row["part"] < 0:
                    codes.append(codes_of(row["codes"]).astype(np.int64))
                    found.append((len(codes[-1]), row["answers"]))
                    continue
                if table is None:
                    table = place(np.concatenate(codes) if codes else np.zeros(0, np.int64), found)
                yield finish(table, row, unpack(row["codes"], sum(row["sizes"])))

    both = told.unionByName(texts).repartition("block").sortWithinPartitions("block", "part")
    return both.mapInArrow(work, schema)
