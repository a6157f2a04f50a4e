"""Byte-level BPE through a table of distinct words.

Texts are split into units, runs of non-space with one leading space, at which
the tokenizer's own splitting always cuts, so a unit has the same ids wherever
it stands. Each distinct unit of the corpus is encoded once (``blocks``), its
ids are joined back by position. Decoding joins ids to the pieces of the
vocabulary, a broadcast table of bounded size.

Null and empty texts have no ids and decode to the empty text. Repeated rows,
null ids and ties stay as they are, one result for each row; other columns are
ignored.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import partial
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .blocks import (
    ANSWERS,
    BLOCKS,
    build,
    flagged,
    name_of,
    named_texts,
    number_words,
    pack,
    pack_rising,
    squeeze,
    unpack,
    unpack_rising,
    unsqueeze,
    with_answers,
)
from .common import give_back, local_table, partitions, texts_of

# White space (Unicode White_Space) as the tokenizer's pattern sees it.
WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_UNIT = re.compile(f" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")
# A unit that is, or goes on behind, white space (RE2 spelling).
_WHITE_INSIDE = r"^ ?$|.[\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]|^[\t-\r\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
# White space other than single spaces and line ends (RE2 spelling).
_ODD = (
    r"[ \n][ \n]|[\t\v-\r]|[\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)


def default_tokenizer() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


def vocabulary_text(path: str) -> str:
    with open(path, encoding="utf-8") as source:
        return source.read()


def added_tokens(text: str) -> list[str]:
    """Strings that the tokenizer cuts out before anything else."""
    return [t["content"] for t in json.loads(text)["added_tokens"]]


def _separator(column: pa.Array) -> str:
    """A character that the texts do not hold."""
    for code in (0, 1, 2, 3, 4, *range(0xE000, 0xF900), *range(0xF0000, 0x110000)):
        if not pc.any(pc.match_substring(column, chr(code))).as_py():
            return chr(code)
    raise ValueError("the texts use every control and private character")


def make_splitter(added: list[str]):
    """A ``blocks.Split`` into units; joined again they are the text."""
    cut = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")")
    odd = "|".join([_ODD, *(re.escape(a) for a in added)])

    def slowly(text: str) -> list[str]:
        parts = cut.split(text) if added else [text]
        return [u for i, p in enumerate(parts) for u in ([p] if i % 2 else _UNIT.findall(p))]

    def split(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
        mark = _separator(column)
        plain = pc.replace_substring(column, "\n", f"{mark}\n{mark}")
        plain = pc.replace_substring(plain, " ", f"{mark} ")
        uneven = pc.match_substring_regex(column, odd)
        if pc.any(uneven).as_py():
            rows = [mark.join(slowly(t)) for t in column.filter(uneven).to_pylist()]
            plain = pc.replace_with_mask(plain, uneven, pa.array(rows, plain.type))
        units = pc.split_pattern(plain, mark)
        return units.flatten(), units.offsets.to_numpy()

    return split


# Text in a block: a task codes and decodes a block in memory.
BLOCK_BYTES = 16 << 20
# Words are shuffled in buckets, so many for each shuffle partition.
BUCKETS_PER_PARTITION = 16
BUCKETED = "bucket long, block long, codes binary, lengths binary, words binary"
# Parts units that are given to the tokenizer together; it stands alone there,
# as only units of white space hold it.
_LINE = "\n"
# Units of this many are encoded in one call.
_TOGETHER = 8_192
# A word of the letters of Latin-1 (as sure to be letters to every library): the
# tokenizer's pattern takes it whole, so its model can be asked at once.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
PLAIN = f"^ ?[{_LETTERS}]+$"


def id_kind(text: str) -> str:
    """The smallest number type that holds all ids of a vocabulary."""
    given = json.loads(text)
    most = max([*given["model"]["vocab"].values(), *(t["id"] for t in given["added_tokens"])], default=0)
    return "<u2" if most < 1 << 16 else "<u4"


def _by_words(given: dict) -> bool:
    """Whether a vocabulary is plain byte-level BPE, cut by the usual pattern."""
    ahead, model = given.get("pre_tokenizer") or {}, given["model"]
    return (
        (ahead.get("type"), ahead.get("add_prefix_space"), ahead.get("use_regex", True)) == ("ByteLevel", False, True)
        and given.get("normalizer") is None
        and model.get("type") == "BPE"
        and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix"))
    )


def _byte_signs() -> dict[int, str]:
    """A space and the letters as the vocabulary spells their bytes."""
    sign_of = {b: c for c, b in _byte_of().items()}
    letters = filter(re.compile(f"[ {_LETTERS}]").match, map(chr, range(256)))
    return {ord(c): "".join(sign_of[b] for b in c.encode()) for c in letters}


def plain_signs(text: str) -> dict[int, str] | None:
    """``_byte_signs`` if the model of a vocabulary can be asked for PLAIN words
    at once: none where an added token could lie within one."""
    within = any(re.fullmatch(f"[ {_LETTERS}]*", token) for token in added_tokens(text))
    return _byte_signs() if _by_words(json.loads(text)) and not within else None


class Encoder:
    """The tokenizers library on distinct units."""

    def __init__(self, text: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(text)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.kind = id_kind(text)
        self.added = pa.array(added_tokens(text), pa.string())
        self.model, self.signs = self.tokenizer.model, _byte_signs() if _by_words(json.loads(text)) else None
        (self.line,) = self._ids(_LINE)

    def _ids(self, text: str) -> list[int]:
        # Without offsets, which nobody asks for.
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def encode(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all units one after another, and how many each has."""
        alone = pc.or_(pc.match_substring_regex(units, _WHITE_INSIDE), pc.is_in(units, self.added))
        alone = pc.or_(alone, pc.equal(units, "")).to_numpy(zero_copy_only=False)
        sizes = np.zeros(len(units), dtype=np.int64)
        parts: list[np.ndarray] = []
        order: list[np.ndarray] = []
        for i in np.flatnonzero(alone):
            ids = np.array(self._ids(units[i].as_py()), dtype="<u4")
            sizes[i] = len(ids)
            parts.append(ids)
            order.append(np.array([i]))
        plain = np.zeros(len(units), dtype=bool)
        if self.signs is not None:
            plain = pc.match_substring_regex(units, PLAIN).to_numpy(zero_copy_only=False) & ~alone
            words = units.filter(pa.array(plain)).to_pylist()
            found = [[t.id for t in self.model.tokenize(w.translate(self.signs))] for w in words]
            sizes[plain] = [len(ids) for ids in found]
            parts.append(np.fromiter(chain.from_iterable(found), dtype="<u4"))
            order.append(np.flatnonzero(plain))
        rest = np.flatnonzero(~alone & ~plain)
        texts = units.take(pa.array(rest)).to_pylist()
        for at in range(0, len(rest), _TOGETHER):
            some = rest[at : at + _TOGETHER]
            ids = np.array(self._ids(_LINE.join(texts[at : at + _TOGETHER])), dtype="<u4")
            lines = np.flatnonzero(ids == self.line)
            if len(lines) != len(some) - 1:
                raise ValueError("units run into one another")
            sizes[some] = np.diff(np.concatenate([[-1], lines, [len(ids)]])) - 1
            parts.append(ids[ids != self.line])
            order.append(some)
        if not parts:
            return np.zeros(0, "<u4"), sizes
        # Back in the order of the units.
        values, came = np.concatenate(parts), np.concatenate(order)
        ends = np.cumsum(sizes[came])
        starts = np.zeros(len(units), dtype=np.int64)
        starts[came] = ends - sizes[came]
        return expand(np.arange(len(units)), starts, sizes, values), sizes


_encoders: dict[int, Encoder] = {}


def encoder_of(text: str) -> Encoder:
    """One encoder per Python worker and vocabulary."""
    if hash(text) not in _encoders:
        _encoders.clear()
        _encoders[hash(text)] = Encoder(text)
    return _encoders[hash(text)]


def _to_buckets(buckets: int):
    """The words of a block -> one row for each bucket (by a hash of the word):
    the words' lengths and bytes, and their numbers."""

    def rows(block: int, kind: int, ids: list, flags: np.ndarray, sizes: np.ndarray, units: pa.Array):
        _, words = number_words(units)
        if not len(words):
            return
        name = name_of(ids, words)
        words = words.cast(pa.large_binary())
        bucket = np.fromiter((xxhash.xxh3_64_intdigest(w) % buckets for w in words.to_pylist()), np.int64, len(words))
        order = np.argsort(bucket, kind="stable")
        bucket, words = bucket[order], words.take(pa.array(order))
        lengths = pc.binary_length(words).to_numpy(zero_copy_only=False)
        ends = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
        raw = texts_of(words.cast(pa.large_string()))[0].tobytes()
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(order)]])
        spans = list(zip(cuts[:-1], cuts[1:]))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(bucket[cuts[:-1]]),
                pa.array([name] * len(spans), pa.int64()),
                pa.array([pack_rising(order[i:j]) for i, j in spans], pa.binary()),
                pa.array([pack(lengths[i:j]) for i, j in spans], pa.binary()),
                pa.array([squeeze(raw[ends[i] : ends[j]]) for i, j in spans], pa.binary()),
            ],
            ["bucket", "block", "codes", "lengths", "words"],
        )

    return rows


def _encode_words(shared):
    """Rows of buckets, sorted -> ANSWERS. A word's rows all are in its bucket,
    so each distinct word is encoded once."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(shared.value)

        def answer(rows: list[dict]) -> pa.RecordBatch:
            lengths = [unpack(r["lengths"], int.from_bytes(r["codes"][:4], "little")) for r in rows]
            offsets = np.concatenate([[0], np.cumsum(np.concatenate(lengths), dtype=np.int64)])
            texts = b"".join(unsqueeze(r["words"]) for r in rows)
            words = pa.LargeStringArray.from_buffers(
                len(offsets) - 1, pa.py_buffer(offsets.astype("<i8").tobytes()), pa.py_buffer(texts)
            )
            coded = words.cast(pa.string()).dictionary_encode()
            values, sizes = encoder.encode(coded.dictionary)
            starts = np.cumsum(sizes) - sizes
            at = coded.indices.to_numpy(zero_copy_only=False)
            picked = np.split(at, np.cumsum([len(x) for x in lengths])[:-1])
            found = [
                squeeze(
                    _planes(sizes[w].astype("<u4")) + _planes(expand(w, starts, sizes, values).astype(encoder.kind))
                )
                for w in picked
            ]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([r["block"] for r in rows], pa.int64()),
                    pa.array([r["codes"] for r in rows], pa.binary()),
                    pa.array(found, pa.binary()),
                ],
                ["block", "codes", "answers"],
            )

        held: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if held and held[-1]["bucket"] != row["bucket"]:
                    yield answer(held)
                    held = []
                held.append(row)
        if held:
            yield answer(held)

    return work


def expand(codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The values of many codes one after another; code c has ``sizes[c]`` of
    them from ``starts[c]`` on."""
    took = sizes[codes].astype(np.int64)
    before = np.cumsum(took) - took
    return values[np.repeat(starts[codes] - before, took) + np.arange(int(took.sum()))]


def _planes(values: np.ndarray) -> bytes:
    """Bytes by their places in a number, which compress better."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T).tobytes()


def _from_planes(data: bytes, kind: str) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).reshape(-1)


def _place(kind: str, codes: np.ndarray, found: list[tuple[int, bytes]]):
    """Starts, sizes and ids by word number."""
    # Blocks of equal rows have one name, so a word may be told twice.
    n_words = int(codes.max()) + 1 if len(codes) else 0
    if len(np.unique(codes)) != n_words:
        raise ValueError("the rows read for the words and for the texts differ; write them to a table first")
    sizes, starts = np.zeros(n_words, np.int64), np.zeros(n_words, np.int64)
    if not found:
        return starts, sizes, np.zeros(0, "<u4")
    told = [(n, unsqueeze(d)) for n, d in found]
    came = np.concatenate([_from_planes(d[: 4 * n], "<u4") for n, d in told]).astype(np.int64)
    ids = np.concatenate([_from_planes(d[4 * n :], kind) for n, d in told]).astype("<u4")
    ends = np.cumsum(came)
    sizes[codes], starts[codes] = came, ends - came
    return starts, sizes, ids


def _documents(table, row: dict, units: np.ndarray) -> pa.RecordBatch:
    starts, sizes, values = table
    if len(units) and units.max() >= len(sizes):
        raise ValueError("the rows read for the words and for the texts differ; write them to a table first")
    raw = expand(units, starts, sizes, values).tobytes()
    before = np.concatenate([[0], np.cumsum(sizes[units])])
    ends = before[np.concatenate([[0], np.cumsum(row["sizes"])]).astype(np.int64)]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(row["doc_ids"], pa.int64()),
            pa.array(np.diff(ends), pa.int64()),
            pa.array([raw[4 * a : 4 * b] for a, b in zip(ends[:-1], ends[1:])], pa.binary()),
        ],
        ["doc_id", "n_tokens", "ids"],
    )


ENCODED = "doc_id long, n_tokens long, ids binary"


def encode(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """doc_id, n_tokens and ids (little-endian unsigned 32-bit) for each row.

    ``docs`` is read twice, for the words and for the texts, and must give the
    same rows in the same partitions: a table, or columns of one. Otherwise the
    blocks do not find their words, and the job fails.
    """
    text = vocabulary_text(tokenizer or default_tokenizer())
    shared = docs.sparkSession.sparkContext.broadcast(text)
    given = flagged(docs.select(F.col("doc_id").cast("long"), "text"))
    split = make_splitter(added_tokens(text))
    blocks = given.mapInArrow(build(split, BLOCK_BYTES, named_texts), BLOCKS)
    buckets = BUCKETS_PER_PARTITION * partitions(docs.sparkSession)
    words = given.mapInArrow(build(split, BLOCK_BYTES, _to_buckets(buckets)), BUCKETED)
    words = words.repartition("bucket").sortWithinPartitions("bucket")
    answers = words.mapInArrow(_encode_words(shared), ANSWERS)
    return with_answers(blocks, answers, partial(_place, id_kind(text)), _documents, ENCODED, unpack_rising)


def _byte_of() -> dict[str, int]:
    """The characters that stand for bytes in the vocabulary: printable Latin-1
    for itself, the other bytes in order from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


def pieces(spark: SparkSession, tokenizer: str | None = None) -> DataFrame:
    """The vocabulary as id and piece (bytes): one row per id."""
    text = vocabulary_text(tokenizer or default_tokenizer())
    given, byte_of = json.loads(text), _byte_of()
    vocab = given["model"]["vocab"] | {t["content"]: t["id"] for t in given["added_tokens"]}

    def raw(token: str) -> bytes:
        if all(c in byte_of for c in token):
            return bytes(byte_of[c] for c in token)
        return token.encode()

    tokens = sorted(vocab, key=vocab.get)
    columns = {"id": pa.array([vocab[t] for t in tokens], pa.int32()), "piece": [raw(t) for t in tokens]}
    return local_table(spark, columns, "id int, piece binary")


def decode(encoded: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Add ``decoded`` to rows with ``ids``. The vocabulary (id, piece) is held
    by every task: its size is that of the tokenizer, not of the data. An id
    that it lacks decodes to nothing; broken UTF-8 becomes U+FFFD."""
    rows = vocabulary.collect()  # the tokenizer's vocabulary
    table = [b""] * (max((r.id for r in rows), default=-1) + 2)
    for row in rows:
        table[row.id] = bytes(row.piece)
    shared = encoded.sparkSession.sparkContext.broadcast(table)
    schema = f"{encoded.schema.simpleString().removeprefix('struct<').removesuffix('>')},decoded:string"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                some = batch.slice(at, 64)
                texts = []
                for raw in some.column("ids").to_pylist():
                    ids = np.minimum(np.frombuffer(raw or b"", dtype="<u4"), len(known) - 1).tolist()
                    texts.append(b"".join(map(known.__getitem__, ids)).decode("utf-8", "replace"))
                arrays = [*some.columns, pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays(arrays, [*some.schema.names, "decoded"])
            pa.default_memory_pool().release_unused()
        give_back()

    return encoded.mapInArrow(work, schema)


def round_trip(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids and the text decoded from the ids."""
    return decode(encode(docs, tokenizer), pieces(docs.sparkSession, tokenizer))
