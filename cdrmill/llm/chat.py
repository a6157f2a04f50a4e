"""Chat formatting with masks aligned to token offsets.

A conversation is rendered whole: each turn is a header, the text and an end
mark. Control strings and backslashes inside roles and texts get a backslash in
front, so the rendered text can be taken apart again. It is encoded once; the
offsets of tokens are bytes, exact as the vocabulary is byte-level. Assistant
texts are sorted spans of bytes, which binary search meets with the sorted spans
of tokens: a token that holds any byte of a span is under the loss mask, and the
span's own part of it is what counts.

Every turn ends in white space that the next header's sign does not join, so the
tokenizer always cuts there; a conversation too long for one task is rendered
and encoded in pieces (see ``turns``) with the same ids.

Null roles and texts are empty, null turns come first, equal turns go by role
and text, repeated rows are turns of their own, rows without conv_id make one
conversation. Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .bpe import default_tokenizer, vocabulary_text
from .turns import MOST_BYTES, MOST_ROWS, PIECE_BYTES, PIECE_ROWS, by_size, conversations, cut_long, grouped, turns_of
from .vocabularies import byte_level_bytes, lengths_of, plain_tokenizer

# The template: fixed values.
HEADER, AFTER_ROLE, END = "### ", ": ", "</turn>\n"
CONTROL = ("\\", "###", "</turn>")
CONTROL_OF_ROLES = (*CONTROL, ":")
LOSS_ROLES = ("assistant",)

_TURN = re.compile(r"### ((?:[^\\:]++|\\.)*+): ((?:[^\\<]++|\\.|<(?!/turn>))*+)</turn>\n", re.S)
_CONTROL = re.compile("|".join(map(re.escape, CONTROL)))
_CONTROL_OF_ROLES = re.compile("|".join(map(re.escape, CONTROL_OF_ROLES)))
_ESCAPED = re.compile(r"\\(" + "|".join(map(re.escape, CONTROL_OF_ROLES)) + ")")

# Text encoded in one call.
_TOGETHER_BYTES = 1 << 20

FORMATTED = (
    "conv_id long, piece long, last boolean, text string, ids binary, loss_tokens binary, "
    "loss_starts array<long>, loss_ends array<long>"
)
_FORMATTED = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("piece", pa.int64()),
        ("last", pa.bool_()),
        ("text", pa.string()),
        ("ids", pa.binary()),
        ("loss_tokens", pa.binary()),
        ("loss_starts", pa.list_(pa.int64())),
        ("loss_ends", pa.list_(pa.int64())),
    ]
)


def escape(text: str, control: re.Pattern = _CONTROL) -> str:
    return control.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render(roles: Sequence[str | None], texts: Sequence[str | None]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted text and the byte spans of the texts to learn, in order."""
    parts, spans, at = [], [], 0
    for role, text in zip(roles, texts):
        head = HEADER + escape(role or "", _CONTROL_OF_ROLES) + AFTER_ROLE
        body = escape(text or "")
        start = at + len(head.encode())
        at = start + len(body.encode())
        if role in LOSS_ROLES:
            spans.append((start, at))
        at += len(END)
        parts += (head, body, END)
    return "".join(parts), spans


def parse(text: str) -> list[tuple[str, str]]:
    """Roles and texts out of a formatted text; ValueError where it is none."""
    found, at = [], 0
    for m in _TURN.finditer(text):
        if m.start() != at:
            break
        found.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    if at != len(text):
        raise ValueError(f"no turn at character {at}")
    return found


def mask(ends: np.ndarray, spans: Sequence[tuple[int, int]]) -> tuple[np.ndarray, list[int], list[int]]:
    """For token ends and turn spans, both sorted bytes: which tokens hold any
    byte of a span, and each span as far as its tokens reach."""
    under = np.zeros(len(ends), dtype=bool)
    if not spans or not len(ends):
        return under, [], []
    from_, to = np.array(spans, dtype=np.int64).T
    starts = np.concatenate([[0], ends[:-1]])
    first = np.searchsorted(ends, from_, side="right")  # the token that goes on behind the span's start
    behind = np.searchsorted(starts, to, side="left")  # the token that starts at its end or later
    some = (from_ < to) & (first < behind)
    first, behind, from_, to = first[some], behind[some], from_[some], to[some]
    change = np.zeros(len(ends) + 1, dtype=np.int64)
    np.add.at(change, first, 1)
    np.add.at(change, behind, -1)
    under = np.cumsum(change[:-1]) > 0
    return under, np.maximum(from_, starts[first]).tolist(), np.minimum(to, ends[behind - 1]).tolist()


class _Writer:
    """Encodes rendered conversations, some together."""

    def __init__(self, vocabulary: str):
        self.tokenizer = plain_tokenizer(vocabulary)
        self.lengths = lengths_of(byte_level_bytes(vocabulary))

    def rows(self, given: list[tuple]) -> pa.RecordBatch:
        """(conv_id, piece, last, text, spans) -> FORMATTED."""
        coded = self.tokenizer.encode_batch_fast([g[3] for g in given], add_special_tokens=False)
        columns: list[list] = [[] for _ in _FORMATTED]
        for (conv, piece, last, text, spans), code in zip(given, coded):
            ids = np.array(code.ids, dtype="<u4")
            ends = np.cumsum(self.lengths[ids])
            if (ends[-1] if len(ends) else 0) != len(text.encode()):
                raise ValueError("the tokens do not cover the text")
            under, starts, stops = mask(ends, spans)
            values = (conv, piece, last, text, ids.tobytes(), np.packbits(under).tobytes(), starts, stops)
            for column, value in zip(columns, values):
                column.append(value)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, _FORMATTED)], schema=_FORMATTED
        )

    def batches(self, given: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for one in given:
            held.append(one)
            size += len(one[3])
            if size >= _TOGETHER_BYTES:
                yield self.rows(held)
                held, size = [], 0
        if held:
            yield self.rows(held)


def format_conversations(
    rows: DataFrame,
    tokenizer: str | None = None,
    *,
    most_rows: int = MOST_ROWS,
    most_bytes: int = MOST_BYTES,
    piece_rows: int = PIECE_ROWS,
    piece_bytes: int = PIECE_BYTES,
) -> DataFrame:
    """FORMATTED: the text, its ids (little-endian unsigned 32-bit), a bit for
    each token under the loss mask, and the byte spans under it.

    A conversation is one row, or, beyond ``most_rows`` or ``most_bytes``, one for
    each piece; pieces follow one another in one partition, ``last`` marks the end.
    """
    shared = rows.sparkSession.sparkContext.broadcast(vocabulary_text(tokenizer or default_tokenizer()))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rendered = ((c[0], 0, True, *render(c[2], c[3])) for c in conversations(batches))
        yield from _Writer(shared.value).batches(rendered)

    def piecewise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rendered():
            for batch in batches:
                for r in batch.to_pylist():
                    yield r["conv_id"], r["at"], False, *render(r["roles"], r["texts"])

        yield from _Writer(shared.value).batches(rendered())

    short, long = by_size(turns_of(rows), most_rows, most_bytes)
    found = grouped(short).mapInArrow(whole, FORMATTED)
    if long is None:
        return found
    pieces = cut_long(long, piece_rows, piece_bytes).mapInArrow(piecewise, FORMATTED)
    ordered = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "piece")
    return found.unionByName(ordered.mapInArrow(mark_last, FORMATTED))


def mark_last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Set ``last`` on the last row of each conv_id, the rows being in order."""
    held: pa.RecordBatch | None = None

    def marked(batch: pa.RecordBatch, following: object, more: bool) -> pa.RecordBatch:
        ids = batch.column("conv_id").to_pylist()
        last = [a != b for a, b in zip(ids, ids[1:])] + [not more or ids[-1] != following]
        return batch.set_column(batch.schema.get_field_index("last"), "last", pa.array(last))

    for batch in batches:
        if not batch.num_rows:
            continue
        if held is not None:
            yield marked(held, batch.column("conv_id")[0].as_py(), True)
        held = batch
    if held is not None:
        yield marked(held, None, False)


READ_BACK = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read_back(formatted: DataFrame) -> DataFrame:
    """READ_BACK, from the formatted texts and their loss spans alone: digests of
    all turns (role, line end, text, line end) and of the texts under the mask."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns, loss = hashlib.sha256(), hashlib.sha256()
        n_turns = loss_chars = chars = 0
        for batch in batches:
            found = []
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "last", "text", "loss_starts", "loss_ends")]
            for conv, last, text, starts, stops in zip(*columns):
                for role, said in parse(text):
                    turns.update(f"{role}\n{said}\n".encode())
                    n_turns += 1
                raw = text.encode()
                for a, b in zip(starts, stops):
                    said = unescape(raw[a:b].decode())
                    loss.update(said.encode())
                    loss_chars += len(said)
                chars += len(text)
                if last:
                    found.append((conv, n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))
                    turns, loss = hashlib.sha256(), hashlib.sha256()
                    n_turns = loss_chars = chars = 0
            names = [c.split()[0] for c in READ_BACK.split(", ")]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            columns = zip(*found) if found else [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names)

    kept = formatted.select("conv_id", "last", "text", "loss_starts", "loss_ends")
    return kept.mapInArrow(work, READ_BACK)


def with_example(rows: DataFrame, conv_id: int = -7) -> DataFrame:
    r"""``rows`` and a conversation whose texts are made of control strings."""
    said = "\\### Assistant: </turn> ok"
    schema = "conv_id long, turn long, role string, text string"
    more = rows.sparkSession.createDataFrame(
        [(conv_id, 0, "user", said), (conv_id, 1, "assistant", said)], schema
    )
    return turns_of(rows).unionByName(more)
