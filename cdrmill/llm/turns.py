"""Conversations in order, for operators that work on whole ones.

Rows hold conv_id, turn, role and text. A conversation's rows are taken by turn,
nulls first, equal turns by role and text. ``by_size`` parts the conversations
that a task may hold from the long ones. The former are brought together by
conv_id (``grouped``, ``conversations``); the latter are range partitioned by
conversation and turn and cut into pieces of bounded size (``cut_long``), so
that a conversation with a third of all rows is many pieces in many tasks. Rows
without conv_id make one conversation.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged

# Rows and bytes of a conversation that one task holds at a time.
MOST_ROWS = 50_000
MOST_BYTES = 16 << 20
# Rows and bytes (or one longer text) of a piece of a longer one.
PIECE_ROWS = 4_096
PIECE_BYTES = 4 << 20

COLUMNS = ("conv_id", "turn", "role", "text")
PIECES = "conv_id long, at long, turns array<long>, roles array<string>, texts array<string>"
_PIECES = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("at", pa.int64()),
        ("turns", pa.list_(pa.int64())),
        ("roles", pa.list_(pa.string())),
        ("texts", pa.list_(pa.string())),
    ]
)
# Partitions in the upper bits of a piece's place, its number in the lower.
_PLACE_BITS = 33
# Characters of a text that tell rows of one turn and role apart for ranges.
_TEXT_START = 64

Conversation = tuple[int | None, list[int | None], list[str | None], list[str | None]]


def turns_of(rows: DataFrame) -> DataFrame:
    """The four columns, and no others, in their types."""
    kinds = {"conv_id": "long", "turn": "long", "role": "string", "text": "string"}
    return rows.select(*[F.col(c).cast(kind).alias(c) for c, kind in kinds.items()])


def by_size(
    rows: DataFrame, most_rows: int = MOST_ROWS, most_bytes: int = MOST_BYTES
) -> tuple[DataFrame, DataFrame | None]:
    """The rows of conversations within the bounds, and of those beyond (None
    where there are none). Counts rows and bytes by conversation."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    sizes = rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("_rows"), F.sum(size).alias("_bytes"))
    beyond = sizes.filter((F.col("_rows") > most_rows) | (F.col("_bytes") > most_bytes))
    if beyond.isEmpty():
        return rows, None
    beyond = staged(beyond.select(F.col("conv_id").alias("_long")), "long_conversations")
    same = F.col("conv_id").eqNullSafe(F.col("_long"))
    return rows.join(beyond, same, "left_anti"), rows.join(beyond, same, "left_semi")


def grouped(rows: DataFrame) -> DataFrame:
    """Each conversation in one partition, its rows in order."""
    return rows.repartition("conv_id").sortWithinPartitions(*COLUMNS)


def conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[Conversation]:
    """The conversations of a partition of ``grouped``, one at a time."""
    held: Conversation | None = None
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in COLUMNS]
        for conv, turn, role, text in zip(*columns):
            if held is None or held[0] != conv:
                if held is not None:
                    yield held
                held = (conv, [], [], [])
            held[1].append(turn)
            held[2].append(role)
            held[3].append(text)
    if held is not None:
        yield held


def cut_long(rows: DataFrame, piece_rows: int = PIECE_ROWS, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """PIECES of long conversations; ``at`` rises along each one and is unique.
    Written out, so that a repeated task cannot cut them anew."""
    ordered = rows.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, _TEXT_START))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << _PLACE_BITS

        def piece() -> pa.RecordBatch:
            arrays = [[held[0]], [at], *[[x] for x in held[1:]]]
            return pa.RecordBatch.from_arrays(
                [pa.array(a, f.type) for a, f in zip(arrays, _PIECES)], schema=_PIECES
            )

        held, size = None, 0
        for batch in batches:
            for conv, turn, role, text in zip(*[batch.column(c).to_pylist() for c in COLUMNS]):
                bytes_ = len(text or "") * 4
                if held is not None and (
                    held[0] != conv or len(held[1]) >= piece_rows or size + bytes_ > piece_bytes
                ):
                    yield piece()
                    held, size, at = None, 0, at + 1
                if held is None:
                    held = (conv, [], [], [])
                held[1].append(turn)
                held[2].append(role)
                held[3].append(text)
                size += bytes_
        if held is not None:
            yield piece()

    return staged(ordered.sortWithinPartitions(*COLUMNS).mapInArrow(cut, PIECES), "pieces")
