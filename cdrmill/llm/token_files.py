"""Token ids as Arrow stream files of equal-length sequences.

Documents in ascending order of doc_id, each ended by an end id, are one stream
of ids, cut into sequences of ``length``. A task writes its range of the stream
to a file of its own: record batches of a fixed number of sequences with the
columns ``ids`` (fixed-size list of uint16, or uint32 for a wide vocabulary) and
``mask`` (fixed-size list of bool, false where the last sequence is padded). No
column has nulls and each batch has the same number of rows, so all batches are
equally long on disk and sequence i lies at a place that arithmetic gives: it
is read by memory map, without a copy. A second Arrow stream beside it lists the
documents: doc_id, place of the first id in the file, number of ids.

Null texts count as empty. A null doc_id comes first; rows with one doc_id
follow in order of their text. Other columns are ignored. An empty table makes
no file.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import added_tokens, default_tokenizer, encoder_of, expand, make_splitter, vocabulary_text
from .common import scratch_path, staged, text_chunks
from .files import new_name, read_from, write_to

END_ID = 0
SEQUENCE = 2_048
# Sequences in a record batch.
BATCH_ROWS = 64
# Units whose ids a Python worker remembers, and text that a task encodes at a time.
REMEMBERED = 400_000
ENCODED_BYTES = 4 << 20
DOCUMENT_FIELDS = [("doc_id", pa.int64()), ("first", pa.int64()), ("n_tokens", pa.int64())]
FILES = "part int, path string, documents string, first_id long, n_ids long, n_docs long"


def sequence_schema(length: int, wide: bool) -> pa.Schema:
    kind = pa.uint32() if wide else pa.uint16()
    return pa.schema(
        [
            pa.field("ids", pa.list_(pa.field("item", kind, nullable=False), length), nullable=False),
            pa.field("mask", pa.list_(pa.field("item", pa.bool_(), nullable=False), length), nullable=False),
        ]
    )


# Marks that always begin a piece of their own behind a letter.
_MARKS = ".,;:!?"


class Memory:
    """Ids of units met before, in flat arrays. A unit of letters and marks has the
    ids of both, and these are remembered alone. Full, it goes on with what several
    chunks had; so it may be kept from one task to the next."""

    def __init__(self, encoder):
        self.encoder = encoder
        self._clear()

    def _clear(self) -> None:
        self.number: dict[str, int] = {}
        self.values = np.array([END_ID], dtype="<u4")  # entry 0 is the end of a text
        self.starts, self.sizes = np.zeros(1, np.int64), np.ones(1, np.int64)
        self.met = np.zeros(1, np.int64)  # chunks that had an entry

    def _forget(self) -> None:
        again = self.met > 1
        if 2 * np.count_nonzero(again) > REMEMBERED:
            self._clear()
            return
        again[0] = True
        kept = np.flatnonzero(again)
        number = np.cumsum(again) - 1
        self.number = {text: int(number[at]) for text, at in self.number.items() if again[at]}
        self.values = expand(kept, self.starts, self.sizes, self.values)
        self.sizes = self.sizes[kept]
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.met = np.ones(len(kept), np.int64)

    def _numbers(self, units: pa.Array) -> np.ndarray:
        """Entry numbers of distinct units without marks, or of marks."""
        texts = units.to_pylist()
        found = np.fromiter((self.number.get(t, -1) for t in texts), np.int64, len(texts))
        new = np.flatnonzero(found < 0)
        if len(new):
            ids, sizes = self.encoder.encode(units.take(pa.array(new)))
            first = len(self.sizes)
            found[new] = np.arange(first, first + len(new))
            self.number.update((texts[i], first + k) for k, i in enumerate(new))
            self.starts = np.concatenate([self.starts, len(self.values) + np.cumsum(sizes) - sizes])
            self.sizes = np.concatenate([self.sizes, sizes])
            self.values = np.concatenate([self.values, ids])
            self.met = np.concatenate([self.met, np.zeros(len(new), np.int64)])
        self.met[found] += 1
        return found

    def of(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Entry numbers of distinct units: of each, or of what is ahead of its
        marks, and of the marks (-1 where there are none)."""
        if len(self.number) > REMEMBERED:
            self._forget()
        ahead = pc.ascii_rtrim(units, _MARKS)
        parted = pc.and_(pc.not_equal(ahead, units), pc.match_substring_regex(ahead, "[A-Za-z]$"))
        # A string that the tokenizer cuts out first may hold marks.
        parted = pc.and_(parted, pc.invert(pc.is_in(units, self.encoder.added)))
        ahead = pc.if_else(parted, ahead, units)
        rows = np.flatnonzero(parted.to_numpy(zero_copy_only=False))
        marks = [t[n:] for t, n in zip(units.take(rows).to_pylist(), pc.utf8_length(ahead.take(rows)).to_pylist())]
        coded = pa.concat_arrays([ahead, pa.array(marks, ahead.type)]).dictionary_encode()
        found = self._numbers(coded.dictionary)[coded.indices.to_numpy(zero_copy_only=False)]
        behind = np.full(len(units), -1, dtype=np.int64)
        behind[rows] = found[len(units) :]
        return found[: len(units)], behind


_memories: dict[int, Memory] = {}


def memory_of(text: str) -> Memory:
    """One memory per Python worker and vocabulary."""
    if hash(text) not in _memories:
        _memories.clear()
        _memories[hash(text)] = Memory(encoder_of(text))
    return _memories[hash(text)]


def encode_chunk(column: pa.Array, split, memory: Memory) -> tuple[np.ndarray, np.ndarray]:
    """All ids of some texts, an end id after each text, and the ids per text."""
    units, offsets = split(column.fill_null(""))
    coded = units.dictionary_encode()
    ahead, behind = memory.of(coded.dictionary)
    at, ends = coded.indices.to_numpy(zero_copy_only=False), offsets[1:] - offsets[0]
    # What is ahead of a unit's marks, then these.
    codes = np.stack([ahead[at], behind[at]], axis=1).reshape(-1)
    kept = codes >= 0
    ends = np.concatenate([[0], np.cumsum(kept)])[2 * ends]
    codes = np.insert(codes[kept], ends, 0)
    counted = np.cumsum(memory.sizes[codes])[ends + np.arange(len(column))]
    ids = expand(codes, memory.starts, memory.sizes, memory.values)
    return ids, np.diff(counted, prepend=0)


class SequenceWriter:
    """Cuts a stream of ids into batches of equal-length sequences."""

    def __init__(self, out, length: int, wide: bool):
        self.schema, self.length = sequence_schema(length, wide), length
        self.writer = pa.ipc.new_stream(out, self.schema)
        self.held, self.n = [], 0

    def _write(self, ids: np.ndarray, real: int) -> None:
        kind = self.schema.field("ids").type.value_type
        mask = np.arange(len(ids)) < real
        arrays = [
            pa.FixedSizeListArray.from_arrays(pa.array(ids, kind), type=self.schema.field("ids").type),
            pa.FixedSizeListArray.from_arrays(pa.array(mask), type=self.schema.field("mask").type),
        ]
        self.writer.write_batch(pa.RecordBatch.from_arrays(arrays, schema=self.schema))

    def add(self, ids: np.ndarray) -> None:
        size = self.length * BATCH_ROWS
        self.held.append(ids)
        self.n += len(ids)
        if self.n >= size:
            every = np.concatenate(self.held)
            whole = len(every) // size * size
            for at in range(0, whole, size):
                self._write(every[at : at + size], size)
            self.held, self.n = [every[whole:]], len(every) - whole

    def close(self) -> None:
        if self.n:
            ids = np.zeros(self.length * BATCH_ROWS, dtype="<u4")
            ids[: self.n] = np.concatenate(self.held)
            self._write(ids, self.n)
        self.writer.close()


def _write_files(folder: str, shared, length: int, wide: bool):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        memory, split = memory_of(shared.value), make_splitter(added_tokens(shared.value))
        batches = (b for b in batches if b.num_rows)
        head = next(batches, None)
        if head is None:
            return
        path = new_name(folder, ".arrows")
        beside, n_ids, n_docs = path.removesuffix(".arrows") + ".docs.arrows", 0, 0
        fields = pa.schema(DOCUMENT_FIELDS)
        with write_to(path) as out, write_to(beside) as listed:
            writer, index = SequenceWriter(out, length, wide), pa.ipc.new_stream(listed, fields)
            while head is not None:
                for piece in text_chunks(head, size=ENCODED_BYTES):
                    ids, sizes = encode_chunk(piece.column("text"), split, memory)
                    writer.add(ids)
                    firsts = n_ids + np.cumsum(sizes) - sizes
                    columns = [piece.column("doc_id"), pa.array(firsts), pa.array(sizes)]
                    index.write_batch(pa.RecordBatch.from_arrays(columns, schema=fields))
                    n_ids, n_docs = n_ids + len(ids), n_docs + len(sizes)
                head = next(batches, None)
            writer.close()
            index.close()
        yield pa.RecordBatch.from_pydict(
            {
                "part": pa.array([TaskContext.get().partitionId()], pa.int32()),
                "path": [path],
                "documents": [beside],
                "first_id": pa.array([0], pa.int64()),
                "n_ids": [n_ids],
                "n_docs": [n_docs],
            }
        )

    return work


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str | None = None, length: int = SEQUENCE
) -> DataFrame:
    """Write the ids of all documents. Returns the files in stream order: part,
    path, documents, first_id (ids in all files before), n_ids, n_docs."""
    text = vocabulary_text(tokenizer or default_tokenizer())
    wide = len(added_tokens(text)) + text.count('": ') > 65_536
    shared = docs.sparkSession.sparkContext.broadcast(text)
    ordered = docs.select(F.col("doc_id").cast("long"), "text")
    ordered = ordered.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    files = staged(ordered.mapInArrow(_write_files(folder, shared, length, wide), FILES), "token_files")
    # One row per file.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("first_id", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)).cast("long"))


class TokenFile:
    """Random access to the sequences of a local file, without copies."""

    def __init__(self, path: str):
        self.map = pa.memory_map(path)
        reader = pa.ipc.open_stream(self.map)
        self.schema, self.start = reader.schema, self.map.tell()
        message = pa.ipc.read_message(self.map)
        self.stride = self.map.tell() - self.start
        self.rows = pa.ipc.read_record_batch(message, self.schema).num_rows

    def __getitem__(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and mask of sequence i. The ids point into the file."""
        self.map.seek(self.start + i // self.rows * self.stride)
        batch = pa.ipc.read_record_batch(pa.ipc.read_message(self.map), self.schema)
        length, at = self.schema.field("ids").type.list_size, i % self.rows
        ids = batch.column("ids").values.slice(at * length, length)
        mask = batch.column("mask").values.slice(at * length, length)
        return ids.to_numpy(), mask.to_numpy(zero_copy_only=False)


def _stream_ids(source) -> Iterator[np.ndarray]:
    """Ids of a file, padding left out, batch by batch."""
    for batch in pa.ipc.open_stream(source):
        ids, mask = batch.column("ids").values, batch.column("mask").values
        if not pc.all(mask).as_py():
            ids = ids.filter(mask)
        yield ids.to_numpy()


def _read_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ("path", "documents", "first_id")
    for batch in batches:
        for path, beside, first_id in zip(*(batch.column(c).to_pylist() for c in names)):
            with read_from(path) as source, read_from(beside) as listed:
                stream, held = _stream_ids(source), np.zeros(0, dtype="<u2")
                for docs in pa.ipc.open_stream(listed):
                    sizes, found = docs.column("n_tokens").to_pylist(), []
                    for size in sizes:
                        while len(held) < size:
                            held = np.concatenate([held, next(stream)])
                        found.append(held[:size].astype("<u4").tobytes())
                        held = held[size:]
                    yield pa.RecordBatch.from_arrays(
                        [
                            docs.column("doc_id"),
                            pc.add(docs.column("first"), first_id),
                            docs.column("n_tokens"),
                            pa.array(found, pa.binary()),
                        ],
                        ["doc_id", "start", "n_tokens", "ids"],
                    )


def read_token_files(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids (little-endian uint32, the end id last) of
    each document, from the files that ``write_token_files`` returned."""
    # By number, or the short list of files would be folded into one task.
    given = files.select("path", "documents", "first_id").repartition(max(1, files.count()), "path")
    return given.mapInArrow(_read_files, "doc_id long, start long, n_tokens long, ids binary")


def token_round_trip(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    folder = scratch_path(docs.sparkSession, "tokens")
    return read_token_files(write_token_files(docs, folder, tokenizer))
