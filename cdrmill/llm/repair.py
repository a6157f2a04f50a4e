"""Structure repair of conversations by a checkpointed dynamic programme.

Faults are marked row by row (the first of blank, duplicate, truncated counts),
then the cheapest edits are sought that give role initials ``(s?(ua)+)?``: keep
(0), rerole to user or assistant (2), delete (3, required for blank and
duplicate rows), insert an empty user or assistant turn (2); a truncated row that
stays adds 1.

A row is one byte of code, a state is where in the pattern the kept turns end.
``before`` takes the costs-to-go of the four states back over one row. The
backward walk stores these vectors at checkpoints only, about the square root of
the rows apart; the forward walk recomputes one block of them at a time and, as
each state admits one edit of a kind, takes the ASCII-least tight edit, which
gives the ASCII-least audit. Conversations too long for one task are pieces
(see ``turns``): their checkpoints are the pieces' edges, rows stay where they
are and only codes meet in one task, a piece at a time.

A row with neither role nor text just names its conversation; other nulls are
empty. Null turns come first, equal turns go by role and text, rows without
conv_id make one conversation, repeated rows are duplicates, other columns are
ignored. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import isqrt

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .chat import mark_last
from .common import staged
from .turns import MOST_BYTES, MOST_ROWS, PIECE_BYTES, PIECE_ROWS, by_size, conversations, cut_long, grouped, turns_of

# White space and ends of sentences.
WHITE = " \t\n\x0b\x0c\r"
SENTENCE_ENDS = ".!?"

# Costs.
REROLE, DELETE, INSERT, UNFINISHED = 2, 3, 2, 1
# States: nothing kept yet, behind a system, user, assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
# By state: the state that each initial leads to, and that of the turn that may
# be put in or taken for another there.
KEPT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
NEXT = (USER, USER, ASSISTANT, USER)
NEXT_ROLE = ("user", "user", "assistant", "user")
# Costs-to-go behind the last row.
AT_END = (0, 2 * INSERT, INSERT, 0)

INITIALS = "sua"  # others have code 3
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)

Costs = tuple[int, int, int, int]


def code_of(initial: str, fault: int) -> int:
    """A row for the walk: its initial and what its fault asks."""
    asks = 1 if fault in (BLANK, DUPLICATE) else 2 if fault == TRUNCATED else 0
    return (INITIALS.index(initial) if initial and initial in INITIALS else 3) * 3 + asks


def _row(code: int) -> tuple[str, bool, int]:
    """Initial, whether it must go, what it costs to stay."""
    kind, asks = divmod(code, 3)
    return (*INITIALS, "")[kind], asks == 1, UNFINISHED if asks == 2 else 0


@lru_cache(maxsize=4_096)
def _before(code: int, after: Costs) -> Costs:
    initial, must_go, stays = _row(code)
    found = []
    for state in range(4):
        cost = DELETE + after[state]
        if not must_go:
            cost = min(cost, REROLE + stays + after[NEXT[state]])
            if initial in KEPT[state]:
                cost = min(cost, stays + after[KEPT[state][initial]])
        found.append(cost)
    for _ in range(3):  # as many turns put in ahead of a row as can help
        for state in range(4):
            found[state] = min(found[state], INSERT + found[NEXT[state]])
    return tuple(found)


def before(code: int, after: Costs) -> Costs:
    """Costs-to-go ahead of a row from those behind it."""
    low = min(after)
    return tuple(low + c for c in _before(code, tuple(c - low for c in after)))


def back_over(codes: bytes, after: Costs) -> Costs:
    for code in reversed(codes):
        after = before(code, after)
    return after


def tight_edits(codes: bytes, after: Costs = AT_END, state: int = START, end: bool = True) -> tuple[str, int]:
    """The ASCII-least of the cheapest edits, and the state they lead to.

    ``after`` are the costs-to-go behind the last row; with ``end`` nothing
    follows, and what is missing is put in there.
    """
    step = max(1, isqrt(len(codes)))
    checkpoints = {}
    at = after
    for i in range(len(codes) - 1, -1, -1):
        if (i + 1) % step == 0 or i + 1 == len(codes):
            checkpoints[i + 1] = at
        at = before(codes[i], at)
    edits = []
    for start in range(0, len(codes), step):
        block = codes[start : start + step]
        costs = [checkpoints[start + len(block)]]
        for code in reversed(block):
            costs.append(before(code, costs[-1]))
        costs.reverse()
        for i, code in enumerate(block):
            initial, must_go, stays = _row(code)
            here, behind = costs[i], costs[i + 1]
            while True:
                if here[state] == DELETE + behind[state]:
                    edits.append("D")
                    break
                if here[state] == INSERT + here[NEXT[state]]:
                    edits.append("I")
                    state = NEXT[state]
                    continue
                kept = KEPT[state].get(initial)
                if not must_go and kept is not None and here[state] == stays + behind[kept]:
                    edits.append("K")
                    state = kept
                else:
                    edits.append("R")
                    state = NEXT[state]
                break
    while end and after[state]:
        edits.append("I")
        state = NEXT[state]
    return "".join(edits), state


def apply_edits(
    edits: str, roles: list[str], texts: list[str], state: int = START
) -> tuple[list[str], list[str]]:
    """The repaired turns."""
    new_roles, new_texts, row = [], [], 0
    for edit in edits:
        if edit != "D":
            new_roles.append(roles[row] if edit == "K" else NEXT_ROLE[state])
            new_texts.append("" if edit == "I" else texts[row])
            state = KEPT[state][roles[row][:1]] if edit == "K" else NEXT[state]
        row += edit != "I"
    return new_roles, new_texts


def fault_of(text: str, repeats: bool) -> int:
    """The first fault of a row that may repeat an earlier one."""
    said = text.rstrip(WHITE)
    if not said:
        return BLANK
    if repeats:
        return DUPLICATE
    return SOUND if said[-1] in SENTENCE_ENDS else TRUNCATED


class Tally:
    """Counts of a conversation, a piece at a time."""

    def __init__(self):
        self.low = self.high = self.turn = self.initial = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = self.cost = 0

    def add(self, turns: list[int | None], initials: list[str], faults: bytes, edits: str) -> None:
        for turn, initial in zip(turns, initials):
            if turn is not None:
                self.low = turn if self.low is None else self.low
                self.turns += turn != self.turn
                self.high = self.turn = turn
            if self.initial is not None:
                self.illegal += self.initial + initial not in ("su", "ua", "au")
            self.initial = initial
        self.blank += faults.count(BLANK)
        self.duplicate += faults.count(DUPLICATE)
        self.truncated += faults.count(TRUNCATED)
        row = 0
        for edit in edits:
            self.cost += {"D": DELETE, "I": INSERT, "K": 0, "R": REROLE}[edit]
            if edit != "I":
                self.cost += UNFINISHED * (edit != "D" and faults[row] == TRUNCATED)
                row += 1

    def values(self) -> tuple[int, ...]:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
REPAIRED = (
    "conv_id long, piece long, last boolean, "
    + ", ".join(f"{c} long" for c in COUNTS)
    + ", audit string, roles array<string>, texts array<string>"
)
_REPAIRED = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("piece", pa.int64()),
        ("last", pa.bool_()),
        *[(c, pa.int64()) for c in COUNTS],
        ("audit", pa.string()),
        ("roles", pa.list_(pa.string())),
        ("texts", pa.list_(pa.string())),
    ]
)
# Rows of results in a batch.
_TOGETHER = 1_000


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == _TOGETHER:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _named_only(role: str | None, text: str | None) -> bool:
    return role is None and text is None


def _repair_whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for conv, turns, roles, texts in conversations(batches):
            kept = [
                (turn, role or "", text or "")
                for turn, role, text in zip(turns, roles, texts)
                if not _named_only(role, text)
            ]
            turns, roles, texts = map(list, zip(*kept)) if kept else ([], [], [])
            seen: set[tuple[str, str]] = set()
            faults = bytearray()
            for said in zip(roles, texts):
                faults.append(fault_of(said[1], said in seen))
                seen.add(said)
            initials = [r[:1] for r in roles]
            edits, _ = tight_edits(bytes(map(code_of, initials, faults)))
            tally = Tally()
            tally.add(turns, initials, bytes(faults), edits)
            yield conv, 0, True, *tally.values(), edits, *apply_edits(edits, roles, texts)

    yield from _batches(rows(), _REPAIRED)


def repair(
    rows: DataFrame,
    *,
    most_rows: int = MOST_ROWS,
    most_bytes: int = MOST_BYTES,
    piece_rows: int = PIECE_ROWS,
    piece_bytes: int = PIECE_BYTES,
) -> DataFrame:
    """REPAIRED: counts of faults, the edits' initials and the repaired turns.

    A conversation is one row, or, beyond ``most_rows`` or ``most_bytes``, one for
    each piece, with the counts so far and its own edits and turns; pieces follow
    one another in one partition, ``last`` marks the end.
    """
    short, long = by_size(turns_of(rows), most_rows, most_bytes)
    found = grouped(short).mapInArrow(_repair_whole, REPAIRED)
    if long is None:
        return found
    return found.unionByName(_repair_long(cut_long(long, piece_rows, piece_bytes)))


_CODED = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("at", pa.int64()),
        ("turns", pa.list_(pa.int64())),
        ("initials", pa.list_(pa.string())),
        ("faults", pa.binary()),
    ]
)
CODED = "conv_id long, at long, turns array<long>, initials array<string>, faults binary"
_CHECKPOINT = pa.schema([("at", pa.int64()), ("after", pa.list_(pa.int64()))])
_EDITED = pa.schema(
    [
        ("at", pa.int64()),
        ("state", pa.int32()),
        *[(c, pa.int64()) for c in COUNTS],
        ("audit", pa.string()),
    ]
)
EDITED = "at long, state int, " + ", ".join(f"{c} long" for c in COUNTS) + ", audit string"


def _repeats(pieces: DataFrame) -> DataFrame:
    """at and the rows of that piece which repeat an earlier row of the
    conversation. Rows are told apart by digests; first rows meet all rows by
    their place, so a row repeated often is no hot key."""
    row = F.posexplode(F.arrays_zip("roles", "texts")).alias("i", "_said")
    said = pieces.select("conv_id", "at", row).filter("_said.roles is not null or _said.texts is not null")
    digest = F.sha2(F.concat_ws("\n", F.coalesce("_said.roles", F.lit("")), F.coalesce("_said.texts", F.lit(""))), 256)
    said = said.select("conv_id", "at", "i", digest.alias("_digest"))
    first = said.groupBy("conv_id", "_digest").agg(F.min(F.struct("at", "i")).alias("_first"))
    first = first.select(F.col("_first.at").alias("at"), F.col("_first.i").alias("i"))
    again = said.select("at", "i").join(first, ["at", "i"], "left_anti")
    return again.groupBy("at").agg(F.collect_list("i").alias("again"))  # at most a piece's rows


def _repair_long(pieces: DataFrame) -> DataFrame:
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for r in batch.to_pylist():
                    again = set(r["again"] or ())
                    kept = [
                        (turn, (role or "")[:1], fault_of(text or "", i in again))
                        for i, (turn, role, text) in enumerate(zip(r["turns"], r["roles"], r["texts"]))
                        if not _named_only(role, text)
                    ]
                    turns, initials, faults = zip(*kept) if kept else ((), (), ())
                    yield r["conv_id"], r["at"], turns, initials, bytes(faults)

        yield from _batches(rows(), _CODED)

    def codes_of(r: dict) -> bytes:
        return bytes(map(code_of, r["initials"], r["faults"]))

    def backward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            conv, after = object(), AT_END
            for batch in batches:
                for r in batch.to_pylist():
                    if r["conv_id"] != conv:
                        conv, after = r["conv_id"], AT_END
                    yield r["at"], after
                    after = back_over(codes_of(r), after)

        yield from _batches(rows(), _CHECKPOINT)

    def forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            conv, state, tally = object(), START, Tally()
            for batch in batches:
                for r in batch.to_pylist():
                    if r["conv_id"] != conv:
                        conv, state, tally = r["conv_id"], START, Tally()
                    came = state
                    edits, state = tight_edits(codes_of(r), tuple(r["after"]), state, end=r["last"])
                    tally.add(r["turns"], r["initials"], r["faults"], edits)
                    yield r["at"], came, *tally.values(), edits

        yield from _batches(rows(), _EDITED)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for r in batch.to_pylist():
                    said = zip(r["roles"], r["texts"])
                    kept = [(role or "", text or "") for role, text in said if not _named_only(role, text)]
                    roles, texts = map(list, zip(*kept)) if kept else ([], [])
                    turns = apply_edits(r["audit"], roles, texts, r["state"])
                    yield r["conv_id"], r["at"], False, *[r[c] for c in COUNTS], r["audit"], *turns

        yield from _batches(rows(), _REPAIRED)

    marked = pieces.join(_repeats(pieces), "at", "left").select(*pieces.columns, "again")
    coded = staged(marked.mapInArrow(code, CODED), "coded")
    falling = coded.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("at"))
    checkpoints = falling.mapInArrow(backward, "at long, after array<long>")
    # Rows of a conversation behind its last place have none to follow.
    ends = coded.groupBy("conv_id").agg(F.max("at").alias("at")).select("at", F.lit(True).alias("last"))
    known = coded.join(staged(checkpoints, "checkpoints"), "at").join(ends, "at", "left")
    known = known.withColumn("last", F.coalesce("last", F.lit(False)))
    rising = known.repartition("conv_id").sortWithinPartitions("conv_id", "at")
    edited = staged(rising.mapInArrow(forward, EDITED), "edited")
    repaired = pieces.join(edited, "at").mapInArrow(write, REPAIRED)
    ordered = repaired.repartition("conv_id").sortWithinPartitions("conv_id", "piece")
    return ordered.mapInArrow(mark_last, REPAIRED)


DIGESTS = "conv_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", audit string, repaired_sha256 string"


def digests(repaired: DataFrame) -> DataFrame:
    """One row for each conversation: counts, whole audit, and the digest of the
    repaired turns (role, colon, text; parted by line ends)."""
    import hashlib

    schema = pa.schema(
        [
            ("conv_id", pa.int64()),
            *[(c, pa.int64()) for c in COUNTS],
            ("audit", pa.string()),
            ("repaired_sha256", pa.string()),
        ]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            hashed, audit, any_turn = hashlib.sha256(), [], False
            for batch in batches:
                for r in batch.to_pylist():
                    for role, text in zip(r["roles"], r["texts"]):
                        hashed.update(("\n" * any_turn + f"{role}:{text}").encode())
                        any_turn = True
                    audit.append(r["audit"])
                    if r["last"]:
                        yield r["conv_id"], *[r[c] for c in COUNTS], "".join(audit), hashed.hexdigest()
                        hashed, audit, any_turn = hashlib.sha256(), [], False

        yield from _batches(rows(), schema)

    return repaired.mapInArrow(work, DIGESTS)


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with faults, by the crc32 of ``conv_id:turn`` modulo 20
    (nulls: one space): 0 drops the row, which then just names its conversation,
    1 empties the text, 2 takes ends of sentences out of it, 3 repeats the row, 4
    makes it the user's."""

    def known(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit(" "))

    damage = F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn"))) % 20
    text = (
        F.when(damage == 0, F.lit(None))
        .when(damage == 1, F.lit(""))
        .when(damage == 2, F.regexp_replace(known("text"), "[.!?]", ""))
        .otherwise(known("text"))
    )
    role = F.when(damage == 0, F.lit(None)).when(damage == 4, F.lit("user")).otherwise(known("role"))
    copies = F.explode(F.when(damage == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    made = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("_copy"))
    return turns_of(made)
