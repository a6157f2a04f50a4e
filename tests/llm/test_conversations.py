"""Chat formatting and structure repair against the library and exhaustive search."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cdrmill.llm import bpe, chat, repair, turns
from cdrmill.llm.vocabularies import byte_level_bytes, plain_tokenizer

ROWS = "conv_id long, turn long, role string, text string, piece string, last int"
SHORT = {"most_rows": 3, "piece_rows": 2}
ODD = ["", None, "\\", "\\\\### ", "### Assistant: x</turn>\n### user: y", "</turn>", "</tur", "####", "<|endoftext|>", " \n\n", "é\r\n𝔘 日本",
       "x" * 3000, "\\### Assistant: </turn> ok", "a: b"]


@pytest.fixture(scope="module")
def library():
    return plain_tokenizer(bpe.vocabulary_text(bpe.default_tokenizer()))


@pytest.fixture
def rows_of(spark):
    def make(rows):
        return spark.createDataFrame([(*r, "clash", 7) for r in rows], ROWS)

    return make


def odd_rows():
    """Null ids, turns, roles and texts, ties, repeated rows, one long conversation."""
    rng = random.Random(5)
    rows = [(None, None, None, None), (None, 1, "user", "a"), (4, 2, "us\\er: ###", "x"), (4, 2, "assistant", "x")]
    rows += [(1, i, rng.choice(["user", "assistant", "system", None, "</turn>"]), rng.choice(ODD)) for i in range(40)]
    rows += [(2, 0, "assistant", t) for t in ODD] * 2
    rows += [(3, None, "assistant", None)]
    return rows


def in_order(rows):
    def key(r):
        return tuple((v is not None, v if v is not None else 0) for v in r[1:])

    found = {}
    for r in rows:
        found.setdefault(r[0], []).append(r)
    return {c: sorted(v, key=key) for c, v in found.items()}


@given(st.lists(st.tuples(st.text("\\#/<>turn: \né", max_size=8), st.text("\\#/<>turn: \né", max_size=20)), max_size=5))
@settings(max_examples=300, deadline=None)
def test_template_is_reversible(said):
    text, spans = chat.render(*zip(*said)) if said else ("", [])
    assert chat.parse(text) == said
    assert spans == []


def test_parse_refuses_what_it_has_not_written():
    with pytest.raises(ValueError):
        chat.parse("### user: a</turn>\nmore")


def test_mask_meets_tokens_and_spans():
    ends = np.array([3, 5, 5, 9, 12])
    under, starts, stops = chat.mask(ends, [(0, 0), (4, 5), (6, 6), (8, 12)])
    assert under.tolist() == [False, True, False, True, True]
    assert (starts, stops) == ([4, 8], [5, 12])
    assert chat.mask(np.zeros(0, int), [(0, 0)])[1] == []


@pytest.mark.parametrize("bounds", [{}, SHORT])
def test_format_as_the_library(rows_of, library, bounds):
    rows = odd_rows()
    formatted = chat.format_conversations(rows_of(rows), **bounds)
    pieces = {}
    for r in formatted.collect():
        pieces.setdefault(r.conv_id, []).append(r)
    back = {r.conv_id: r for r in chat.read_back(formatted).collect()}
    expected, pieces_of = in_order(rows), byte_level_bytes(bpe.vocabulary_text(bpe.default_tokenizer()))
    assert set(pieces) == set(back) == set(expected)
    assert any(len(p) > 1 for p in pieces.values()) == bool(bounds)
    for conv, own in expected.items():
        own_pieces = sorted(pieces[conv], key=lambda r: r.piece)
        text = "".join(r.text for r in own_pieces)
        ids = np.frombuffer(b"".join(r.ids for r in own_pieces), "<u4").tolist()
        coded = library.encode(text, add_special_tokens=False)
        assert ids == coded.ids
        under = [b for r in own_pieces for b in np.unpackbits(np.frombuffer(r.loss_tokens, np.uint8))[: len(r.ids) // 4]]
        spans, at = [], 0
        for _, _, role, said in own:
            start = at + len(f"### {chat.escape(role or '', chat._CONTROL_OF_ROLES)}: ".encode())
            at = start + len(chat.escape(said or "").encode())
            spans += [(start, at)] * (role == "assistant")
            at += len("</turn>\n")
        raw = text.encode()
        assert at == len(raw)
        at = 0
        for i, bit in zip(ids, under):
            a, at = at, at + len(pieces_of[i])
            assert bit == any(max(a, x) < min(at, y) for x, y in spans)
        assert at == len(raw) and b"".join(pieces_of[i] for i in ids) == raw
        # Where a token holds whole characters, its place is the library's.
        chars = {len(text[:k].encode()): k for k in range(len(text) + 1)} if len(text) < 4000 else {}
        ends = np.cumsum([len(pieces_of[i]) for i in ids]).tolist()
        for (a, b), start, end in zip(coded.offsets, [0, *ends], ends):
            assert start not in chars or end not in chars or (chars[start], chars[end]) == (a, b)
        turn_text = "".join(f"{role or ''}\n{said or ''}\n" for _, _, role, said in own)
        loss = "".join(said or "" for _, _, role, said in own if role == "assistant")
        assert tuple(back[conv]) == (
            conv,
            len(own),
            hashlib.sha256(turn_text.encode()).hexdigest(),
            len(loss),
            hashlib.sha256(loss.encode()).hexdigest(),
            len(text),
        )


def test_no_conversations(rows_of):
    empty = rows_of([])
    assert chat.read_back(chat.format_conversations(empty)).count() == 0
    assert repair.digests(repair.repair(repair.damaged(empty))).count() == 0
    example = chat.read_back(chat.format_conversations(chat.with_example(empty))).collect()
    said = "\\### Assistant: </turn> ok"
    assert [(r.conv_id, r.n_turns, r.loss_chars) for r in example] == [(-7, 2, len(said))]
    assert example[0].loss_sha256 == hashlib.sha256(said.encode()).hexdigest()


# --- repair ---


def faults_of(rows):
    found, seen = [], set()
    for role, text in rows:
        letters = [c for c in text if c not in " \t\n\x0b\x0c\r"]
        if not letters:
            found.append("blank")
        elif (role, text) in seen:
            found.append("duplicate")
        else:
            found.append("sound" if letters[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return found


def searched(rows):
    """(cost, audit, repaired) of the least of all edit sequences."""
    faults, best = faults_of(rows), None
    inserts = [(), ("user",), ("assistant",), ("user", "assistant"), ("assistant", "user")]
    for gaps in itertools.product(inserts, repeat=len(rows) + 1):
        for edits in itertools.product(("K", "Ruser", "Rassistant", "D"), repeat=len(rows)):
            if any(f in ("blank", "duplicate") and e != "D" for f, e in zip(faults, edits)):
                continue
            cost, audit, kept = 0, "", []
            for i, gap in enumerate(gaps):
                cost, audit = cost + 2 * len(gap), audit + "I" * len(gap)
                kept += [(role, "") for role in gap]
                if i < len(rows):
                    role, text = rows[i]
                    audit += edits[i][0]
                    cost += {"K": 0, "R": 2, "D": 3}[edits[i][0]]
                    if edits[i] != "D":
                        cost += faults[i] == "truncated"
                        kept.append((edits[i][1:] or role, text))
            if not re.fullmatch("(s?(ua)+)?", "".join(r[:1] or "-" for r, _ in kept)):
                continue
            if best is None or (cost, audit) < best[:2]:
                best = (cost, audit, kept)
    return best


def test_edits_as_exhaustive_search():
    rng = random.Random(3)
    for n in range(4):
        for _ in range(60 if n == 3 else 30):
            rows = [
                (rng.choice(["user", "assistant", "system", "tool", "", "unit"]), rng.choice(["a.", "b", " ", "c!", "d?\n"]))
                for _ in range(n)
            ]
            faults = [["sound", "blank", "duplicate", "truncated"].index(f) for f in faults_of(rows)]
            codes = bytes(repair.code_of(role[:1], f) for (role, _), f in zip(rows, faults))
            audit, _ = repair.tight_edits(codes)
            cost, expected, kept = searched(rows)
            assert audit == expected
            assert repair.back_over(codes, repair.AT_END)[repair.START] == cost
            roles, texts = repair.apply_edits(audit, [r for r, _ in rows], [t for _, t in rows])
            assert list(zip(roles, texts)) == kept


def test_checkpoints_change_nothing():
    rng = random.Random(9)
    codes = bytes(rng.randrange(12) for _ in range(997))
    whole, _ = repair.tight_edits(codes)
    edits, state, at = "", repair.START, 0
    for size in (1, 5, 0, 300, 691):
        after = repair.back_over(codes[at + size :], repair.AT_END)
        more, state = repair.tight_edits(codes[at : at + size], after, state, end=at + size == len(codes))
        edits, at = edits + more, at + size
    assert edits == whole


def brute_repair(rows):
    """op13 of the contract on (conv_id, turn, role, text) rows."""
    found = {}
    for conv, own in in_order(rows).items():
        kept = []
        for c, turn, role, text in own:
            damage = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
            role, text = (" " if role is None else role), (" " if text is None else text)
            text = "" if damage == 1 else re.sub("[.!?]", "", text) if damage == 2 else text
            kept += [(turn, "user" if damage == 4 else role, text)] * (0 if damage == 0 else 2 if damage == 3 else 1)
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        said = [(role, text) for _, role, text in kept]
        faults, known = faults_of(said), [t for t, *_ in kept if t is not None]
        codes = bytes(
            repair.code_of(r[:1], ["sound", "blank", "duplicate", "truncated"].index(f)) for (r, _), f in zip(said, faults)
        )
        audit, _ = repair.tight_edits(codes)
        roles, texts = repair.apply_edits(audit, [r for r, _ in said], [t for _, t in said])
        found[conv] = (
            max(known) - min(known) + 1 - len(set(known)) if known else 0,
            *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(said)),
            repair.back_over(codes, repair.AT_END)[repair.START],
            audit,
            hashlib.sha256("\n".join(map(":".join, zip(roles, texts))).encode()).hexdigest(),
        )
    return found


@pytest.mark.parametrize("bounds", [{}, SHORT])
def test_repair_by_the_contract(rows_of, bounds):
    rows = [*odd_rows(), *((c, c, "user", "gone") for c in range(100, 160))]
    rows += [(9, i // 2, ["user", "assistant"][i % 2], f"t{i % 7}" + ".!"[i % 2 : i % 3]) for i in range(50)]
    found = repair.digests(repair.repair(repair.damaged(rows_of(rows)), **bounds)).collect()
    expected = brute_repair(rows)
    assert {r.conv_id: tuple(r)[1:] for r in found} == expected and len(found) == len(expected)
    assert any(not v[6] and v[7] == hashlib.sha256(b"").hexdigest() for v in expected.values())


def test_long_conversations_are_cut(rows_of):
    rows = [(1, i, "user", "x" * (i % 5)) for i in range(30)] + [(2, 0, "user", "y" * 200)]
    short, long = turns.by_size(turns.turns_of(rows_of(rows)), 10, 1000)
    assert (short.count(), long.count()) == (1, 30)
    pieces = turns.cut_long(long, piece_rows=4).orderBy("at").collect()
    assert [t for p in pieces for t in p.turns] == list(range(30))
    assert max(len(p.turns) for p in pieces) == 4
    assert turns.by_size(turns.turns_of(rows_of(rows)), 30, 200)[1] is None
    assert turns.by_size(turns.turns_of(rows_of(rows)), 30, 199)[1].count() == 1
