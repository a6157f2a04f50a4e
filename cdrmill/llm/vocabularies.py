"""The bytes that token ids stand for, of both kinds of vocabulary files."""

from __future__ import annotations

import json
import os
import re

import numpy as np

from .bpe import _byte_of

# How a piece vocabulary writes a space, and a byte.
SPACE_SIGN = "▁"
_BYTE_PIECE = re.compile(r"<0x([0-9A-Fa-f]{2})>")


def byte_level_bytes(text: str) -> list[bytes]:
    """By id, of a byte-level BPE vocabulary in JSON."""
    given, byte_of = json.loads(text), _byte_of()
    vocabulary = given["model"]["vocab"] | {t["content"]: t["id"] for t in given["added_tokens"]}
    found = [b""] * (max(vocabulary.values(), default=-1) + 1)
    for token, i in vocabulary.items():
        whole = all(c in byte_of for c in token)
        found[i] = bytes(byte_of[c] for c in token) if whole else token.encode()
    return found


def piece_bytes(model) -> list[bytes]:
    """By id, of a sentencepiece processor: bytes as such, the space sign as space."""
    found = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        byte = _BYTE_PIECE.fullmatch(piece) if model.is_byte(i) else None
        found.append(bytes([int(byte[1], 16)]) if byte else piece.replace(SPACE_SIGN, " ").encode())
    return found


def lengths_of(pieces: list[bytes]) -> np.ndarray:
    return np.array([len(p) for p in pieces], dtype=np.int64)


def plain_tokenizer(text: str):
    """The tokenizers library on a vocabulary, special tokens' strings taken for
    plain text, without truncation, padding or threads of its own."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(text)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    tokenizer.encode_special_tokens = True
    return tokenizer
