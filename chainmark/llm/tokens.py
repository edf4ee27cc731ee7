"""What BPE encoding and token counting share: the vocabulary file and the split into words.

The files are those of public tokenizers; their path is a parameter and is read by each task, so it must be
readable on every executor. Special strings inside a text are single tokens, as the tokenizers library has it
by default; with ``special=False`` they are ordinary text.
"""

from __future__ import annotations

import functools
import json
from dataclasses import dataclass

import numpy as np
import regex

#: Fixed value: the split pattern of byte-level BPE vocabularies of 50,257 entries.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary, by the public rule: printable
    Latin-1 letters stand for themselves, all other bytes get letters from 256 on, in byte order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@dataclass(frozen=True)
class Vocabulary:
    """``pieces``: bytes of each id; ``merges``: pairs of ids by rank; ``special``: ids of special strings."""

    pieces: list[bytes]
    merges: list[tuple[int, int]]
    special: dict[str, int]
    byte_ids: np.ndarray


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    letters, vocab = byte_letters(), spec["model"]["vocab"]
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    pieces = [b""] * (1 + max([*vocab.values(), *special.values()]))
    for text, i in vocab.items():
        pieces[i] = bytes(letters[c] for c in text)
    for text, i in special.items():
        pieces[i] = text.encode()
    pairs = (m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"])
    byte_ids = np.zeros(256, np.int64)
    for c, b in letters.items():
        byte_ids[b] = vocab[c]
    return Vocabulary(pieces, [(vocab[a], vocab[b]) for a, b in pairs], special, byte_ids)


class Splitter:
    """Cuts a text into the words that merges never cross; a special string is a word of its own."""

    def __init__(self, special: dict[str, int]):
        self.find = regex.compile(PATTERN).findall
        self.special = special
        self.marks = regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")") if special else None

    def __call__(self, text: str) -> list[str]:
        if self.marks is None or not any(s in text for s in self.special):
            return self.find(text)
        out: list[str] = []
        for part in self.marks.split(text):
            if part in self.special:
                out.append(part)
            else:
                out.extend(self.find(part))
        return out
