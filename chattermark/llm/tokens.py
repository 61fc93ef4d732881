"""Byte-level BPE ids of texts, and where their sentences end.

Ids are those of the public `tokenizers` library for the same vocabulary file. They are
taken with `tiktoken`, three to four times as fast, from ranks read out of that file: in such
vocabularies the id of a token is the rank of its merge. The tests compare both libraries.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import tiktoken

#: Fixed value: how byte-level vocabularies split a text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Long texts are encoded in pieces of about so many characters.
PIECE = 1 << 16


def byte_of_symbol() -> dict[str, int]:
    """Bytes by the printable characters that stand for them in vocabulary files."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """One vocabulary file, loaded."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        self.special = {t["content"]: t["id"] for t in content["added_tokens"]}
        symbols = byte_of_symbol()
        ranks = {
            bytes(symbols[c] for c in token): i
            for token, i in content["model"]["vocab"].items()
            if token not in self.special
        }
        self.encoding = tiktoken.Encoding(
            path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=self.special
        )
        size = max([*ranks.values(), *self.special.values()]) + 1
        self.ends = np.zeros(size, dtype=bool)  # ends in a sentence mark, quotes and brackets aside
        self.breaks = np.zeros(size, dtype=bool)  # holds a line break
        self.opens = np.zeros(size, dtype=bool)  # begins with white space
        for token, i in ranks.items():
            self.ends[i] = token.rstrip(b"\"')]").endswith((b".", b"!", b"?"))
            self.breaks[i] = b"\n" in token
            self.opens[i] = token[:1] in (b" ", b"\n", b"\t", b"\r")

    def ids(self, text: str) -> np.ndarray:
        """Ids of a text of any length."""
        special = set(self.special)
        parts = [
            self.encoding.encode_to_numpy(piece, allowed_special=special, disallowed_special=())
            for piece in pieces(text)
        ]
        return np.concatenate(parts) if parts else np.empty(0, dtype="uint32")

    def sentence_ends(self, ids: np.ndarray) -> np.ndarray:
        """Whether a sentence or line ends after each token."""
        following = np.append(self.opens[ids[1:]], True)[: len(ids)]
        return (self.ends[ids] & following) | self.breaks[ids]


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """Loaded once by a Python worker."""
    return Vocabulary(path)


def pieces(text: str, size: int = PIECE) -> Iterator[str]:
    """A text cut before white space that follows something else, where no token reaches across."""
    begin = 0
    while len(text) - begin > size:
        at = begin + size
        while at < len(text) and not (text[at].isspace() and _plain(text[at - 1])):
            at += 1
        yield text[begin:at]
        begin = at
    if begin < len(text):
        yield text[begin:]


def _plain(character: str) -> bool:
    """Neither white space nor a control or format character that libraries may take for it."""
    return character.isalnum() or character.isprintable() and not character.isspace()
