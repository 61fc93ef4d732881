"""Document fingerprints: a Merkle tree over pieces, paragraphs and sections.

A paragraph is a line. A section is a run of paragraphs that ends after one
whose digest is divisible by eight, so an edit moves no boundary beyond its
neighbourhood. A paragraph is cut into pieces at punctuation and after eight words.
Digests of paragraphs make those of sections, and these the root.

A fingerprint is text: the root (SHA-256 as hex), then each section, its
paragraphs and their pieces (eight hex digits each). Equal roots mean equal
texts. Where roots differ, comparing section by section and paragraph by
paragraph leads to the pieces that were edited.

All work is within a row. Defined results: a null text counts as empty, which
is one paragraph without pieces. Two fingerprints without common pieces have
likeness 0 unless their roots are equal. Input columns named like an output
column are replaced.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from difflib import SequenceMatcher

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chattermark.llm.frames import carry, restore

PIECE = re.compile(r"(?:[^\s.,;:!?|]+[^\S\n]*){1,8}[.,;:!?|\s]*|[.,;:!?|\s]+")
PIECE_DIGITS = 8
SECTION_MEAN = 8


def paragraph_node(paragraph: str) -> tuple[bytes, str]:
    """Digest of a paragraph, and the digests of its pieces as hex."""
    pieces = "".join(xxhash.xxh32_hexdigest(x) for x in PIECE.findall(paragraph))
    return hashlib.sha256(paragraph.encode()).digest(), pieces


def fingerprint(text: str | None, known: dict[str, tuple[bytes, str]] | None = None) -> str:
    """The fingerprint; `known` keeps paragraph nodes from one call to the next."""
    known = {} if known is None else known
    sections, digests, pieces = [], [], []
    root = hashlib.sha256()
    for paragraph in (text or "").split("\n"):
        node = known.get(paragraph)
        if node is None:
            node = known[paragraph] = paragraph_node(paragraph)
        digests.append(node[0])
        pieces.append(node[1])
        if node[0][-1] % SECTION_MEAN == 0:
            root.update(hashlib.sha256(b"".join(digests)).digest())
            sections.append(";".join(pieces))
            digests, pieces = [], []
    if digests:
        root.update(hashlib.sha256(b"".join(digests)).digest())
        sections.append(";".join(pieces))
    return f"{root.hexdigest()}|{'|'.join(sections)}"


def _pieces(branch: str) -> list[str]:
    return [branch[i : i + PIECE_DIGITS] for i in range(0, len(branch), PIECE_DIGITS)]


def _all_pieces(mark: str) -> list[str]:
    return [p for branch in re.split(r"[|;]", mark)[1:] for p in _pieces(branch)]


def likeness(left: str, right: str) -> float:
    """1 for equal roots, else the share of pieces in common, of both together."""
    if left[:64] == right[:64]:
        return 1.0
    a, b = _all_pieces(left), _all_pieces(right)
    if not a or not b:
        return 0.0
    common = sum((Counter(a) & Counter(b)).values())
    # Equal pieces under unequal roots, as after a change of blanks alone, are not equality.
    return min(2 * common / (len(a) + len(b)), 1 - 1e-9)


def differing(left: str, right: str) -> list[tuple[int, int, int, int]]:
    """Ranges of paragraphs that differ: (from, to) of the left and of the right text.

    Sections equal on both sides are skipped; only differing ones are compared
    paragraph by paragraph.
    """
    if left[:64] == right[:64]:
        return []
    sides = [[s.split(";") for s in mark.split("|")[1:]] for mark in (left, right)]
    starts = [[0], [0]]
    for side, at in zip(sides, starts, strict=True):
        for section in side:
            at.append(at[-1] + len(section))
    whole = SequenceMatcher(a=["|".join(s) for s in sides[0]], b=["|".join(s) for s in sides[1]], autojunk=False)
    found = []
    for op, a, b, c, d in whole.get_opcodes():
        if op == "equal":
            continue
        old = [p for s in sides[0][a:b] for p in s]
        new = [p for s in sides[1][c:d] for p in s]
        for op2, e, f, g, h in SequenceMatcher(a=old, b=new, autojunk=False).get_opcodes():
            if op2 != "equal":
                i, j = starts[0][a], starts[1][c]
                found.append((i + e, i + f, j + g, j + h))
    return found


def with_fingerprints(documents: DataFrame, *, text: str = "text") -> DataFrame:
    """`documents` with `fingerprint`."""

    @F.pandas_udf("string")
    def marked(texts: pd.Series) -> pd.Series:
        return texts.map(fingerprint)

    return restore(carry(documents, mark=marked(F.coalesce(text, F.lit("")))), fingerprint=F.col("mark"))


@F.pandas_udf(T.DoubleType())
def likeness_of(left: pd.Series, right: pd.Series) -> pd.Series:
    """Likeness of two fingerprint columns, null where one is null."""
    return pd.Series(
        [None if a is None or b is None else likeness(a, b) for a, b in zip(left, right, strict=True)],
        dtype="float64",
    )


EDITS = ("left_from", "left_to", "right_from", "right_to")


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField(name, T.LongType()) for name in EDITS])))
def edits_between(left: pd.Series, right: pd.Series) -> pd.Series:
    """Paragraph ranges that differ between two fingerprint columns, null where one is null."""
    return pd.Series(
        [
            None
            if a is None or b is None
            else [dict(zip(EDITS, x, strict=True)) for x in differing(a, b)]
            for a, b in zip(left, right, strict=True)
        ]
    )


def is_equal(left: Column, right: Column) -> Column:
    """Equality of two texts by the roots of their fingerprints."""
    return F.substring(left, 1, 64) == F.substring(right, 1, 64)
