"""Finds secrets in texts, also under layers of encoding.

A text is scanned as it stands. Then a worklist unwraps what is encoded in it:
lines with URL escapes, lines with Unicode escapes (also `\\U`, `\\u{}` and numeric
character references), and base64 runs, each alone and joined over single line breaks. What is glued to
the front of base64 shifts it, so a run is decoded from each of its first four letters; a shifted reading
counts only where twelve printable bytes stand together, which every secret and every further layer has.
Bytes from base64 or URL escapes may be compressed with gzip, zlib, bzip2 or xz, in any number of
members; within a run they are also looked for after `/`, `-`, `_` and `+`. Every layer is scanned
again and unwrapped in turn until nothing new appears. A layer that has been
seen at the same place is not opened again, so a cycle ends.

Bytes need not be text: what is not UTF-8 is read as Latin-1, and stretches of
two-byte characters are read as such too. `n_layers` counts the layers that are
text or hold a secret, not every long word that could be base64. A secret cut by
a line break in base64 may be found twice, in its first line and whole.

Each layer knows, for every character, the span of the original text it comes
from: escapes and base64 map character by character, compressed data as a
whole. Found spans are code points of the original text, end exclusive.

All work is within a row: no shuffle. Unpacked data of any size is scanned, in
overlapping pieces, so memory is bounded by one text, some pieces, and a digest
for each layer seen. Counted in `n_unopened` are compressed layers that are
broken or incomplete, compressed data in a base64 run that is itself longer than
a piece and inside unpacked data, and, where a caller sets `max_layer_bytes`,
layers above it, which are not scanned then.

Defined results: a null or empty text has no spans; rows that repeat are rows of
their own; an empty table gives an empty table. Input columns named like an
output column are replaced.
"""

from __future__ import annotations

import base64
import bz2
import lzma
import re
import zlib
from array import array
from bisect import bisect_right
from collections.abc import Callable, Iterable, Iterator
from contextlib import suppress
from hashlib import blake2b
from typing import NamedTuple
from urllib.parse import unquote_to_bytes

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chattermark.llm.frames import carry, restore

#: The kinds in their order, and their patterns. Letters of names are ASCII only.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
MIN_VALUE = 8

URL_ESCAPE = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
CODE_POINT = re.compile(
    r"\\u([0-9A-Fa-f]{4})|\\U([0-9A-Fa-f]{8})|\\u\{([0-9A-Fa-f]{1,6})\}|&#[xX]([0-9A-Fa-f]{1,6});|&#([0-9]{1,7});"
)
UNICODE_ESCAPE = re.compile(f"(?:{CODE_POINT.pattern.replace('(', '(?:')})+")
ESCAPES = {"url": (URL_ESCAPE, "%"), "unicode": (UNICODE_ESCAPE, "\\u", "\\U", "&#")}
BASE64_RUN = re.compile(r"[A-Za-z0-9+/_-]{16,}")
WRAPPED_RUN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+(?:\r?\n[ \t]*+[A-Za-z0-9+/_-]++)++")
LINE_OF_RUN = re.compile(r"[A-Za-z0-9+/_-]+")
#: How gzip, zlib, bzip2 and xz data begin, as bytes, under URL escapes and in base64.
PACKED = re.compile(rb"\x1f\x8b|\x78[\x01\x5e\x9c\xda]|BZh[1-9]1AY|\xfd7zXZ\0")
LONGEST_HEAD = 8
PACKED_URL = re.compile(r"""(?:%1[Ff]%8[Bb]|(?:x|%78)%(?:01|5[Ee]|9[Cc]|[Dd][Aa])|BZh[1-9]1AY%26SY|%[Ff][Dd]7zXZ%00)[^\s"'<>&]*""")
GLUED_PACKED = re.compile(r"(?<=[/_+-])(?:H4sI|eA[E-H]|eF[4-7]|eJ[w-z]|eN[o-r]|Qlpo[MNO]|/Td6)")
#: A shifted reading of base64 without one of these holds no secret and no further layer.
PRINTABLE = re.compile(rb"[\t\n\r\x20-\x7e]{12}")
WIDE = re.compile(rb"(?:[^\0]\0){8,}|(?:\0[^\0]){8,}")
#: Unpacked data is scanned in pieces of some megabytes, which overlap by far more than a secret's least length.
PIECE, OVERLAP, ALIGNED = 1 << 22, 1 << 16, 4**6
RUN_BYTES = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
URL_SAFE_BYTES = bytes.maketrans(b"-_", b"+/")
#: Packed bytes are fed in chunks of this size, so what is left of one is cheap to copy.
CHUNK = 1 << 16
#: What the decoder makes of a byte that is not UTF-8.
STRAY = re.compile(r"[\udc80-\udcff]")
UNPRINTABLE = re.compile(r"[\x00-\x08\x0e-\x1f\x7f]")
URL_SAFE = str.maketrans("-_", "+/")

SPAN = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("start", T.LongType()),
        T.StructField("end", T.LongType()),
        T.StructField("layers", T.StringType()),
    ]
)
FOUND = T.StructType(
    [
        T.StructField("base_spans", T.ArrayType(SPAN)),
        T.StructField("spans", T.ArrayType(SPAN)),
        T.StructField("n_layers", T.LongType()),
        T.StructField("n_unopened", T.LongType()),
    ]
)


DONE = object()


class Layer(NamedTuple):
    """A text, and where a span of it lies in the text it was found in; the original has no outer one."""

    text: str
    path: tuple[str, ...]
    outer: Layer | None = None
    place: Callable[[int, int], tuple[int, int]] | None = None
    is_text: bool = True

    def span(self, start: int, end: int) -> tuple[int, int]:
        layer = self
        while layer.outer is not None:
            start, end = layer.place(start, end)
            layer = layer.outer
        return start, end


def scan(text: str) -> Iterator[tuple[str, int, int]]:
    """(kind, start, end) of the secrets that stand in a text."""
    for m in ASSIGN.finditer(text):
        if len(m[2]) >= MIN_VALUE:
            yield "assign", m.start(), m.end()
    for kind, pattern in (("access", ACCESS), ("hex", HEX)):
        for m in pattern.finditer(text):
            yield kind, m.start(), m.end()


def _bytes_of_url(run: str) -> Iterator[tuple[str, int]]:
    """Characters of neighbouring URL escapes with the escaped length of each; stray bytes are Latin-1."""
    for char in bytes.fromhex(run.replace("%", "")).decode("utf-8", "surrogateescape"):
        if STRAY.match(char):
            yield chr(ord(char) - 0xDC00), 3
        else:
            yield char, 3 * len(char.encode())


def _units_of_unicode(run: str) -> Iterator[tuple[str, int]]:
    """Characters of neighbouring Unicode escapes with the escaped length of each; what is none is '?'."""
    high, waiting = 0, 0  # a high surrogate that its low one has yet to follow, and its escaped length
    for m in CODE_POINT.finditer(run):
        code = int(m[5]) if m[5] else int(m[1] or m[2] or m[3] or m[4], 16)
        if high:
            if 0xDC00 <= code < 0xE000:
                yield chr(0x10000 + ((high - 0xD800) << 10) + code - 0xDC00), waiting + len(m[0])
                high = 0
                continue
            yield "?", waiting
            high = 0
        if 0xD800 <= code < 0xDC00:
            high, waiting = code, len(m[0])
        else:
            yield "?" if 0xDC00 <= code < 0xE000 or code > 0x10FFFF else chr(code), len(m[0])
    if high:
        yield "?", waiting


def _unescaped(layer: Layer, kind: str) -> Iterator[Layer]:
    """The lines that hold escapes of one kind, with these replaced."""
    pattern, *marks = ESCAPES[kind]
    if not any(mark in layer.text for mark in marks):
        return
    read = _bytes_of_url if kind == "url" else _units_of_unicode
    at = 0
    for line in layer.text.split("\n"):
        if any(mark in line for mark in marks) and pattern.search(line):
            # Where a stretch begins here and there, and the length there of a character, 0 for plain text.
            here, there, lengths = array("q"), array("q"), array("q")
            out, size, done = [], 0, 0
            for m in pattern.finditer(line):
                if m.start() > done:
                    here.append(size), there.append(at + done), lengths.append(0)
                    out.append(line[done : m.start()])
                    size += m.start() - done
                done = m.start()
                for char, length in read(m[0]):
                    here.append(size), there.append(at + done), lengths.append(length)
                    out.append(char)
                    size, done = size + 1, done + length
            if done < len(line):
                here.append(size), there.append(at + done), lengths.append(0)
                out.append(line[done:])

            def place(start: int, end: int, here=here, there=there, lengths=lengths) -> tuple[int, int]:
                a, b = bisect_right(here, start) - 1, bisect_right(here, end - 1) - 1
                first = there[a] if lengths[a] else there[a] + start - here[a]
                last = there[b] + (lengths[b] or end - here[b])
                return first, last

            yield Layer("".join(out), (*layer.path, kind), layer, place)
        at += len(line) + 1


def _texts(outer: Layer, data: bytes, place: Callable, path: tuple[str, ...]) -> Iterator[Layer]:
    """Bytes as text, and their stretches of two-byte characters; `place` maps spans of bytes."""
    raw = data.decode("utf-8", "surrogateescape")
    stray = STRAY.search(raw) is not None
    text = STRAY.sub(lambda m: chr(ord(m[0]) - 0xDC00), raw) if stray else raw
    if not text:
        return
    chars = place
    if len(raw) != len(data):
        at: list[np.ndarray] = []

        def chars(start: int, end: int) -> tuple[int, int]:
            if not at:
                codes = np.frombuffer(raw.encode("utf-32-le", "surrogatepass"), dtype="<u4")
                width = 1 + (codes > 0x7F) + (codes > 0x7FF).astype("int64") + (codes > 0xFFFF)
                width[(codes >= 0xDC80) & (codes <= 0xDCFF)] = 1
                at.append(np.concatenate([[0], np.cumsum(width)]))
            return place(int(at[0][start]), int(at[0][end]))

    yield Layer(text, path, outer, chars, not stray and not UNPRINTABLE.search(text))
    if b"\0" in data:
        for m in WIDE.finditer(data):
            wide = m[0].replace(b"\0", b"").decode("latin-1")
            yield Layer(
                wide, (*path, "utf16"), outer,
                lambda start, end, at=m.start(): place(at + 2 * start, at + 2 * end),
                not UNPRINTABLE.search(wide),
            )


class _Zlib:
    """zlib and gzip with the interface of the other two decompressors."""

    def __init__(self) -> None:
        self.engine, self.rest = zlib.decompressobj(47), b""

    def decompress(self, data: bytes, most: int) -> bytes:
        out = self.engine.decompress(self.rest + data, most)
        self.rest = self.engine.unconsumed_tail
        return out

    @property
    def eof(self) -> bool:
        return self.engine.eof

    @property
    def unused_data(self) -> bytes:
        return self.engine.unused_data

    @property
    def needs_input(self) -> bool:
        return not self.rest


def _engine(head: bytes):
    if head.startswith(b"BZh"):
        return bz2.BZ2Decompressor()
    return lzma.LZMADecompressor(memlimit=1 << 28) if head.startswith(b"\xfd") else _Zlib()


def inflated(chunks: Iterable[bytes], piece: int) -> Iterator[bytes]:
    """What packed members that follow each other unpack to, in pieces; other bytes end them."""
    try:
        yield from _members(chunks, piece)
    except (OSError, EOFError, lzma.LZMAError) as broken:
        raise zlib.error(str(broken)) from broken


def _members(chunks: Iterable[bytes], piece: int) -> Iterator[bytes]:
    engine, held = None, b""
    for chunk in _ended(chunks):
        last = chunk is None
        for i in range(0, 1 if last else len(chunk), CHUNK):
            held += b"" if last else chunk[i : i + CHUNK]
            while held:
                if engine is None:
                    if len(held) < LONGEST_HEAD and not last:
                        break
                    if not PACKED.match(held):
                        return
                    engine = _engine(held)
                given, held = held, b""
                while True:
                    out = engine.decompress(given, piece)
                    given = b""
                    if out:
                        yield out
                    if engine.eof or (engine.needs_input and len(out) < piece):
                        break
                if engine.eof:
                    held, engine = engine.unused_data.lstrip(b"\0"), None
    if engine is not None:
        raise zlib.error("incomplete")


def _ended(chunks: Iterable[bytes]) -> Iterator[bytes | None]:
    yield from chunks
    yield None


def _whole(chunks: Iterable[bytes]) -> Iterator[bytes]:
    """What can be unpacked of chunks before an error."""
    with suppress(zlib.error):
        yield from chunks


def _overlapping(chunks: Iterable[bytes], piece: int) -> Iterator[tuple[bytes, bool]]:
    """Pieces of a long layer, and whether the cut after it splits compressed data in base64.

    A piece ends in what the next one begins with: a base64 run that goes on, or
    a part of it that is decoded alike if the run is longer than a piece.
    """
    held, overlap = b"", min(OVERLAP, piece)
    for chunk in chunks:
        held += chunk
        if len(held) < 2 * piece + overlap:
            continue
        run = len(held.rstrip(RUN_BYTES))
        if len(held) - run <= piece:
            keep = min(run, len(held) - overlap)
            yield held, False
        else:
            # Cut where a multiple of ALIGNED digits is behind, so deeper base64 stays in step too.
            keep = run + (len(held) - overlap - run) // ALIGNED * ALIGNED
            head = held[run : run + 12].translate(URL_SAFE_BYTES)
            yield held, len(head) == 12 and PACKED.match(base64.b64decode(head)) is not None
        held = held[keep:]
    if held:
        yield held, False


def _opened(
    outer: Layer, data: bytes, span: tuple[int, int], path: tuple[str, ...], most: int | None
) -> Iterator[Layer | None]:
    """Texts of compressed bytes, unpacked as often as needed; None for what can't be read.

    What a level unpacks to is never held whole: it is unpacked once to be
    measured and again to be scanned.
    """
    chunks, head, seen = (lambda: iter([data])), data[:LONGEST_HEAD], {blake2b(data).digest()}
    while PACKED.match(head):
        inner = lambda chunks=chunks: inflated(chunks(), PIECE)
        head, size, digest = b"", 0, blake2b()
        try:
            for piece in inner():
                head = head if len(head) >= LONGEST_HEAD else (head + piece[:LONGEST_HEAD])[:LONGEST_HEAD]
                size += len(piece)
                digest.update(piece)
                if most is not None and size > most:
                    yield None
                    return
        except zlib.error:
            yield None
        if not size or digest.digest() in seen:
            return
        seen.add(digest.digest())
        chunks, path = (lambda inner=inner: _whole(inner())), (*path, "compressed")
        for piece, split in _overlapping(chunks(), PIECE):
            yield from _texts(outer, piece, lambda start, end: span, path)
            if split:
                yield None


def _from_url_bytes(layer: Layer, most: int | None) -> Iterator[Layer | None]:
    """Texts in compressed bytes that are written as URL escapes; a plus is a blank or itself."""
    if "%" not in layer.text:
        return
    for m in PACKED_URL.finditer(layer.text):
        for run in sorted({m[0], m[0].replace("+", " ")}):
            yield from _opened(layer, unquote_to_bytes(run), m.span(), (*layer.path, "url"), most)


def _from_base64(layer: Layer, most: int | None) -> Iterator[Layer | None]:
    """Texts in base64 runs, joined over single line breaks and alone."""
    joined = set()
    for m in WRAPPED_RUN.finditer(layer.text):
        lines = [x.span() for x in LINE_OF_RUN.finditer(layer.text, *m.span())]
        data = yield from _run(layer, lines, most, True)
        if PACKED.match(data):
            joined.add(m.start())
    for m in BASE64_RUN.finditer(layer.text):
        yield from _run(layer, [m.span()], most, m.start() not in joined)
        for shift in range(1, 4):
            yield from _run(layer, [(m.start() + shift, m.end())], most, True, shifted=True)
        for glued in GLUED_PACKED.finditer(layer.text, m.start() + 4, m.end()):
            data = _decoded(layer.text[glued.start() : m.end()])
            for inner in _opened(layer, data, (glued.start(), m.end()), (*layer.path, "base64"), most):
                if inner is not None:
                    yield inner


def _decoded(digits: str) -> bytes:
    digits = digits[: len(digits) - (len(digits) % 4 == 1)]
    return base64.b64decode(digits.translate(URL_SAFE) + "=" * (-len(digits) % 4))


def _run(
    layer: Layer, lines: list[tuple[int, int]], most: int | None, unpack: bool, shifted: bool = False
) -> Iterator[Layer | None]:
    """Texts in one base64 run, given by the spans of its lines; returns its bytes.

    What a shifted reading takes for the head of compressed data is mostly chance, so it does not
    count as unopened.
    """
    digits = "".join(layer.text[a:b] for a, b in lines)
    data = _decoded(digits)
    if shifted and not (PACKED.match(data) or PRINTABLE.search(data) or b"\0" in data and WIDE.search(data)):
        return data
    path, before = (*layer.path, "base64"), array("q", [0])
    for a, b in lines[:-1]:
        before.append(before[-1] + b - a)

    def there(digit: int) -> int:
        k = bisect_right(before, digit) - 1
        return lines[k][0] + digit - before[k]

    def place(start: int, end: int) -> tuple[int, int]:
        return there(start * 8 // 6), there((end * 8 - 1) // 6) + 1

    yield from _texts(layer, data, place, path)
    if unpack and PACKED.match(data):
        whole = there(0), there(len(digits) - (len(digits) % 4 == 1) - 1) + 1
        for inner in _opened(layer, data, whole, path, most):
            if inner is not None or not shifted:
                yield inner
    return data


def _children(layer: Layer, most: int | None) -> Iterator[Layer | None]:
    for kind in ESCAPES:
        yield from _unescaped(layer, kind)
    yield from _from_url_bytes(layer, most)
    yield from _from_base64(layer, most)


def unwrap(text: str, max_layer_bytes: int | None = None) -> tuple[list, list, int, int]:
    """Base spans, all spans with the layers they lie under, and how many layers were opened or not."""
    order = {kind: i for i, kind in enumerate(KINDS)}
    found: dict[tuple[str, int, int], str] = {}
    seen, opened, unopened = set(), 0, 0
    base: list = []
    # Depth first, so that pieces of a long layer come one after the other.
    work: list[Iterator[Layer | None]] = [iter([Layer(text, ())])]
    while work:
        layer = next(work[-1], DONE)
        if layer is DONE:
            work.pop()
            continue
        if layer is None:
            unopened += 1
            continue
        if layer.path:
            place = (*layer.span(0, len(layer.text)), blake2b(layer.text.encode("utf-8", "surrogatepass")).digest())
            if place in seen:
                continue
            seen.add(place)
        holds = False
        for kind, start, end in scan(layer.text):
            holds = True
            found.setdefault((kind, *layer.span(start, end)), ">".join(layer.path))
        if not layer.path:
            base = list(found)
        else:
            opened += layer.is_text or holds
        work.append(_children(layer, max_layer_bytes))
    placed = sorted(found, key=lambda s: (s[1], order[s[0]], s[2]))
    return (
        [(*s, "") for s in sorted(base, key=lambda s: (s[1], order[s[0]], s[2]))],
        [(*s, found[s]) for s in placed],
        opened,
        unopened,
    )


def find_secrets(documents: DataFrame, *, max_layer_bytes: int | None = None) -> DataFrame:
    """`documents` with `base_spans`, `spans`, `n_layers` and `n_unopened`.

    A span is (kind, start, end, layers): `layers` names the wrappings, outermost
    first, and is empty for a secret that stands in the text itself.
    """

    @F.pandas_udf(FOUND)
    def scanned(texts: pd.Series) -> pd.DataFrame:
        names = ("kind", "start", "end", "layers")
        rows = []
        for text in texts:
            base, spans, layers, unopened = unwrap(text or "", max_layer_bytes)
            as_dicts = [[dict(zip(names, s, strict=True)) for s in x] for x in (base, spans)]
            rows.append((*as_dicts, layers, unopened))
        return pd.DataFrame(rows, columns=FOUND.names)

    done = carry(documents, found=scanned("text"))
    return restore(done, **{name: F.col(f"found.{name}") for name in FOUND.names})
