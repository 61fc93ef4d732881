"""Restores obfuscated words: a Viterbi search through a lattice of characters.

The noisy channel writes letters as look-alike symbols, stretches letters, and
puts blanks or marks between them. What is observed spans a lattice: a symbol
may stand for letters or for itself, a repeated letter for one or two, a mark or
blank for a word end or for nothing. Look-alikes at the ends of a token are
letters or nothing; a token of look-alikes alone is a word where that is likelier
than a number. A character trigram model, counted over
all documents, tells how likely a reading is; the channel adds its costs.

A token of distinct neighbouring letters has one reading and is not searched.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Letters each symbol may stand for.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b",
    "9": "g", "@": "a", "$": "s", "!": "il", "+": "t", "|": "il", "€": "e", "(": "c", "£": "l",
}
MARKS = ".-_*~·'’`^"
EDGES = ".,;:!?\"'()[]{}<>|#%&*~`^-_=+/\\"
#: Look-alikes that also stand beside words: often at one end, seldom elsewhere.
BESIDE = "!|+($@€£"
USUAL_FIRST, USUAL_LAST = "(", "!"
#: What is no part of a word at its ends, whatever it may look like.
OUTSIDE = "".join(c for c in EDGES if c not in LOOKALIKES)
LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(chr(c) for c in range(0xDF, 0x100) if c != 0xF7)
END, OTHER = len(LETTERS), len(LETTERS) + 1
SIZE = OTHER + 1
INDEX = {c: i for i, c in enumerate(LETTERS)}

#: Costs of the channel, as log probabilities.
SUBSTITUTED, KEPT, STRETCHED, SKIPPED, SPLIT, GAP = -1.5, -8.0, -5.0, -0.7, -2.5, -0.7
#: A symbol beside a word where it is seldom seen; a symbol of a number.
UNUSUAL, NUMERAL = -4.5, -4.0
DOUBLED = re.compile(r"(.)\1", re.DOTALL)
#: Texts whose words are held at once when trigrams are counted.
TEXTS = 1000


def count_trigrams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Counts of the trigrams in letter-only tokens of all batches."""
    table = np.full(0x100, OTHER)
    table[[ord(c) for c in LETTERS]] = np.arange(len(LETTERS))
    table[ord("\n")] = END
    total = np.zeros(SIZE**3, dtype="int64")
    for texts in (b["text"].iloc[i : i + TEXTS] for b in batches for i in range(0, len(b), TEXTS)):
        words = Counter()
        for text in texts:
            words.update((text or "").lower().split())
        kept = [(w, n) for w, n in ((w.strip(EDGES), n) for w, n in words.items()) if w.isalpha()]
        if not kept:
            continue
        line = "\n" + "\n".join(w for w, _ in kept) + "\n"
        codes = np.frombuffer(line.encode("utf-32-le"), dtype="<u4")
        symbols = np.where(codes < 0x100, table[np.minimum(codes, 0xFF)], OTHER)
        times = np.repeat([n for _, n in kept], [len(w) + 1 for w, _ in kept])
        before = np.concatenate([[END], symbols[:-2]])
        middle, after = symbols[:-1], symbols[1:]
        before = np.where(middle == END, END, before)
        gram = (before * SIZE + middle) * SIZE + after
        total += np.bincount(gram, weights=times, minlength=SIZE**3).astype("int64")
    seen = np.flatnonzero(total)
    yield pd.DataFrame({"gram": seen, "n": total[seen]})


def trigram_counts(documents: DataFrame) -> DataFrame:
    """(gram, n): character trigrams in all texts, numbered; at most SIZE ** 3 rows."""
    counted = documents.select("text").mapInPandas(count_trigrams, "gram long, n long")
    return counted.groupBy("gram").agg(F.sum("n").alias("n"))


def log_model(counts: Iterable[tuple[int, int]]) -> np.ndarray:
    """log P(c | a b) as an array of SIZE x SIZE x SIZE, each order smoothed with the one below."""
    n = np.zeros(SIZE**3)
    for gram, times in counts:
        n[gram] = times
    n = n.reshape(SIZE, SIZE, SIZE)
    below = np.full(SIZE, 1.0 / SIZE)
    for level in (n.sum((0, 1)), n.sum(0), n):
        weight = (level > 0).sum(-1, keepdims=True) + 1.0  # Witten-Bell: types seen after the context
        below = (level + weight * below) / (level.sum(-1, keepdims=True) + weight)
    return np.log(below)


def inner_part(observed: str) -> tuple[int, int]:
    """Where the part without symbols at both ends begins and ends."""
    around = EDGES + "$@€£ "
    return len(observed) - len(observed.lstrip(around)), len(observed.rstrip(around))


def _options(observed: str, i: int, inner: tuple[int, int] | None = None) -> list[tuple[str, float]]:
    """What the observed character may stand for, with the channel's cost."""
    char = observed[i]
    out: list[tuple[str, float]] = []
    if char == " ":
        return [("", GAP), (" ", SPLIT)]
    if char in LOOKALIKES:
        out += [(letter, SUBSTITUTED) for letter in LOOKALIKES[char]]
    if char in BESIDE:
        first, last = inner or inner_part(observed)
        if i < first or i >= last:
            usual = char == (USUAL_FIRST if i < first else USUAL_LAST)
            out.append(("", SKIPPED if usual else UNUSUAL))
    if char in MARKS:
        out += [("", SKIPPED), (" ", SPLIT)]
    elif char.isalpha():
        out.append((char, 0.0))
    else:
        out.append((" ", KEPT))
    if i and observed[i - 1] == char:
        out.append(("", STRETCHED))
    return out


def best_reading(observed: str, model: np.ndarray | list) -> str:
    """The likeliest text behind a run of characters; its words are parted by blanks."""
    return scored_reading(observed, model)[1]


def scored_reading(observed: str, model: np.ndarray | list) -> tuple[float, str]:
    """Log probability and text of the likeliest reading; time is linear in the length of the run."""
    # Each state keeps its score and a chain of what was emitted, last first.
    states: dict[tuple[int, int], tuple[float, tuple | None]] = {(END, END): (0.0, None)}
    rows = model.tolist() if isinstance(model, np.ndarray) else model
    inner = inner_part(observed)
    for i, char in enumerate(observed):
        reached: dict[tuple[int, int], tuple[float, tuple | None]] = {}
        if char.isalpha() and not (i and observed[i - 1] == char):  # a letter that stands for itself alone
            symbol = INDEX.get(char, OTHER)
            for (a, b), (score, chain) in states.items():
                value = score + rows[a][b][symbol]
                old = reached.get((b, symbol))
                if old is None or value > old[0]:
                    reached[b, symbol] = value, (chain, char)
            states = reached
            continue
        for emitted, cost in _options(observed, i, inner):
            symbol = END if emitted == " " else INDEX.get(emitted, OTHER)
            for (a, b), (score, chain) in states.items():
                if not emitted:
                    state, value = (a, b), score + cost
                elif symbol == END and b == END:
                    state, value = (END, END), score + cost
                else:
                    state = (END, END) if symbol == END else (b, symbol)
                    value = score + cost + rows[a][b][symbol]
                old = reached.get(state)
                if old is None or value > old[0]:
                    reached[state] = (value, (chain, emitted) if emitted else chain)
        states = reached
    ends = [(score + (0.0 if b == END else rows[a][b][END]), chain) for (a, b), (score, chain) in states.items()]
    best = max(score for score, _ in ends)
    return best, max(_text(chain) for score, chain in ends if score == best)


def _text(chain: tuple | None) -> str:
    out = []
    while chain is not None:
        chain, emitted = chain
        out.append(emitted)
    return "".join(reversed(out))


def single_character(token: str) -> str:
    """The character of a token that has just one beside a mark at its end, or nothing."""
    if len(token) == 1 or len(token) == 2 and token[1] in EDGES:
        return token[0]
    return ""


def is_plain(token: str) -> bool:
    """Whether a token has one reading only: letters, none next to its like."""
    return token.isalpha() and DOUBLED.search(token) is None


class Restorer:
    """Restores the words of texts; keeps readings of tokens, up to a number of them."""

    def __init__(self, model: np.ndarray, keep: int = 100_000) -> None:
        # Plain floats: a search adds up single ones, for which arrays are slow.
        self.model, self.keep, self.known = model.tolist(), keep, {}

    def token(self, token: str) -> tuple[str, ...]:
        """Words behind a lower-case token without blanks."""
        core = token.strip(OUTSIDE)
        if is_plain(core):
            return (core,)
        if not any(map(str.isalpha, core)):
            return self.symbols(core)
        return tuple(best_reading(core, self.model).split())

    def symbols(self, core: str) -> tuple[str, ...]:
        """Words behind look-alikes alone, where they are likelier than a number."""
        if not core or any(c not in LOOKALIKES for c in core):
            return ()
        score, text = scored_reading(core, self.model)
        words = tuple(text.split())
        return words if len(words) == 1 and score > NUMERAL * len(core) else ()

    def words(self, text: str) -> Iterator[str]:
        """The restored words of a text; three or more single characters in a row are read together."""
        for part in self.parts(text):
            yield from self.spaced(part) if isinstance(part, list) else self.remembered(part)

    def parts(self, text: str) -> list[str | list[str]]:
        """Tokens of a text; neighbouring single characters come as one list."""
        tokens = text.lower().split()
        out, done, last = [], 0, -2
        for i in [i for i, token in enumerate(tokens) if len(token) < 3 and single_character(token)]:
            if i > last + 1:
                out += tokens[done:i]
                out.append([])
            out[-1].append(tokens[i][0])
            done, last = i + 1, i
        out += tokens[done:]
        return out

    def remembered(self, token: str) -> tuple[str, ...]:
        words = self.known.get(token)
        if words is None:
            if len(self.known) >= self.keep:
                self.known.clear()
            words = self.known[token] = self.token(token)
        return words

    def spaced(self, single: list[str]) -> list[str]:
        if len(single) < 3:
            return [c for c in single if c.isalpha()]
        return best_reading(" ".join(single), self.model).split()
