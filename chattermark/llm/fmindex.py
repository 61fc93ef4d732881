"""Words within one edit, by search schemes over a bidirectional FM-index.

The words of a vocabulary stand between delimiters in one text, in code-point order.
Suffixes are ranked once, up to the delimiter that ends their word; equal ones keep the order of their
words. That order is also the order of the delimiters by the word that follows them, so
extending a match over a delimiter gives the right interval, and its rank names the word.
A second index holds the reversed words, so a match, kept as an interval of suffix
ranks in both, grows to either side.

A query is split in two halves. One error leaves one half whole: each half is matched
exactly and the match extended across the other half with one insertion, deletion or
replacement anywhere in it. All queries of a batch take every step together, as arrays.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

DELIMITER = 0  # rank of the delimiter among symbols


class Ranks:
    """Suffix ranks of delimited words in one direction, with how often each symbol precedes them."""

    def __init__(self, words: list[np.ndarray], n_symbols: int) -> None:
        lengths = np.array([len(w) for w in words], dtype="int64")
        text = np.full(int(lengths.sum()) + len(words) + 1, DELIMITER, dtype="int64")
        starts = np.cumsum(np.append(0, lengths + 1))[:-1] + 1
        inside = np.ones(len(text), dtype=bool)
        inside[np.append(starts - 1, len(text) - 1)] = False
        text[inside] = np.concatenate(words) if words else []
        self.n_symbols = n_symbols
        order = self._order(text)
        before = text[order - 1]  # the first delimiter is preceded by the last one
        marks = np.zeros((len(text) + 1, n_symbols), dtype="int32")
        marks[np.arange(1, len(text) + 1), before] = 1
        self.preceded = np.cumsum(marks, axis=0, dtype="int32")
        counts = np.bincount(text, minlength=n_symbols)
        self.first = np.cumsum(np.append(0, counts))[:-1]
        self.size = len(text)

    @staticmethod
    def _order(text: np.ndarray) -> np.ndarray:
        """Positions by the suffix up to and including the next delimiter, then by position."""
        rank = text.copy()
        ended = np.cumsum(text == DELIMITER)
        n = len(text)
        # Delimiters rank by place, so ranks are final where one is reached. The last opens
        # no word; seen as a ring, it precedes the first, and so ranks lowest.
        rank = np.where(text == DELIMITER, ended % int(ended[-1]), text + int(ended[-1]))
        width = 1
        while True:
            ahead = np.zeros(n, dtype="int64")
            ahead[: n - width] = rank[width:] + 1
            ahead[text == DELIMITER] = 0
            order = np.lexsort((ahead, rank))
            new = np.empty(n, dtype="int64")
            step = (np.diff(rank[order]) != 0) | (np.diff(ahead[order]) != 0)
            new[order] = np.append(0, np.cumsum(step))
            rank = new
            if rank.max() == n - 1:
                return order
            width *= 2

    def counts(self, low: np.ndarray, size: np.ndarray) -> np.ndarray:
        """How many suffixes of each interval each symbol precedes: (interval, symbol)."""
        return self.preceded[low + size] - self.preceded[low]

    def step(self, low: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        return self.first[symbol] + self.preceded[low, symbol]


@dataclass
class States:
    """Matches under way: rows of a query, the interval in both indexes, and the next position."""

    query: np.ndarray
    own: np.ndarray  # low end in the index that the match grows in
    other: np.ndarray
    size: np.ndarray
    at: np.ndarray  # symbols of the query consumed

    def __getitem__(self, chosen: np.ndarray) -> States:
        return States(*(getattr(self, f)[chosen] for f in self.__dataclass_fields__))

    @staticmethod
    def joined(parts: list[States]) -> States:
        return States(
            *(np.concatenate([getattr(p, f) for p in parts]) for f in States.__dataclass_fields__)
        )


class FmIndex:
    """A vocabulary of distinct words, given in code-point order."""

    def __init__(self, words: list[str]) -> None:
        self.words = words
        symbols = sorted(set().union(*words)) if words else []
        self.symbol_of = {c: i + 1 for i, c in enumerate(symbols)}
        coded = [self.coded(w) for w in words]
        n = len(symbols) + 1
        backwards = sorted((w[::-1] for w in words))
        self.forward = Ranks(coded, n)
        self.reverse = Ranks([self.coded(w) for w in backwards], n)

    def coded(self, word: str) -> np.ndarray:
        """Ranks of a word's symbols; those the vocabulary lacks are -1."""
        return np.array([self.symbol_of.get(c, -1) for c in word], dtype="int64")

    def near(self, queries: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(query, word) of all words one edit away, each pair once."""
        both = np.concatenate([self._search(queries, first=True), self._search(queries, first=False)])
        pairs = np.unique(both)
        n = max(len(self.words), 1)
        return pairs // n, pairs % n

    def sharing_half(self, queries: list[str], first: bool) -> tuple[np.ndarray, np.ndarray]:
        """(query, word) of the words one edit away that have the query's first (or last) half whole."""
        pairs = self._search(queries, first)
        n = max(len(self.words), 1)
        return pairs // n, pairs % n

    def _search(self, queries: list[str], first: bool) -> np.ndarray:
        """Pairs (as query * words + word) whose first (or last) half matches exactly."""
        own, other = (self.reverse, self.forward) if first else (self.forward, self.reverse)
        coded = [self.coded(q if first else q[::-1]) for q in queries]
        lengths = np.array([len(c) for c in coded], dtype="int64")
        halves = lengths // 2 if first else lengths - lengths // 2
        table = np.full((len(queries), int(lengths.max(initial=0)) + 1), -1, dtype="int64")
        table[np.arange(table.shape[1]) < lengths[:, None]] = np.concatenate(coded or [[]])

        n = len(queries)
        everything = np.full(n, own.size)
        begin = States(np.arange(n), np.zeros(n, int), np.zeros(n, int), everything, np.zeros(n, int))
        # The half is matched towards the word's edge and on over the delimiter, in the other index.
        exact = self._turned(begin)
        exact.at = halves.copy()
        for _ in range(int(halves.max(initial=0))):
            going = exact.at > 0
            moved = exact[going]
            symbol = table[moved.query, moved.at - 1]
            moved = self._grown(moved, symbol, other)
            moved.at -= 1
            exact = States.joined([exact[~going], moved])
        exact = self._grown(exact, np.zeros(len(exact.query), int), other)
        exact = self._turned(exact)
        exact.at = halves[exact.query]

        wrong: list[States] = []
        found: list[np.ndarray] = []
        n_words = max(len(self.words), 1)
        while len(exact.query) or wrong:
            fresh = []
            if len(exact.query):
                fresh, exact = self._one_error(exact, table, lengths, own)
            states = States.joined([*wrong, *fresh]) if wrong or fresh else exact
            # Those at the end of their query are closed by a delimiter; the rest go on exactly.
            done = states.at == lengths[states.query]
            closed = self._grown(states[done], np.zeros(int(done.sum()), int), own)
            low = closed.other if first else closed.own
            found.append(closed.query * n_words + low - 1)
            states = states[~done]
            if len(states.query):
                states = self._grown(states, table[states.query, states.at], own)
                states.at = states.at + 1
            wrong = [states] if len(states.query) else []
        pairs = np.unique(np.concatenate(found)) if found else np.empty(0, dtype="int64")
        same = np.array([self.words[int(p % n_words)] == queries[int(p // n_words)] for p in pairs], dtype=bool)
        return pairs[~same]

    @staticmethod
    def _turned(states: States) -> States:
        return States(states.query, states.other, states.own, states.size, states.at)

    @staticmethod
    def _grown(states: States, symbol: np.ndarray, index: Ranks) -> States:
        """States whose match can take one more symbol, after taking it."""
        counts = index.counts(states.own, states.size)
        known = np.maximum(symbol, 0)
        rows = np.arange(len(symbol))
        size = np.where(symbol >= 0, counts[rows, known], 0)
        smaller = np.cumsum(counts, axis=1)[rows, known] - counts[rows, known]
        kept = size > 0
        return States(
            states.query[kept],
            index.step(states.own[kept], known[kept]),
            states.other[kept] + smaller[kept],
            size[kept],
            states.at[kept],
        )

    @staticmethod
    def _one_error(
        exact: States, table: np.ndarray, lengths: np.ndarray, index: Ranks
    ) -> tuple[list[States], States]:
        """States after one error here, and the exact ones after one more symbol."""
        counts = index.counts(exact.own, exact.size)
        below = np.cumsum(counts, axis=1) - counts
        state, symbol = np.nonzero(counts)
        letter = symbol != DELIMITER
        state, symbol = state[letter], symbol[letter]
        took = States(
            exact.query[state],
            index.step(exact.own[state], symbol),
            exact.other[state] + below[state, symbol],
            counts[state, symbol].astype("int64"),
            exact.at[state],
        )
        next_symbol = table[took.query, took.at]
        inside = took.at < lengths[took.query]
        matches = inside & (symbol == next_symbol)
        replaced = took[inside & ~matches]
        replaced.at = replaced.at + 1
        onward = took[matches]
        onward.at = onward.at + 1
        skipped = exact[exact.at < lengths[exact.query]]
        skipped = States(skipped.query, skipped.own, skipped.other, skipped.size, skipped.at + 1)
        return [took, replaced, skipped], onward
