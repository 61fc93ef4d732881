"""Katz scores against a model written out with dictionaries."""

import math
import random
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from chattermark.llm import katz
from chattermark.llm.packing import pack, pack_sorted, smallest, unpack, unpack_sorted


def held():
    return F.col("doc_id") % 4 == 0


def words_of(text):
    return (text or "").encode().lower().split()


class Plain:
    """The same model from its definition, over tuples of words."""

    def __init__(self, training, order):
        self.order = order
        self.counts = [Counter() for _ in range(order + 1)]
        for text in training:
            sequence = ["<s>", *words_of(text), "</s>"]
            for i in range(1, len(sequence)):
                for m in range(1, min(order, i + 1) + 1):
                    self.counts[m][tuple(sequence[i - m + 1 : i + 1])] += 1
        self.total = sum(self.counts[1].values())
        self.history = [Counter() for _ in range(order + 1)]
        for m in range(2, order + 1):
            for gram, c in self.counts[m].items():
                self.history[m][gram[:-1]] += c
        self.factors = [None]
        for m in range(1, order + 1):
            n = Counter(self.counts[m].values())
            self.factors.append(katz.good_turing([n[r] for r in range(1, katz.LARGEST + 2)]))
        self.followers = [defaultdict(set) for _ in range(order + 1)]
        for m in range(2, order + 1):
            for gram in self.counts[m]:
                self.followers[m][gram[:-1]].add(gram[-1])
        self.weights = {}

    def discounted(self, m, gram):
        c = self.counts[m][gram]
        factor = self.factors[m][c - 1] if c <= katz.LARGEST else katz.KEPT_ABOVE
        return factor * c / (self.total if m == 1 else self.history[m][gram[:-1]])

    def unseen(self):
        return 1 - sum(self.discounted(1, g) for g in self.counts[1]) if self.total else 1.0

    def probability(self, gram):
        m = len(gram)
        if self.counts[m][gram]:
            return self.discounted(m, gram)
        if m == 1:
            return self.unseen()
        return self.weight(gram[:-1]) * self.probability(gram[1:])

    def weight(self, history):
        if history not in self.weights:
            m = len(history) + 1
            if not self.history[m][history]:
                return 1.0
            seen = self.followers[m][history]
            left = 1 - sum(self.discounted(m, (*history, w)) for w in seen)
            self.weights[history] = left / (1 - sum(self.probability((*history[1:], w)) for w in seen))
        return self.weights[history]

    def score(self, text):
        sequence = ["<s>", *words_of(text), "</s>"]
        return sum(
            math.log10(self.probability(tuple(sequence[max(0, i - self.order + 1) : i + 1])))
            for i in range(1, len(sequence))
        )

    def base(self, text):
        below = self.total + 0.1 * (len(self.counts[1]) + 1)
        return sum(math.log10((self.counts[1][(t,)] + 0.1) / below) for t in [*words_of(text), "</s>"])


def check(texts_table, rows, order, **options):
    model = Plain([t for i, t, *_ in rows if i is None or i % 4], order)
    found = katz.katz_scores(texts_table, held(), order=order, **options).collect()
    assert len(found) == len(rows)
    left = sorted((r.doc_id is not None, r.doc_id or 0, r.score, r.base_score, r.n_tokens) for r in found)
    right = sorted(
        (i is not None, i or 0, model.score(t), model.base(t), len(words_of(t)) + 1) for i, t, *_ in rows
    )
    for a, b in zip(left, right, strict=True):
        assert a[:2] == b[:2] and a[4] == b[4]
        assert a[2] == pytest.approx(b[2], rel=1e-9) and a[3] == pytest.approx(b[3], rel=1e-9)
    assert {r.train_tokens for r in found} == {model.total}
    by_id = {r.doc_id: r for r in found}
    for i, t, *_ in rows:
        if i is not None:
            assert by_id[i].held_out == (i % 4 == 0)
    return model


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_equal_the_definition(texts, order):
    r = random.Random(order)
    words = [f"w{int(r.expovariate(0.15))}" for _ in range(4000)]
    rows = [(i, " ".join(words[r.randrange(3900) :][: r.randrange(60)])) for i in range(1, 80)]
    rows += [(100, "never met words here"), (101, None), (102, ""), (104, None), (105, "W1  w2\tW1\n"), (None, "w1 w2 w9")]
    model = check(texts(*rows), rows, order, chunk_tokens=300, part_tokens=500)
    vocabulary = [w for (w,) in model.counts[1]]
    for m in range(2, order + 1):
        for history in list(model.followers[m])[:40]:
            total = sum(model.probability((*history, w)) for w in [*vocabulary, "<unseen>"])
            assert total == pytest.approx(1, abs=1e-9)


def test_whole_table(documents):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    check(documents, rows, 2)


def test_layout_does_not_matter(texts):
    rows = [(i, f"a b c d{i % 7} e f{i % 3}") for i in range(40)]
    table = texts(*rows)
    one = katz.katz_scores(table.coalesce(1), held()).orderBy("doc_id").toPandas()
    many = katz.katz_scores(table.repartition(7), held(), chunk_tokens=20).orderBy("doc_id").toPandas()
    assert np.allclose(one["score"], many["score"], rtol=1e-12)


def test_empty_table_and_no_training_rows(texts):
    assert katz.katz_scores(texts(), held()).count() == 0
    found = katz.katz_scores(texts((0, "x y"), (4, None)), held()).orderBy("doc_id").collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in found] == [
        (3, 0, 0, 0.0, 0.0),
        (1, 0, 0, 0.0, 0.0),
    ]


def test_packing_round_trip():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 2**63, 1000, dtype="uint64"))
    for values in (keys, rng.random(10), np.array([], dtype="int32"), smallest(np.arange(300))):
        assert (unpack(pack(values)) == values).all() and unpack(pack(values)).dtype == values.dtype
    assert (unpack_sorted(pack_sorted(keys)) == keys).all()
    assert len(unpack_sorted(pack_sorted(keys[:0]))) == 0


def test_a_chunk_takes_few_bytes_a_token():
    r = np.random.default_rng(3)
    words = np.unique(r.integers(0, 2**63, 50_000, dtype="uint64"))
    lengths = np.full(400, 500, dtype="int32")
    tokens = r.integers(0, len(words), int(lengths.sum())).astype("uint32")
    packed = {
        "chunk": 1, "ids": pack(np.arange(400)), "has_id": pack(np.ones(400, "uint8")),
        "held_out": pack(np.zeros(400, "uint8")), "lengths": pack(lengths),
        "words": pack_sorted(words), "tokens": pack(tokens),
    }
    none = katz.Known(pd.DataFrame({"kind": [], "part": []}))
    tracemalloc.start()
    try:
        katz.count_requests(2, 4)(pd.Series(packed), none)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 75 * len(tokens)


def test_values_are_numbered_in_order():
    r = np.random.default_rng(4)
    for n in (0, 1, 2, 1000):
        values = r.integers(0, 50, n).astype("uint64") << np.uint64(58)
        keys, numbers = katz.numbered(values)
        expected = np.unique(values, return_inverse=True)
        assert (keys == expected[0]).all() and (numbers == expected[1]).all()
