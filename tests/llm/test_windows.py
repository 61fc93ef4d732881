"""Packing: exact round trips, the cheapest cuts against all cuts, ids against the other library."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from chattermark.llm import queries, windows
from chattermark.llm.tokens import pieces, vocabulary

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def plain_cost(charge, ends, most):
    total = begin = 0
    for end in ends:
        total += windows.padding(end - begin, most) + windows.WINDOW + max(int(charge[end - 1]), 0)
        begin = end
    return total


def least_cost(charge, most):
    """By trying every window, without a queue."""
    n = len(charge)
    cost = [0] + [float("inf")] * n
    for j in range(1, n + 1):
        if charge[j - 1] < 0 and j < n:
            continue
        for i in range(max(0, j - most), j):
            price = cost[i] + windows.padding(j - i, most) + windows.WINDOW + max(int(charge[j - 1]), 0)
            cost[j] = min(cost[j], price)
    return cost[n]


@pytest.mark.parametrize("seed", range(8))
def test_cuts_are_the_cheapest(seed):
    rng = np.random.default_rng(seed)
    most = int(rng.choice([16, 64]))
    charge = rng.choice([-1, -1, -1, 0, 4, 48], size=700)
    charge[most - 5 :: most // 2] = 48
    ends = windows.cuts(charge, most)
    assert ends[-1] == len(charge) and max(np.diff([0, *ends])) <= most
    assert plain_cost(charge, ends, most) == least_cost(charge, most)


def test_cuts_of_short_stretches():
    assert windows.cuts(np.array([0])) == [1]
    assert windows.cuts(np.array([-1, -1, -1])) == [3]


@pytest.mark.parametrize("power, expected", [(1, 0), (512, 0), (1024, 0), (3, 1021), (1000, 24)])
def test_padding(power, expected):
    assert windows.padding(power) == expected


def test_places_to_cut_are_never_far_apart():
    ends = np.zeros(5000, dtype=bool)
    ends[[10, 2000]] = True
    at = np.flatnonzero(windows.charges(np.arange(1, 5001) == 5000, ends) >= 0)
    assert max(np.diff([-1, *at])) <= windows.GRID
    assert windows.charges(np.ones(3, dtype=bool), np.ones(3, dtype=bool)).tolist() == [0, 0, 0]


def unpacked(rows):
    """Ids of each document from its pieces, after checking the sequences."""
    by_sequence = {}
    for row in rows:
        assert len(row.ids) == 4 * row.length and row.length > 0
        by_sequence.setdefault(row.sequence_id, []).append((row.offset, row.length))
    for placed in by_sequence.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= windows.LENGTH
    documents = {}
    for row in sorted(rows, key=lambda r: (r.doc_key, r.start)):
        ids = documents.setdefault(row.doc_key, [])
        assert row.start == len(ids)
        ids += np.frombuffer(bytes(row.ids), "<u4").tolist()
        assert len(ids) <= row.doc_tokens
    for row in rows:
        assert len(documents[row.doc_key]) == row.doc_tokens
    return documents, by_sequence


def test_every_id_lies_in_one_piece(spark, tokenizer):
    rng = random.Random(1)
    words = ["alpha", " beta.", "\n\n", "gamma?", "x" * 90, "<|endoftext|>", " 中文", "Été ", "!", "12 345"]
    texts = [None, "", "a"] + ["".join(rng.choice(words) for _ in range(rng.randint(1, 900))) for _ in range(40)]
    texts += ["word " * 60_000, "é" * 5_000, texts[5], texts[5]]
    table = spark.createDataFrame(
        [(i, i % 3 or None, t, "s", 1) for i, t in enumerate(texts)],
        "doc_key long, doc_id long, text string, start string, carried_row int",
    )
    rows = windows.pack(table, PATH).collect()
    documents, by_sequence = unpacked(rows)
    assert set(documents) == set(range(len(texts)))
    for key, ids in documents.items():
        assert ids == [*tokenizer.encode(texts[key] or "", add_special_tokens=False).ids, 0]
    assert rows[0].carried_row == 1
    lengths = [sum(n for _, n in placed) for placed in by_sequence.values()]
    assert sum(map(windows.padding, lengths)) < 0.02 * sum(lengths)


def test_order_of_documents_is_kept(spark):
    table = spark.createDataFrame([(i, f"Sentence {i}. " * (i % 50)) for i in range(300)], "doc_key long, text string")
    rows = windows.pack(table.coalesce(1), PATH).collect()
    placed = sorted(rows, key=lambda r: (r.sequence_id, r.offset))
    assert [(r.doc_key, r.start) for r in placed] == sorted((r.doc_key, r.start) for r in placed)


def test_long_streams_are_packed_in_stretches(tokenizer):
    words = vocabulary(PATH)
    rng = random.Random(2)
    stream = windows.Stream(words, stretch=1)
    documents = []
    out = []
    for i in range(60):
        text = " ".join(f"Some words here {rng.randint(0, 99)}." for _ in range(rng.choice([1, 40, 400, 9000])))
        documents.append(np.append(words.ids(text), np.uint32(0)))
        out += stream.add(i, documents[-1])
        assert stream.size <= stream.stretch
    out += stream.windows()
    again = np.concatenate([ids for window in out for _, _, ids in window])
    assert (again == np.concatenate(documents)).all()
    assert all(sum(len(p[2]) for p in window) <= windows.LENGTH for window in out)


def test_empty_table(spark):
    assert windows.pack(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []


def test_both_libraries_give_the_same_ids(documents, tokenizer):
    words = vocabulary(PATH)
    texts = [r.text or "" for r in documents.select("text").collect()]
    rng = random.Random(0)
    odd = [chr(c) for c in (*range(0x250), 0x1680, 0x180E, 0x2003, 0x2028, 0x200B, 0xFEFF, 0x661, 0xB2, 0x4E2D, 0x1F600, 0x300)]
    texts += ["".join(rng.choice([rng.choice(odd), " ", "\n", "ab", "'s", "<|endoftext|>"]) for _ in range(60)) for _ in range(400)]
    for text, expected in zip(texts, tokenizer.encode_batch(texts, add_special_tokens=False), strict=True):
        assert words.ids(text).tolist() == expected.ids
        cut = [i for p in pieces(text, 16) for i in words.encoding.encode(p, allowed_special="all")]
        assert cut == expected.ids


def test_registered_query(spark, tmp_path, tokenizer):
    texts = [(7, "One. Two. " * 500), (8, None), (None, "tail")]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    rows = queries.op13_packing(spark, str(tmp_path)).collect()
    ids = [*tokenizer.encode(texts[0][1], add_special_tokens=False).ids, 0]
    for row in rows:
        if row.doc_id == 7:
            part = np.array(ids[row.start : row.start + row.length], dtype="<u4")
            assert row.ids_crc32 == zlib.crc32(part.tobytes()) and row.doc_tokens == len(ids)
    assert sum(r.length for r in rows if r.doc_id == 7) == len(ids)
