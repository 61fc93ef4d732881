"""Planted passages against the edit distance itself."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from chattermark.llm import decontamination as d
from chattermark.llm.frames import read_table

LETTERS = "abcdefghijklmnopqrstuvwxyz "
SF_DIR = "/root/testdata/sf0.001"


def sentence(r, n):
    return " ".join("".join(r.choice(LETTERS[:26]) for _ in range(r.randrange(2, 9))) for _ in range(n))


def edited(r, text, k):
    out = list(text)
    for _ in range(k):
        at, kind = r.randrange(len(out)), r.random()
        if kind < 0.4:
            out[at] = r.choice(LETTERS)
        elif kind < 0.7:
            del out[at]
        else:
            out.insert(at, r.choice(LETTERS))
    return "".join(out)


def plain_nearest(item, region):
    """Smallest edit distance of the item to any part of the region, cell by cell."""
    row = [0] * (len(region) + 1)
    for i, a in enumerate(item, 1):
        last, row = row, [i]
        for j, b in enumerate(region, 1):
            row.append(min(last[j - 1] + (a != b), last[j] + 1, row[j - 1] + 1))
    return min(row)


@pytest.fixture
def benchmark(spark):
    def build(*rows):
        return spark.createDataFrame(list(rows), "item_id long, text string")

    return build


def test_bit_vectors_give_the_edit_distance():
    r = random.Random(1)
    for _ in range(200):
        item = "".join(r.choice("abc ") for _ in range(r.randrange(1, 90)))
        region = edited(r, "xx" + item + "yy", r.randrange(12)) if r.random() < 0.7 else sentence(r, 9)
        found, end = d.nearest(d.pattern_bits(item), len(item), region)
        assert found == plain_nearest(item, region)
        assert found == len(item) or plain_nearest(item, region[:end]) == found


def test_recall_and_precision(texts, benchmark):
    r = random.Random(2)
    items = [(i, sentence(r, r.randrange(10, 60))) for i in range(60)]
    rows, planted = [], {}
    for i in range(240):
        text = sentence(r, r.randrange(20, 120))
        if i % 2:
            item_id, item = r.choice(items)
            k = int(len(item) * r.choice([0, 0.03, 0.06, 0.1]))
            passage = edited(r, item, k)
            text = f"{sentence(r, 15)} {passage.upper()}\n\n {sentence(r, 15)}"
            planted[i] = item_id
        rows.append((i, text))
    found = d.contaminated(texts(*rows), benchmark(*items)).collect()
    by_doc = {r.doc_id: r.item_id for r in found}
    assert set(by_doc) <= set(planted) and all(planted[i] == x for i, x in by_doc.items())
    assert len(by_doc) >= 0.95 * len(planted)
    text_of, item_of = dict(rows), dict(items)
    for row in found:
        item = d.normal(item_of[row.item_id])
        part = d.normal(text_of[row.doc_id][row.start : row.end])
        assert row.edits == plain_nearest(item, part) <= 0.1 * len(item)
        assert row.similarity == pytest.approx(1 - row.edits / len(item))


def test_all_exact_copies_are_found(spark):
    documents, items = read_table(spark, SF_DIR, "documents"), read_table(spark, SF_DIR, "benchmark")
    wanted = {
        (r.doc_id, i.item_id)
        for r in documents.collect()
        for i in items.collect()
        if d.normal(i.text) in d.normal(r.text)
    }
    found = {(r.doc_id, r.item_id) for r in d.contaminated(documents, items).collect()}
    assert wanted and wanted <= found
    left = {r.doc_id for r in d.clean(documents, items).collect()}
    assert left == {r.doc_id for r in documents.collect()} - {i for i, _ in found}


def test_blocks_of_items_change_nothing(texts, benchmark):
    r = random.Random(3)
    items = [(i, sentence(r, 30)) for i in range(12)]
    rows = [(i, f"{sentence(r, 30)} {items[i % 12][1]} {sentence(r, 30)}") for i in range(24)]
    one = d.contaminated(texts(*rows), benchmark(*items)).collect()
    many = d.contaminated(texts(*rows), benchmark(*items), block_chars=400, piece_chars=300).collect()
    assert sorted(one) == sorted(many) and len(one) == 24


def test_more_classes_than_bits(texts, benchmark):
    r = random.Random(4)
    items = [(i, sentence(r, int(4 * 1.2**i))) for i in range(22)]
    rows = [(i, f"start {text} end") for i, text in items]
    found = d.contaminated(texts(*rows), benchmark(*items)).collect()
    assert {(i, i) for i, _ in items} <= {(r.doc_id, r.item_id) for r in found}


def test_odd_rows(texts, benchmark):
    r = random.Random(5)
    item = sentence(r, 25)
    long = f"{sentence(r, 30_000)} {item} {sentence(r, 10)}"
    items = benchmark((1, item), (2, item), (3, None), (4, ""), (None, "  "), (5, "ab"))
    df = texts((1, None), (2, ""), (3, item), (3, item), (None, f"x {item}"), (4, long), (5, "é " * 50))
    df = df.withColumns({"Matches": F.lit("old"), "items": F.lit(1)})
    found = d.with_matches(df, items)
    assert [c for c in found.columns if c.lower() == "matches"] == ["matches"]
    hits = sorted((r.doc_id or 0, sorted(m.item_id for m in r.matches if m.item_id < 5)) for r in found.collect())
    assert hits == [(0, [1, 2]), (1, []), (2, []), (3, [1, 2]), (3, [1, 2]), (4, [1, 2]), (5, [])]
    row = found.where("doc_id = 4").collect()[0]
    assert [(m.start, m.end) for m in row.matches if m.item_id == 1] == [(long.index(item), long.index(item) + len(item))]


def test_empty_tables(texts, benchmark):
    assert d.contaminated(texts(), benchmark((1, "some item text"))).count() == 0
    assert d.clean(texts((1, "a"), (2, None)), benchmark()).count() == 2


def test_passages_need_no_blank_before_them(texts, benchmark):
    r = random.Random(6)
    script = [chr(c) for c in range(0x4E00, 0x5200)]
    scripts = lambda n: "".join(r.choice(script) for _ in range(n))
    items = [(1, scripts(60)), (2, sentence(r, 20)), (3, scripts(120))]
    changed = edited(r, items[2][1], 6)
    rows = [
        (1, scripts(3000) + items[0][1] + scripts(500)),
        (2, f"see https://example.org/{'x/' * 300}{items[1][1]} end"),
        (3, scripts(900) + changed + scripts(700)),
        (4, scripts(2000)),
    ]
    found = {(x.doc_id, x.item_id): x for x in d.contaminated(texts(*rows), benchmark(*items)).collect()}
    assert set(found) == {(1, 1), (2, 2), (3, 3)}
    assert found[1, 1].edits == found[2, 2].edits == 0 and found[3, 3].edits <= 6


def test_rows_are_those_of_a_search_at_every_start(texts, benchmark):
    r = random.Random(7)
    items = [(i, sentence(r, r.randrange(14, 26))) for i in range(6)]
    rows = [(i, sentence(r, 60)) for i in range(10)]
    for i in range(24):
        item = items[i % 6][1]
        part = edited(r, item, round(len(item) * 0.02 * (i % 4)))
        rows.append((10 + i, f"{sentence(r, 12)} {part} {sentence(r, 12)} {item[: len(item) // 2]} {sentence(r, 5)}"))
    wanted = {
        (doc_id, item_id)
        for doc_id, text in rows
        for item_id, item in items
        if plain_nearest(item, text) <= int(0.1 * len(item))
    }
    found = {(x.doc_id, x.item_id) for x in d.contaminated(texts(*rows), benchmark(*items)).collect()}
    assert found == wanted and len(wanted) == 24


def test_repeated_grams_are_no_match(texts, benchmark):
    r = random.Random(8)
    item = sentence(r, 20)
    rows = [(1, item[:12] * 40), (2, (item[:12] + "x") * 9 + item), (3, "a" * 500)]
    found = d.contaminated(texts(*rows), benchmark((1, item), (2, "a" * 60))).collect()
    assert {(x.doc_id, x.item_id) for x in found} == {(2, 1), (3, 2)}


def test_filters_on_matches_search_only_once(texts, benchmark):
    found = d.contaminated(texts((1, "a b c")), benchmark((1, "a b")))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_texts_with_few_of_the_q_grams_of_an_item():
    item = sentence(random.Random(11), 25)
    settings = {
        "max_edits": 0.1, "recall": 0.99, "agreement": 0.55, "positions": 5, "walks": 3, "cell_bits": 21, "seed": 42,
    }
    block = d.Block([(1, item)], settings)
    least = block.classes[0].least
    for n in range(least + 8):  # n characters hold n - 7 of the q-grams, no window enough of them
        assert block.classes[0].windows(d.np.arange(n)).size == 0 or n >= least
        found = block.matches([item[:n], "", item[-n:] if n else ""])
        assert all(m[3] <= len(item) // 10 for matches in found for m in matches)
    assert [m[0] for m in block.matches([item])[0]] == [1]


def test_a_table_of_one_short_quotation(texts, benchmark):
    item = sentence(random.Random(12), 25)
    found = d.contaminated(texts((1, item[: len(item) // 3])), benchmark((7, item)))
    assert found.count() == 0


def test_walks_read_what_a_single_walk_reads():
    r = random.Random(3)
    item, text = sentence(r, 14), sentence(r, 60)
    settings = {
        "max_edits": 0.1, "recall": 0.99, "agreement": 0.55, "positions": 5, "walks": 2, "cell_bits": 12, "seed": 42,
    }
    c = d.Block([(1, item)], settings).classes[0]
    buffer, starts = d.folded(d.codes_of(text)), np.arange(0, 150, 7)
    padded = np.append(buffer, np.repeat(buffer[-1:], c.low + 1)).tolist()

    def key(coins, table, start):
        seen, at = [], start
        for step in range(2 * c.low):
            seen.append(padded[at] if at < start + c.low else 0)
            at += int(coins[step][seen[-1]])
        key = 7
        for p in table:
            key = (key ^ seen[p]) * int(d.MULTIPLIER) % 2**64
            key ^= key >> 29
        return key

    wanted = [[key(coins, table, s) for s in starts.tolist()] for coins, tables in c.walks for table in tables.tolist()]
    assert [keys.tolist() for keys in c.keys(buffer, starts)] == wanted


def test_q_grams_of_a_buffer_are_numbered_once(monkeypatch):
    r = random.Random(5)
    item = sentence(r, 12)
    settings = {
        "max_edits": 0.1, "recall": 0.99, "agreement": 0.55, "positions": 5, "walks": 3, "cell_bits": 21, "seed": 42,
    }
    block, calls, cells = d.Block([(1, item)], settings), [], d.Block.cells
    monkeypatch.setattr(d.Block, "cells", staticmethod(lambda *given: calls.append(1) or cells(*given)))
    found = block.matches([f"{sentence(r, 9)} {edited(r, item, i % 3)} end" for i in range(20)])
    assert sum(map(len, found)) >= 18
    assert len(calls) == len(block.tables)


def test_q_grams_count_only_where_a_passage_has_them():
    r = random.Random(13)
    parts = ["".join(r.choice(LETTERS[:26]) for _ in range(30)) for _ in range(10)]
    item, turned = "".join(parts), "".join(parts[::-1])
    settings = {
        "max_edits": 0.05, "recall": 0.99, "agreement": 0.55, "positions": 5, "walks": 3, "cell_bits": 21, "seed": 42,
    }
    block = d.Block([(1, item)], settings)

    def walked(text):
        buffer = np.concatenate([np.zeros(400, "uint8"), d.folded(d.codes_of(text)), np.zeros(400, "uint8")])
        return sum(len(found[-2]) for found in block.likely(buffer, buffer != 0))

    # Enough of the q-grams, but none near its place but those of two parts.
    assert walked(turned) == 0
    assert 0 < walked(item) <= 6 * 15 + 1
    for edits in range(16):
        text = sentence(r, 9) + edited(r, item, edits) + sentence(r, 9)
        assert [m[0] for m in block.matches([text])[0]] == [1]


def test_q_grams_are_marked_across_steps(monkeypatch):
    r = random.Random(14)
    item = sentence(r, 20)
    settings = {
        "max_edits": 0.1, "recall": 0.99, "agreement": 0.55, "positions": 5, "walks": 3, "cell_bits": 21, "seed": 42,
    }
    block = d.Block([(1, item)], settings)
    q, cells, _ = block.tables[0]
    buffer = d.folded(d.codes_of(f"{sentence(r, 9)} {item} {sentence(r, 9)} {item * 2}"))
    every = d.Block.cells(buffer, q, len(cells))
    monkeypatch.setattr(d, "STEP", 7)
    for n in [*range(q + 2), len(buffer)]:
        places, found = block.marked(buffer[:n], q, cells)
        assert places.tolist() == np.flatnonzero(cells[every[: max(0, n - q + 1)]]).tolist()
        assert found.tolist() == every[places].tolist()
