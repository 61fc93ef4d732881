"""Groups against all pairs compared by brute force."""

import random
import re
import tracemalloc

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from chattermark.llm import cells, jaccardjoin, shingles
from chattermark.llm.components import components
from chattermark.llm.jaccardjoin import keep_one_of_each, prefix_length, similar_groups
from chattermark.llm.shingles import lowered_words, shingle_sets, word_hashes


def plain_set(text, k):
    w = lowered_words(text)
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def plain_groups(rows, k, percent):
    sets = [plain_set(t, k) for _, t in rows]
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                group[root(i)] = root(j)
    members = {}
    for i, (doc_id, _) in enumerate(rows):
        members.setdefault(root(i), []).append(doc_id)
    smallest = {g: min((x for x in ids if x is not None), default=None) for g, ids in members.items()}
    return sorted(((d, len(sets[i]), smallest[root(i)]) for i, (d, _) in enumerate(rows)), key=str)


def found_groups(df, k=4, percent=85, **options):
    rows = similar_groups(df, k=k, percent=percent, **options).collect()
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in rows), key=str)


def edited(r, words, share):
    out = list(words)
    for _ in range(int(share * len(out))):
        out[r.randrange(len(out))] = f"x{r.randrange(10_000)}"
    return out


@pytest.mark.parametrize(("k", "percent"), [(4, 85), (5, 80), (1, 60)])
def test_same_as_brute_force(texts, k, percent):
    r = random.Random(k)
    rows = []
    for _ in range(25):
        words = [f"w{int(r.expovariate(0.02))}" for _ in range(r.choice([3, 6, 9, 20, 80, 150]))]
        for _ in range(r.randrange(1, 7)):
            words = edited(r, words, r.choice([0, 0, 0.01, 0.03, 0.06]))
            rows.append((len(rows) * 3, " ".join(words)))
    passage = " ".join(f"p{i}" for i in range(40))
    rows += [(1000 + i, f"{passage} " + " ".join(f"q{r.randrange(5000)}" for _ in range(40))) for i in range(30)]
    rows += [(5000, None), (5001, ""), (5002, " \t\n"), (5003, "one"), (5004, "ONE"), (5005, "one two"), (5003, "one"), (None, "one two")]
    r.shuffle(rows)
    assert found_groups(texts(*rows), k, percent) == plain_groups(rows, k, percent)


def test_chains_cross_components(texts):
    # Neighbours in the chain are similar, its ends are not.
    base = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join([f"n{j}" for j in range(4 * i)] + base[4 * i :])) for i in range(12)]
    assert found_groups(texts(*rows)) == plain_groups(rows, 4, 85)
    assert len({g for _, _, g in plain_groups(rows, 4, 85)}) == 1


def test_small_sketch_changes_nothing(texts):
    rows = [(i, " ".join(f"w{(i // 3) * 50 + j + (j == 7) * i}" for j in range(60))) for i in range(30)]
    assert found_groups(texts(*rows), sketch_bits=3) == plain_groups(rows, 4, 85)


def test_large_groups_make_few_pairs(spark, texts):
    r = random.Random(9)
    words = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join(edited(r, words, 0.004))) for i in range(400)]
    made = []
    original = jaccardjoin.verified

    def counted(pairs, *args, **options):
        made.append(pairs.count())
        return original(pairs, *args, **options)

    jaccardjoin.verified = counted
    try:
        groups = found_groups(texts(*rows))
    finally:
        jaccardjoin.verified = original
    assert {g for _, _, g in groups} == {0}
    assert sum(made) < 400 * 400 / 4


def test_prefix_filter_is_exact():
    r = random.Random(4)
    for _ in range(300):
        a = np.unique(np.array([r.randrange(2**63) for _ in range(r.randrange(1, 60))], dtype="uint64"))
        keep = a[np.array([r.random() < 0.95 for _ in a])]
        b = np.unique(np.concatenate([keep, np.array([r.randrange(2**63) for _ in range(r.randrange(4))], dtype="uint64")]))
        if len(b) and 100 * len(np.intersect1d(a, b)) >= 85 * len(np.union1d(a, b)):
            assert all(jaccardjoin.share_prefix(a, b, 85, seed) for seed in (1, 2, 3))
    assert prefix_length(1, 85) == 1 and prefix_length(100, 85) == 16


def test_components(spark):
    links = [(1, 2), (2, 3), (5, 4), (9, 9), (3, 1), (10, 11), (11, 12), (12, 13), (13, 14), (14, 15), (15, 16)]
    df = spark.createDataFrame(links, "a long, b long")
    found = {r.node: r.component for r in components(df).collect()}
    assert found == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 9: 9} | {n: 10 for n in range(10, 17)}
    assert components(df.where("a > 99")).count() == 0


def test_cells_add_up(spark):
    def counted(batches):
        total = np.zeros(1 << 15, dtype="int64")
        for batch in batches:
            np.add.at(total, batch["id"].to_numpy() % (1 << 15), 1)
        yield cells.packed_blocks(total)

    rows = spark.range(0, 100_000, 1, 7).mapInPandas(counted, cells.SCHEMA)
    expected = np.bincount(np.arange(100_000) % (1 << 15))
    assert (cells.gathered(rows, 1 << 15) == expected).all()
    assert cells.gathered(rows.where("block < 0"), 8).tolist() == [0] * 8


def test_shingles():
    assert lowered_words("É ÀB\x0bC\x85d") == ["É".encode(), "Àb".encode(), "c\x85d".encode()]
    sets = [len(s) for s in shingle_sets(["a b c d e a b c d", None, "", "a b", "\t\n"], 4)]
    assert sets == [5, 0, 0, 1, 0]
    one, two = shingle_sets(["a b", "b a"], 4)
    assert one[0] != two[0]


def test_word_hashes_tell_words_apart_and_equal_ones_together():
    r = random.Random(6)
    alphabet = "abAB01é"
    texts = [" ".join("".join(r.choice(alphabet) for _ in range(r.choice([1, 2, 3, 8, 70, 200]))) for _ in range(r.randrange(40))) for _ in range(400)]
    texts += [None, "", " x ", "\x0bx\x0c", "x" * 3_000_000 + " y", "ab" * 40, "ba" * 40]
    known = {}
    for text, found in zip(texts, word_hashes(texts), strict=True):
        words = lowered_words(text)
        assert len(words) == len(found)
        for word, value in zip(words, found.tolist(), strict=True):
            assert known.setdefault(word, value) == value
    assert len(set(known.values())) == len(known)


def test_one_of_each_stays(texts):
    base = " ".join(f"w{i}" for i in range(50))
    rows = [(3, base), (2, base), (2, base), (7, base + " more"), (8, "other words here now then"), (9, None), (9, None), (None, ""), (None, "lonely text without id")]
    df = texts(*rows).withColumns({"Node": F.lit("old"), "key": F.lit(1), "copy": F.lit(2)})
    kept = keep_one_of_each(df)
    assert kept.columns == df.columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    assert got == sorted([(2, base), (8, rows[4][1]), (9, None), (9, None), (None, ""), (None, rows[8][1])], key=str)
    assert keep_one_of_each(texts()).count() == 0


def test_bad_threshold(texts):
    with pytest.raises(ValueError, match="percent"):
        similar_groups(texts(), percent=40)


def test_parities_bound_what_sets_differ_in():
    r = np.random.default_rng(5)
    sets = []
    for size in (1, 3, 60, 64, 65, 120, 130, 500, 513, 600):
        base = np.unique(r.integers(0, 2**63, size, dtype="uint64"))
        for change in (0, 0.02, 0.1, 0.3):
            new = r.integers(0, 2**63, max(1, int(change * size)), dtype="uint64")
            sets += [np.unique(np.append(base[r.random(len(base)) >= change], new)), base]
    known = [s for s in sets if jaccardjoin.parity(s, 85) is not None]
    parities = jaccardjoin.Parities([jaccardjoin.parity(s, 85) for s in known], np.array([len(s) for s in known]), 85)
    left, right = (x.reshape(-1) for x in np.meshgrid(np.arange(len(known)), np.arange(len(known))))
    apart = parities.apart(left, right)
    near = 0
    for i, j, cells_apart in zip(left, right, apart, strict=True):
        common = len(np.intersect1d(known[i], known[j]))
        if 100 * common >= 85 * (len(known[i]) + len(known[j]) - common):
            near += 1
            assert 0 <= cells_apart <= len(known[i]) + len(known[j]) - 2 * common
    assert near > len(known) and (apart >= 0).sum() < 1.5 * near


def test_groups_of_texts_alike_but_not_enough_make_few_pairs(texts):
    r = random.Random(12)
    words = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join(edited(r, words, 0.02))) for i in range(200)]
    made = []
    original = jaccardjoin.verified

    def counted(pairs, *args, **options):
        made.append(pairs.count())
        return original(pairs, *args, **options)

    jaccardjoin.verified = counted
    try:
        groups = found_groups(texts(*rows))
    finally:
        jaccardjoin.verified = original
    assert groups == plain_groups(rows, 4, 85)
    assert sum(made) < 3 * len(rows)


def test_blocks_of_large_buckets_are_compared_whole(texts, monkeypatch):
    monkeypatch.setattr(jaccardjoin, "BLOCK", 4)
    monkeypatch.setattr(jaccardjoin, "ACROSS", 7)
    monkeypatch.setattr(jaccardjoin, "HUBS", 1)
    r = random.Random(13)
    rows = []
    for g in range(6):
        words = [f"g{g}w{i}" for i in range(100)]
        rows += [(len(rows) + i, " ".join(edited(r, words, r.choice([0.01, 0.03, 0.05])))) for i in range(20)]
    assert found_groups(texts(*rows)) == plain_groups(rows, 4, 85)


def test_word_hashes_hold_little_at_once(monkeypatch):
    monkeypatch.setattr(shingles, "POWERS", shingles.Powers())
    text = " ".join(f"word{i}" for i in range(200))
    tracemalloc.start()
    try:
        assert sum(len(h) for h in word_hashes(text for _ in range(2000))) == 200 * 2000
        assert tracemalloc.get_traced_memory()[1] < 16 << 20
    finally:
        tracemalloc.stop()


@pytest.mark.parametrize("nearest", [False, True])
def test_pairs_of_cells_are_those_of_brute_force(nearest):
    r = random.Random(9)
    base = [r.sample(range(2000), 60) for _ in range(4)]
    sets = [np.sort(np.array(r.choice(base)[: r.randrange(54, 61)] + r.sample(range(2000, 9000), 3), dtype="uint64")) for _ in range(40)]
    parities = [jaccardjoin.parity(s, 80) for s in sets]
    rows = pd.DataFrame(
        [(c, 100 + i, 0, r.random() < 0.7, len(sets[i]), parities[i]) for c in range(6) for i in r.sample(range(40), 25)],
        columns=["cell", "node", "component", "leads", "n", "parity"],
    )
    rows["component"] = rows["node"] % 5
    both = jaccardjoin.Parities(parities, np.array([len(s) for s in sets]), 80)
    wanted = {}
    for _, own in rows.groupby("cell"):
        for a in own.itertuples():
            for b in own.itertuples():
                apart = int(both.apart(np.array([a.node - 100]), np.array([b.node - 100]))[0])
                if a.node < b.node and a.component != b.component and (a.leads or b.leads) and apart >= 0:
                    wanted[a.node, b.node] = apart
    assert len(wanted) > 40
    found = jaccardjoin.near_in_cells(80, nearest)(rows.sample(frac=1, random_state=1))
    given = [(x.hub, x.node, x.apart) for x in found.itertuples()]
    if not nearest:
        assert sorted((min(a, b), max(a, b), apart) for a, b, apart in given) == sorted((*x, n) for x, n in wanted.items())
        return
    least = {}
    for (a, b), apart in wanted.items():
        for x in (a, b):
            least[x] = min(least.get(x, apart), apart)
    assert {node: apart for _, node, apart in given} == least and len(given) == len(least)
    assert all(wanted[min(a, b), max(a, b)] == apart for a, b, apart in given)


def test_no_rows_of_cells_make_no_pairs():
    rows = pd.DataFrame({c: [] for c in ("cell", "node", "component", "leads", "n", "parity")})
    one = pd.DataFrame({"cell": [1], "node": [2], "component": [2], "leads": [True], "n": [9], "parity": [bytes(8)]})
    for given in (rows.astype({"node": "int64", "cell": "int64"}), one):
        for nearest in (False, True):
            assert len(jaccardjoin.near_in_cells(80, nearest)(given)) == 0


def test_filter_of_keys_keeps_all_that_are_wanted(spark):
    wanted = [-(2**63), -5, 0, 7, 7, 64, 2**40, 2**63 - 1]
    rows = [(k, f"t{k}") for k in [*wanted, *range(1000, 6000)]]
    keys, given = spark.createDataFrame([(k,) for k in wanted], "key long"), spark.createDataFrame(rows, "key long, text string")
    for bits, most in ((16, 30), (8, 300), (3, len(rows))):
        found = [tuple(r) for r in jaccardjoin.may_be_among(given, keys, bits).collect()]
        assert set(found) <= set(rows) and len(found) <= len(wanted) + most
        assert sorted(k for k, _ in found if k not in range(1000, 6000)) == sorted(wanted)
    assert jaccardjoin.may_be_among(given, keys.limit(0), 16).count() == 0


def test_no_task_chains_python_operators_on_texts(texts):
    docs = texts(*[(i, " ".join(f"g{i % 3}w{j}" for j in range(60)) + f" x{i}") for i in range(9)])
    nodes = jaccardjoin.document_sets(docs, 4, 85, 10).where("node is not null").select("doc_id", "n_shingles", "node")
    pairs = nodes.alias("l").join(nodes.alias("r"), F.col("l.doc_id") + 3 == F.col("r.doc_id")).select(
        F.col("l.node").alias("hub"), F.col("r.node").alias("node")
    )
    found = jaccardjoin.verified(pairs, docs, nodes, k=4, percent=85)
    assert found.count() == 6
    # A task holds a worker for each Python operator of its stage, and an executor keeps them all.
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert re.findall(r"\w+InPandas|\w+EvalPython", plan) == ["FlatMapGroupsInPandas", "MapInPandas"]
