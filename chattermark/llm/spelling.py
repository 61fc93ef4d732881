"""Spelling variants: words one edit from a much more frequent word take its form.

Words are counted over whole texts. Two words are near if one insertion, deletion or
replacement of a code point turns one into the other. A word's form is its most
frequent near word (ties: the first in code-point order) if that occurs at least
`ratio` times as often; following forms to the last gives the word's root.

Near words are found by search schemes over FM-indexes (`fmindex`): half a word matches
exactly, and the match is extended across the other half with one error. A vocabulary
is too large for one index, so it is dealt out by the halves themselves: a word meets
the words that share its first half, and those that share its last half. Words of the
neighbouring lengths cut their halves elsewhere, so a word stands under the cuts of
three lengths, six rows in all, whatever the vocabulary's size. Many halves share one
index of some thousand words. Each pair is counted under one route only: the first half if
it is shared, else the last.

A half that more than `most` rows share is cut again: what lies between the shared ends
is halved, and the error is in one part or in the other, so each row of such a key moves to two
keys with longer shared ends. This goes on until at most one code point is left between
the ends; no more than the square of the alphabet's size can share those. No pair is lost and
no group is compared with itself.

Work: the vocabulary is staged, keys are shuffled as narrow rows, pairs are counted where
they are found and never written. Forms are followed by doubling; a form occurs at least
twice as often, so a chain is as long as the logarithm of the greatest count.

Results for unusual rows:
* null and empty texts hold no words; a null id counts as an empty one for slips;
* repeated rows count again; other columns of the table are not read;
* an empty table, or one without words frequent enough, gives an empty result;
* a word without near words has itself as root, null as form and 0 as `n_near`;
* words of equal counts: neither is the other's form.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chattermark.llm.fmindex import FmIndex
from chattermark.sources.staging import stage

#: Letters of a word, and those that are lower-cased.
LETTERS = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rows an index is built for on average, and rows that may share a key.
INDEX_ROWS = 1 << 14
#: Two free letters out of ninety between shared ends make fewer.
MOST = 1 << 15
DEPTHS = 8


def word_counts(documents: DataFrame, slips: int | None = None, shortest: int = 5, fewest: int = 3) -> DataFrame:
    """(word, n) of all words of the texts with `shortest` code points and `fewest` occurrences.

    Only A to Z are lower-cased. With `slips`, a document misspells every word whose
    digest with the document's id is a multiple of it: one code point, chosen by the
    digest too, is left out of all its occurrences there.
    """
    runs = documents.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"),
        F.explode(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(LETTERS), F.lit(0))).alias("run"),
    ).where(F.length("run") >= shortest)
    words = runs.select("doc_id", F.translate("run", UPPER, LOWER).alias("word"))
    if slips:
        digest = F.crc32(F.concat("doc_id", F.lit(":"), "word"))
        words = words.select("word", digest.alias("digest"))
        at = (F.col("digest") % F.length("word")).cast("int")
        left_out = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.length("word")))
        words = words.select(
            F.when(F.col("digest") % slips == 0, left_out).otherwise(F.col("word")).alias("word")
        ).where(F.length("word") >= shortest)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= fewest)


def routes(words: DataFrame) -> DataFrame:
    """A row for every half a word may share: with words of its own length and one more or less.

    `cut_length` is the length of the word that asks, `head` and `tail` what is shared of it.
    """
    length = F.length("word")
    cuts = words.select(
        "word", "n", F.explode(F.array(length - 1, length, length + 1)).alias("cut_length")
    )
    half = F.floor(F.col("cut_length") / 2).cast("int")
    sides = F.array(
        F.struct(F.lit(True).alias("first"), half.alias("head"), F.lit(0).alias("tail")),
        F.struct(
            F.lit(False).alias("first"), F.lit(0).alias("head"), (F.col("cut_length") - half).alias("tail")
        ),
    )
    placed = cuts.select("*", F.explode(sides).alias("side")).select(
        "word", "n", "cut_length", "side.first", "side.head", "side.tail", F.lit(1).alias("depth")
    )
    # The whole of a shorter word can be the half of no longer one.
    return _keyed(placed.where(F.col("head") + F.col("tail") <= F.length("word")))


def longer_ends(rows: DataFrame) -> DataFrame:
    """Routes with what lies between the shared ends halved: the error is in either part."""
    between = F.col("cut_length") - F.col("head") - F.col("tail")
    part = F.floor(between / 2).cast("int")
    sides = F.array(
        F.struct((F.col("head") + part).alias("head"), F.col("tail").alias("tail")),
        F.struct(F.col("head").alias("head"), (F.col("tail") + between - part).alias("tail")),
    )
    placed = rows.select("*", F.explode(sides).alias("side")).select(
        "word", "n", "cut_length", "first", "side.head", "side.tail", (F.col("depth") + 1).alias("depth")
    )
    return _keyed(placed)


def _keyed(rows: DataFrame) -> DataFrame:
    head = F.substring("word", F.lit(1), F.col("head"))
    tail = F.substring("word", F.length("word") - F.col("tail") + 1, F.col("tail"))
    return rows.withColumn("key", F.xxhash64("first", "depth", "head", "tail", head, tail))


def dealt(words: DataFrame, most: int = MOST) -> DataFrame:
    """All routes, with longer shared ends where more than `most` rows share a key."""
    rows = routes(words)
    done: DataFrame | None = None
    for _ in range(DEPTHS):
        can_be_cut = F.col("cut_length") - F.col("head") - F.col("tail") > 1
        shared = rows.groupBy("key").agg(
            F.count(F.lit(1)).alias("sharing"), F.max(can_be_cut).alias("longer")
        )
        crowded = stage(shared.where(F.col("sharing") > most).where("longer").select("key"), "crowded")
        if not crowded.limit(1).count():
            break
        stay = rows.join(crowded, "key", "left_anti").unionByName(
            rows.join(crowded, "key", "left_semi").where(~can_be_cut)
        )
        done = stay if done is None else done.unionByName(stay)
        rows = longer_ends(rows.join(crowded, "key", "left_semi").where(can_be_cut))
    return rows if done is None else done.unionByName(rows)


def route_of(word: str, near: str, depth: int) -> tuple[int, int]:
    """Shared ends under which a pair of near words is counted after `depth` cuts."""
    head, tail = 0, 0
    for _ in range(depth):
        between = len(word) - head - tail
        part = between // 2
        if near.startswith(word[: head + part]):
            head += part
        else:
            tail += between - part
    return head, tail


NEAREST = "word string, n_near long, near_n long, near string"


def _asked(rows: pd.DataFrame) -> pd.DataFrame:
    """For every word that asks here: how many words it is near to, and the most frequent of them."""
    counts = dict(zip(rows["word"], rows["n"], strict=True))
    words = sorted(counts)
    index = FmIndex(words)
    asking = rows[rows["cut_length"] == rows["word"].str.len()]
    out = []
    for first, asked in asking.groupby("first"):
        queries = asked["word"].tolist()
        ways = list(zip(asked["depth"], asked["head"], asked["tail"], strict=True))
        best: dict[int, list] = {}
        for q, w in zip(*index.sharing_half(queries, bool(first)), strict=True):
            depth, head, tail = ways[q]
            near = words[w]
            if route_of(queries[q], near, depth) != (head, tail):
                continue
            known = best.setdefault(q, [0, 0, ""])
            known[0] += 1
            if (-counts[near], near) < (-known[1], known[2]) or not known[1]:
                known[1:] = counts[near], near
        out += [(queries[q], *found) for q, found in best.items()]
    return pd.DataFrame(out, columns=["word", "n_near", "near_n", "near"])


def near_words(words: DataFrame, most: int = MOST, index_rows: int = INDEX_ROWS) -> DataFrame:
    """(word, n_near, near_n, near) of words (word, n) that have near words."""
    rows = dealt(words, most)
    indexes = max(1, -(-6 * words.count() // index_rows))
    # Rows are few and the work on each is long, so partitions follow the indexes, not the bytes.
    tasks = max(int(words.sparkSession.conf.get("spark.sql.shuffle.partitions")), indexes // 4)
    numbered = rows.withColumn("index", F.pmod("key", F.lit(indexes))).repartition(tasks, "index")
    found = numbered.groupBy("index").applyInPandas(_asked, NEAREST)
    best = F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("word")))
    return (
        found.groupBy("word")
        .agg(F.sum("n_near").alias("n_near"), best.alias("best"))
        .select("word", "n_near", (-F.col("best.n")).alias("near_n"), F.col("best.word").alias("near"))
    )


def last_forms(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): forms followed to the last, by doubling."""
    steps = forms.select("word", F.col("form").alias("root"))
    while True:
        ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        jumped = stage(
            steps.join(ahead, "root", "left").select(
                "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")
            ),
            "roots",
        )
        steps = jumped.select("word", "root")
        if not jumped.where("moved").limit(1).count():
            return steps


def variant_groups(words: DataFrame, ratio: int = 2, most: int = MOST, index_rows: int = INDEX_ROWS) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of a vocabulary of distinct words with counts."""
    words = stage(words.select("word", "n"), "words")
    near = near_words(words, most, index_rows)
    leads = F.col("near_n") >= ratio * F.col("n")
    formed = stage(
        words.join(near, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(leads, F.col("near")).alias("form"),
            F.when(leads, F.col("near_n")).alias("form_n"),
        ),
        "forms",
    )
    roots = last_forms(formed.where(F.col("form").isNotNull()))
    return formed.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
