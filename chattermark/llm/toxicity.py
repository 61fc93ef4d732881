"""Toxicity of texts after their obfuscation is undone.

Words are restored first (see `deobfuscation`). Which words and stems speak for
toxicity is learned from labelled rows: those whose rate among the restored
words of toxic documents is well above that in clean ones, with the log ratio
of both rates as weight. A document's evidence is the sum of the weights of its
words. A logistic regression on the evidence, its density and the length gives
the score.

The character model is counted over all documents: one pass, a table of bounded
size. The classifier is fitted on `sample_rows` labelled rows at most, chosen by
a seeded digest of their ids; that bound is what lets the ids be broadcast and
the few numbers per row be fitted on the driver. Their texts are restored once, into a
staged table of words, which the weights and the fit are both taken from. A form must stand
in a `share` of the toxic ones of them, so there are at most as many forms as one such document holds on
average, divided by `share`. Scoring needs no shuffle.

Defined results: a null or empty text has no evidence and gets the score of a
text without words. Labels that are null, or whose document is missing, teach
nothing; an id labelled twice counts twice. Without both kinds of labels every
score is the share of toxic labels, 0 where there are none. Input columns named
like an output column are replaced. An empty table gives an empty table.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chattermark.llm.deobfuscation import Restorer, log_model, trigram_counts
from chattermark.llm.frames import carry, restore, seeded_order
from chattermark.sources.staging import stage

STEMS = (4, 5, 6, 7)
THRESHOLD = 0.3


@dataclass(frozen=True)
class ToxicityModel:
    """A character model, weights of words and stems, and a logistic regression."""

    characters: np.ndarray
    weights: dict[str, float]
    coefficients: tuple[float, ...]

    def scores(self, evidence: np.ndarray, words: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(features(evidence, words) @ np.array(self.coefficients))))


def forms(word: str) -> Iterator[str]:
    """The word and its stems."""
    yield word
    for n in STEMS:
        if len(word) > n:
            yield f"{word[:n]}*"


def features(evidence: np.ndarray, words: np.ndarray) -> np.ndarray:
    return np.stack(
        [np.ones(len(evidence)), 10 * evidence / (words + 20), np.log1p(evidence), np.log1p(words) / 4], 1
    )


def fitted(evidence: np.ndarray, words: np.ndarray, toxic: np.ndarray, ridge: float = 1e-2) -> tuple:
    """Logistic regression by Newton's method, with a small ridge."""
    x, w = features(evidence, words), np.zeros(4)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(4), x.T @ (toxic - p) - ridge * w)
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w)


def weight_of(word: str, weights: dict[str, float]) -> float:
    """The greatest weight among a word and its stems, 0 without any."""
    return max((weights[f] for f in forms(word) if f in weights), default=0.0)


class Evidence:
    """Sum of weights and number of words of texts; keeps what it found for tokens."""

    def __init__(self, characters: np.ndarray, weights: dict[str, float], keep: int = 100_000) -> None:
        self.restorer, self.weights = Restorer(characters), weights
        self.keep, self.known = keep, {}
        # A word that begins like no weighted form has no weight.
        self.least = min(STEMS)
        self.begins = {form.removesuffix("*")[: self.least] for form in weights}

    def of_words(self, words: Iterable[str]) -> tuple[float, int]:
        total, n = 0.0, 0
        for word in words:
            n += 1
            if word[: self.least] in self.begins:
                total += weight_of(word, self.weights)
        return total, n

    def __call__(self, text: str | None) -> tuple[float, int]:
        total, count, known = 0.0, 0, self.known
        for part in self.restorer.parts(text or ""):
            if isinstance(part, list):
                found = self.of_words(self.restorer.spaced(part))
            else:
                found = known.get(part)
                if found is None:
                    if len(known) >= self.keep:
                        known.clear()
                    found = known[part] = self.of_words(self.restorer.token(part))
            total += found[0]
            count += found[1]
        return total, count


RESTORED = "words array<string>, times array<long>, toxic int"


def restored_words(labelled: DataFrame, characters: np.ndarray) -> DataFrame:
    """The distinct restored words of every labelled text, with how often they stand in it."""

    def restored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        restorer = Restorer(characters)
        for batch in batches:
            found = [Counter(restorer.words(text or "")) for text in batch["text"]]
            yield pd.DataFrame(
                {
                    "words": [list(c.keys()) for c in found],
                    "times": [list(c.values()) for c in found],
                    "toxic": batch["toxic"].to_numpy(),
                }
            )

    return labelled.mapInPandas(restored, RESTORED)


def form_counts(words: DataFrame) -> DataFrame:
    """(form, toxic_n, clean_n, toxic_documents) of restored words; form '' counts all words."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            n, documents = (Counter(), Counter()), Counter()
            for own, times, toxic in zip(batch["words"], batch["times"], batch["toxic"], strict=True):
                found = Counter()
                for word, count in zip(own, times.tolist(), strict=True):
                    for form in forms(word):
                        found[form] += count
                found[""] = int(times.sum())
                n[toxic].update(found)
                if toxic:
                    documents.update(found.keys())
            names = list(n[0].keys() | n[1].keys())
            yield pd.DataFrame(
                {
                    "form": names,
                    "toxic_n": [n[1][x] for x in names],
                    "clean_n": [n[0][x] for x in names],
                    "toxic_documents": [documents[x] for x in names],
                }
            )

    return (
        words.mapInPandas(counted, "form string, toxic_n long, clean_n long, toxic_documents long")
        .groupBy("form")
        .agg(*[F.sum(c).alias(c) for c in ("toxic_n", "clean_n", "toxic_documents")])
    )


def form_weights(counts: DataFrame, *, ratio: float, share: float) -> dict[str, float]:
    """Log ratio of rates for forms in a share of the toxic documents whose rate is `ratio` times as high."""
    whole = counts.where(F.col("form") == "").first()
    if whole is None or not whole["toxic_n"] or not whole["clean_n"]:
        return {}
    rate = (F.col("toxic_n") + 0.5) / whole["toxic_n"] / ((F.col("clean_n") + 0.5) / whole["clean_n"])
    least = max(3.0, share * whole["toxic_documents"])
    rows = (
        counts.where((F.col("form") != "") & (F.col("toxic_documents") >= least) & (rate >= ratio))
        .select("form", F.log(rate).alias("weight"))
        .collect()
    )
    return {r["form"]: r["weight"] for r in rows}


def fit(
    documents: DataFrame,
    labels: DataFrame,
    *,
    teaches: Column | None = None,
    sample_rows: int = 40_000,
    ratio: float = 4.0,
    share: float = 0.005,
    seed: int = 42,
) -> ToxicityModel:
    """Fit on `documents` (doc_id, text) and `labels` (doc_id, toxic); `teaches` limits the labels."""
    characters = log_model([tuple(r) for r in trigram_counts(documents).collect()])
    usable = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    if teaches is not None:
        usable = usable.where(teaches)
    rows = (
        usable.select("doc_id", (F.col("toxic") > 0).cast("int").alias("toxic"))
        .orderBy(seeded_order(seed, F.col("doc_id")))
        .limit(sample_rows)
        .collect()
    )
    spark = documents.sparkSession
    chosen = spark.createDataFrame([tuple(r) for r in rows], "doc_id long, toxic int")
    # At most `sample_rows` pairs of numbers, so this broadcast has a bound.
    labelled = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    words = stage(restored_words(labelled.select("text", "toxic"), characters), "restored-words")
    weights = form_weights(stage(form_counts(words), "form-counts"), ratio=ratio, share=share)

    def measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            evidence = [
                sum(weight_of(word, weights) * count for word, count in zip(own, times.tolist(), strict=True))
                for own, times in zip(batch["words"], batch["times"], strict=True)
            ]
            yield pd.DataFrame(
                {
                    "evidence": np.array(evidence, dtype=float),
                    "words": [int(times.sum()) for times in batch["times"]],
                    "toxic": batch["toxic"].to_numpy(),
                }
            )

    table = words.mapInPandas(measured, "evidence double, words long, toxic int")
    got = np.array([tuple(r) for r in table.collect()], dtype=float).reshape(-1, 3)
    share_toxic = float(got[:, 2].mean()) if len(got) else 0.0
    if share_toxic in (0.0, 1.0):
        return ToxicityModel(characters, {}, (-700.0 if share_toxic == 0 else 700.0, 0.0, 0.0, 0.0))
    return ToxicityModel(characters, weights, fitted(*got.T))


SCORED = T.StructType(
    [
        T.StructField("score", T.DoubleType()),
        T.StructField("evidence", T.DoubleType()),
        T.StructField("n_words", T.LongType()),
    ]
)


def score(documents: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD) -> DataFrame:
    """`documents` with `score`, `predicted` (1 from the threshold), `evidence` and `n_words`."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(SCORED)
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = shared.value
        evidence = Evidence(model.characters, model.weights)
        for texts in batches:
            found = [evidence(text) for text in texts]
            total, words = np.array([a for a, _ in found], float), np.array([n for _, n in found], float)
            yield pd.DataFrame(
                {"score": model.scores(total, words), "evidence": total, "n_words": words.astype("int64")}
            )

    done = carry(documents, scored=scored("text"))
    return restore(
        done,
        score=F.col("scored.score"),
        predicted=(F.col("scored.score") >= threshold).cast("int"),
        evidence=F.col("scored.evidence"),
        n_words=F.col("scored.n_words"),
    )


def restored_text(documents: DataFrame, model: ToxicityModel) -> DataFrame:
    """`documents` with `restored`: the restored words, parted by blanks."""
    shared = documents.sparkSession.sparkContext.broadcast(model.characters)

    @F.pandas_udf(T.StringType())
    def rewritten(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        restorer = Restorer(shared.value)
        for texts in batches:
            yield texts.map(lambda text: " ".join(restorer.words(text or "")))

    done = carry(documents, restored=rewritten(F.coalesce("text", F.lit(""))))
    return restore(done, restored=F.col("restored"))
