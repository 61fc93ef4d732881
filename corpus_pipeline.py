"""The corpus pipeline: each stage applies one operator to all documents of its predecessor.

Stages filter or deal out documents: toxic ones go, one of each group of near
copies stays, documents with passages of the benchmark go, sources are mixed to
their target weights, and what is left is dealt to shards. All but the last
return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chattermark.llm import decontamination, jaccardjoin, mixing, sharding, toxicity
from chattermark.llm.frames import bound_batches, read_table, seeded_order
from chattermark.sources.staging import stage

#: No SQL can express the learned and the sampled stages; they are tested one by one.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"), teaches=~held_out)
    return toxicity.score(docs, model).where("predicted = 0").select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group with a similarity of 0.8 over shingles of five words."""
    bound_batches(spark, 1 << 20)  # all workers of an executor hold batches at once
    return jaccardjoin.keep_one_of_each(docs, k=5, percent=80).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontamination.clean(docs, read_table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str, seed: int = 42) -> DataFrame:
    """Documents as often as the mix takes them, three times at most.

    The mix takes words; a document of which it takes a part is taken whole with
    that part as chance, by a seeded digest.
    """
    mixed = mixing.mix(docs, seed=seed)
    digest = seeded_order(seed + 1, F.col("doc_id"), F.col("text"))
    chance = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / 2**32
    share = F.col("taken") / F.col("size")
    copies = F.floor(share) + (chance < share - F.floor(share)).cast("int")
    times = F.when(F.col("size") > 0, copies).otherwise(0).cast("int")
    return mixed.withColumn("time", F.explode(F.array_repeat(F.lit(1), times))).select(*docs.columns)


def deal_to_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard and slot; every shard holds the mixture."""
    return sharding.interleave(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near copies", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", deal_to_shards),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on `documents`; each stage reads what its predecessor wrote."""
    docs = read_table(spark, sf_dir, "documents")
    for i, (name, function) in enumerate(STAGES):
        docs = function(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stage(docs, name.replace(" ", "-"))
    return docs
