"""The stages of the corpus pipeline, one by one and in a row."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from chattermark.llm import decontamination, jaccardjoin, mixing, queries, toxicity
from chattermark.llm.frames import read_table

SF_DIR = "/root/testdata/sf0.001"


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


@pytest.fixture(scope="module")
def docs(spark):
    return read_table(spark, SF_DIR, "documents")


def test_toxic_documents_go(spark, docs):
    kept = corpus_pipeline.drop_toxic(spark, docs, SF_DIR)
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = toxicity.fit(docs, read_table(spark, SF_DIR, "labels"), teaches=~held_out)
    scores = toxicity.score(docs, model).collect()
    assert kept.columns == docs.columns
    assert ids(kept) == sorted(r.doc_id for r in scores if r.score < 0.3)


def test_one_of_each_group_stays(spark, docs):
    kept = corpus_pipeline.drop_near_copies(spark, docs, SF_DIR)
    groups = jaccardjoin.similar_groups(docs, k=5, percent=80).collect()
    assert kept.columns == docs.columns
    assert ids(kept) == sorted(r.doc_id for r in groups if r.doc_id == r.component_id)


def test_contaminated_documents_go(spark, docs):
    kept = corpus_pipeline.drop_contaminated(spark, docs, SF_DIR)
    hit = {r.doc_id for r in decontamination.contaminated(docs, read_table(spark, SF_DIR, "benchmark")).collect()}
    assert kept.columns == docs.columns and hit
    assert ids(kept) == sorted(set(ids(docs)) - hit)


def test_mix_takes_whole_documents(spark, docs):
    found = corpus_pipeline.mix_sources(spark, docs, SF_DIR)
    assert found.columns == docs.columns
    times = Counter(ids(found))
    for r in mixing.mix(docs).collect():
        assert abs(times[r.doc_id] - (r.taken / r.size if r.size else 0)) < 1
    assert ids(found) == ids(corpus_pipeline.mix_sources(spark, docs.repartition(5), SF_DIR))


def test_all_stages(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "near copies", "decontamination", "mixing", "sharding",
    ]
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    per_shard = Counter(r.shard for r in rows)
    assert max(per_shard.values()) - min(per_shard.values()) <= 1
    clean = set(ids(read_table(spark, SF_DIR, "documents")))
    assert rows and {r.doc_id for r in rows} <= clean


def test_stages_bear_odd_tables(spark, texts):
    df = texts((1, None), (None, None), (2, ""), (2, ""), (3, "some words here"), (3, "some words here"), (None, "lonely", None))
    for name, stage in corpus_pipeline.STAGES:
        for table in (df, df.where("false"), df.withColumns({"score": F.lit(1), "node": F.lit(2), "size": F.lit(3)})):
            found = stage(spark, table, SF_DIR)
            if name != "sharding":
                assert found.columns == table.columns
            found.collect()


def test_every_operator_has_one_query():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES)
    assert numbers == list(range(1, 11))
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES)
