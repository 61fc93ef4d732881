import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from chattermark import schemas
from chattermark.plans import report
from chattermark.settings import AnalysisSettings, ClusterSettings
from chattermark.sources import sinks, staging, tables

USERS = [(1, "ann"), (2, "bob"), (3, "cy")]
VIDEOS = [(10, 100)]
CHANNELS = [(100, "news")]


@pytest.fixture
def source(make_tables):
    comments = [
        (i, f"2024-01-05 10:00:{i:02d}", 1, 10, i, 0, f'buy now "cheap" phones, number {i % 3}\nok')
        for i in range(12)
    ]
    comments += [(20 + i, f"2024-01-0{i + 1} 11:00", 2, 10, 1, 1, "thanks") for i in range(5)]
    return make_tables(comments, USERS, VIDEOS, CHANNELS)


def test_parquet_and_catalog(spark, source, tmp_path):
    for name, df in source.items():
        df.write.parquet(f"{tmp_path}/{name}")
    stored = tables.from_parquet(spark, str(tmp_path))
    assert stored.comments.count() == 17
    assert stored.comments.schema == schemas.COMMENTS
    stored.register("raw_")
    assert tables.from_catalog(spark, "raw_").users.count() == 3
    checked = {r.table_name: r for r in tables.check_catalog(spark, "raw_").collect()}
    assert checked["raw_comments"].present and checked["raw_comments"].missing_columns == []
    tables.require_tables(spark, "raw_")
    with pytest.raises(LookupError, match="absent_users"):
        tables.require_tables(spark, "absent_")
    source.users.drop("username").createOrReplaceTempView("bad_users")
    checked = {r.table_name: r for r in tables.check_catalog(spark, "bad_").collect()}
    assert checked["bad_users"].missing_columns == ["username"]
    assert not checked["bad_videos"].present


def test_jdbc_options():
    common = {"user": "u", "password": "p"}
    plain = tables.jdbc_options("jdbc:mysql://host/db", "comments", **common)
    assert plain["dbtable"] == "comments" and "numPartitions" not in plain
    ranged = tables.jdbc_options(
        "jdbc:mysql://host/db", "comments", **common,
        partition_column="id", lower_bound=0, upper_bound=100, num_partitions=4,
    )
    assert ranged["partitionColumn"] == "id" and ranged["numPartitions"] == "4"
    assert ranged["lowerBound"] == "0"
    with pytest.raises(ValueError):
        tables.jdbc_options("jdbc:mysql://host/db", "comments", **common, partition_column="id")


def test_every_database_table_is_read_in_ranges(spark, source, monkeypatch):
    asked = []

    def read(session, options):
        asked.append(options)
        name = options["dbtable"]
        if "bounds" in name:
            values = (None, None) if "db.users" in name else (5, 900)
            return session.createDataFrame([values], "low long, high long")
        return getattr(source, name.removeprefix("db."))

    monkeypatch.setattr(tables, "read_options", read)
    found = tables.from_jdbc(spark, "jdbc:x", user="u", password="p", prefix="db.", num_partitions=7)
    assert found.comments.count() == 17
    reads = {o["dbtable"]: o for o in asked if "bounds" not in o["dbtable"]}
    assert set(reads) == {"db.comments", "db.users", "db.videos", "db.channels"}
    for name, options in reads.items():
        if name == "db.users":
            assert "partitionColumn" not in options
        else:
            assert (options["lowerBound"], options["upperBound"], options["numPartitions"]) == ("5", "901", "7")
    assert sum("bounds" in o["dbtable"] for o in asked) == 4


def test_sql_parameters_are_values_not_text(spark, source):
    statement = "SELECT username FROM {people} WHERE username = :name"
    spark.range(1).createOrReplaceTempView("people")
    found = tables.run_sql(spark, statement, {"people": source.users}, name="ann")
    assert [r.username for r in found.collect()] == ["ann"]
    hostile = tables.run_sql(spark, statement, {"people": source.users}, name="x' OR '1'='1")
    assert hostile.collect() == []
    assert spark.table("people").columns == ["id"]


def test_staged_table_reads_back(spark, source):
    staged = staging.stage(source.comments, "comments")
    assert staged.schema == source.comments.schema
    assert sorted(staged.collect()) == sorted(source.comments.collect())
    assert staging.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_csv_keeps_commas_quotes_and_drops_vectors(spark, source, tmp_path):
    df = source.comments.select("id", "text", F.array(F.lit(1.0)).alias("vector"))
    path = sinks.write_csv(df, f"{tmp_path}/c.csv")
    back = sinks.read_csv(spark, path, "id long, text string")
    assert back.columns == ["id", "text"]
    assert {(int(r.id), r.text) for r in back.collect()} == {
        (r.id, r.text) for r in source.comments.collect()
    }


def test_csv_keeps_every_text(spark, tmp_path):
    odd = ["  outer blanks \n", "", None, '"', '""', 'a "quoted" word', "a,b", "a\r\nb", "a\rb", "\\", "\\N", "#x", "\t", "é"]
    df = spark.createDataFrame(list(enumerate(odd)), "id long, text string")
    path = sinks.write_csv(df, f"{tmp_path}/odd.csv")
    back = {r.id: r.text for r in sinks.read_csv(spark, path, "id long, text string").collect()}
    assert back == dict(enumerate(odd)) | {10: None}  # the mark for null is the one text that can't be told


def test_json_turns_other_types_into_text(spark, source, tmp_path):
    path = sinks.write_json(source.comments.limit(1), f"{tmp_path}/c.json")
    line = json.loads(next(Path(path).glob("*.json")).read_text())
    assert line["published_at"].startswith("2024-01-0") and "text" in line


def test_whole_analysis(spark, source, tmp_path):
    options = AnalysisSettings(start="2024-01-01", end="2024-02-01")
    clusters = ClusterSettings(n_features=32, n_components=3, n_clusters=3, restarts=2, n_samples=2)
    result = report.run_analysis(source, str(tmp_path), options, clusters)
    assert result.suspicious.select("username").collect()[0].username == "ann"
    assert result.comments.count() == 12
    assert set(result.files) == {
        "cumulative_share", "activity_by_month", "summary", "counts", "commenter_density",
        "suspicious_commenters", "suspicious_usernames", "quality_activity", "clustered_comments",
        "cluster_samples", "cluster_sizes", "cluster_statistics", "quality_clusters",
        "quality_texts",
    }
    listed = spark.read.csv(result.files["suspicious_commenters"], header=True).collect()
    assert [tuple(r) for r in listed] == [("ann", "1", "12")]
    summary = spark.read.json(result.files["summary"]).head()
    assert (summary.total_users, summary.total_comments, summary.suspicious_users) == (2, 17, 1)
    assert sum(c["count"] for c in summary.cluster_distribution) == 12
    counts = spark.read.json(result.files["counts"]).head()
    assert counts.total_records == 2 and counts.comments_analyzed == 12
    samples = spark.read.json(result.files["cluster_samples"])
    assert samples.filter(F.size("samples") > 2).isEmpty()
    sizes = sinks.read_snapshot(spark, result.files["cluster_sizes"])
    assert sizes.agg(F.sum("count")).head()[0] == 12


def test_analysis_without_texts_or_suspects(source, tmp_path):
    options = AnalysisSettings(start="2024-01-01", end="2024-02-01", threshold=100)
    result = report.run_analysis(source, str(tmp_path / "a"), options)
    assert result.clustered is None and "suspicious_commenters" not in result.files
    options = AnalysisSettings(start="2024-01-01", end="2024-02-01")
    result = report.run_analysis(source, str(tmp_path / "b"), options, include_texts=False)
    assert result.comments is None and "suspicious_commenters" in result.files


def test_texts_of_another_window(source, tmp_path):
    options = AnalysisSettings(start="2024-01-01", end="2024-02-01")
    result = report.run_analysis(
        source, str(tmp_path), options, text_window=("2024-03-01", "2024-04-01")
    )
    assert result.comments.count() == 0
    assert result.clustered.table.collect() == []


def test_catalog_analysis(spark, source, tmp_path):
    source.register("run_")
    result = report.run_catalog_analysis(
        spark, str(tmp_path), "run_", include_texts=False,
        options=AnalysisSettings(start=None, end=None),
    )
    assert result.activity.count() == 2


def test_command_line(spark, source, tmp_path, capsys):
    from chattermark.__main__ import main

    for name, df in source.items():
        df.write.parquet(f"{tmp_path}/tables/{name}")
    files = main(
        ["--tables", f"{tmp_path}/tables", "--start-date", "2024-01-01", "--end-date",
         "2024-02-01", "--threshold", "5", "--no-text-analysis", "--output-dir", f"{tmp_path}/out"]
    )
    assert "suspicious_commenters" in files
    assert f"summary\t{tmp_path}/out/summary.json" in capsys.readouterr().out


def staged_files(spark):
    return [p for p in Path(staging.shared_folder(spark)).glob("analysis-*/*")]


def test_analysis_with_an_encoder_and_nothing_left_staged(spark, source, tmp_path):
    def toy_encoder():
        return lambda texts: [[float(len(t)), float(t.count("1")), float(t.count("2"))] for t in texts]

    options = AnalysisSettings(start="2024-01-01", end="2024-02-01")
    clusters = ClusterSettings(n_clusters=4, restarts=1)
    result = report.run_analysis(source, str(tmp_path), options, clusters, load_encoder=toy_encoder)
    assert "embedding" in result.comments.columns
    # Three kinds of text: fewer clusters than asked for, which the report warns of.
    assert result.clustered.table.select("cluster_label").distinct().count() == 3
    checks = sinks.read_snapshot(spark, result.files["quality_clusters"])
    assert [r.value for r in checks.where("check_name = 'cluster_count'").collect()] == [3.0]
    assert staged_files(spark) == []
    assert result.activity.count() == 2 and result.clustered.table.count() == 12


def test_analysis_by_a_vector_column(spark, source, tmp_path):
    vectors = F.when(F.col("id") != 3, F.array(F.col("id") % 2, F.lit(1)).cast("array<double>"))
    tables_with = tables.CommentTables(
        source.comments.withColumn("vec", vectors), source.users, source.videos, source.channels
    )
    options = AnalysisSettings(start="2024-01-01", end="2024-02-01")
    clusters = ClusterSettings(n_clusters=2, restarts=1)
    result = report.run_analysis(tables_with, str(tmp_path), options, clusters, vector_column="vec")
    labels = {r.comment_id: r.cluster_label for r in result.clustered.table.collect()}
    assert labels[3] is None and len(set(labels.values())) == 3


def test_nothing_is_left_staged_after_a_failure(spark, source, tmp_path):
    def broken():
        raise RuntimeError("no encoder")

    options = AnalysisSettings(start="2024-01-01", end="2024-02-01")
    with pytest.raises(Exception, match="no encoder"):
        report.run_analysis(source, str(tmp_path), options, load_encoder=broken)
    assert staged_files(spark) == [] and not list(Path(staging.shared_folder(spark)).glob("analysis-*"))


def test_staging_leaves_the_session_alone(spark, monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        conf = Conf()

        class sparkContext:
            master, applicationId = "local[2]", "local-x"
            getCheckpointDir = staticmethod(lambda: None)

    folder = staging.shared_folder(Session)
    assert folder == staging.shared_folder(Session) and Path(folder).is_dir()
    Session.sparkContext.master = "spark://host"
    with pytest.raises(ValueError):
        staging.shared_folder(Session)


def test_tables_of_the_report_are_in_order(spark, tmp_path):
    import glob

    import pyarrow.parquet as pq

    import __spark_entry__ as entry
    from chattermark.sources.staging import stage

    sf_dir = "/root/testdata/sf0.001"
    activity = stage(entry._activity(spark, sf_dir), "activity")
    labelled = stage(entry._labelled(spark, sf_dir), "labelled")
    files = report.write_report(activity, str(tmp_path), 2, labelled)
    keys = {
        "cumulative_share": ["number_comments_all_time"],
        "activity_by_month": ["month"],
        "commenter_density": ["number_comments_all_time", "number_periods_with_comments"],
        "cluster_sizes": ["cluster_label"],
        "cluster_statistics": ["cluster_label"],
    }
    for name, columns in keys.items():
        rows = []
        for part in sorted(glob.glob(f"{files[name]}/part-*.parquet")):
            rows += [tuple(r[c] for c in columns) for r in pq.read_table(part).to_pylist()]
        assert rows and rows == sorted(rows), name
