import pytest

from chattermark.llm.frames import read_table

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    return read_table(spark, SF_DIR, "documents")


@pytest.fixture
def texts(spark):
    """A documents table from (doc_id, text[, source])."""

    def build(*rows):
        full = [(r[0], r[1], "xx", r[2] if len(r) > 2 else "s", None) for r in rows]
        return spark.createDataFrame(
            full, "doc_id long, text string, lang string, source string, n_chars long"
        )

    return build
