import sys
from datetime import datetime
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from chattermark import schemas  # noqa: E402
from chattermark.session import build_session  # noqa: E402
from chattermark.sources.tables import CommentTables  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "chattermark-tests",
        "local[8]",
        {
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


@pytest.fixture
def make_tables(spark):
    """Builds the four tables from short rows.

    A comment is (id, time, user, video, likes, replies[, text]).
    """

    def build(comments, users=(), videos=(), channels=()) -> CommentTables:
        rows = [
            (c[0], at(c[1]) if c[1] else None, *c[2:6], c[6] if len(c) > 6 else None)
            for c in comments
        ]
        return CommentTables(
            comments=spark.createDataFrame(rows, schemas.COMMENTS),
            users=spark.createDataFrame(list(users), schemas.USERS),
            videos=spark.createDataFrame(list(videos), schemas.VIDEOS),
            channels=spark.createDataFrame(list(channels), schemas.CHANNELS),
        )

    return build


@pytest.fixture
def activity_of():
    from chattermark.operators.activity import comment_activity

    def run(tables, **options):
        options = {"start": None, "end": None, **options}
        return comment_activity(
            tables.comments, tables.users, tables.videos, tables.channels, **options
        )

    return run
