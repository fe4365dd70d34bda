import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from forumgauge.session import local_session

    shared = str(tmp_path_factory.mktemp("shared"))
    session = local_session(8, shuffle_partitions=4, app="forumgauge-tests", **{"spark.checkpoint.dir": shared})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def posts_of(spark):
    """Build posts from dictionaries; fields left out get a default."""
    from forumgauge.schemas import POST, POST_COLUMNS

    defaults = {"title": "A plain title", "selftext": "", "score": 1, "created_utc": 1704067200.9,
                "num_comments": 0, "url": None, "subreddit": "s"}

    def build(*rows):
        filled = [{**defaults, "id": str(i), **row} for i, row in enumerate(rows)]
        return spark.createDataFrame([tuple(r[c] for c in POST_COLUMNS) for r in filled], POST)

    return build
