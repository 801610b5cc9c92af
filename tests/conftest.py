import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sheaf.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[4]", 4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def payloads(spark):
    """Payload rows from ``(body, status, url)`` tuples in page order."""

    def make(*pages, harvest="h"):
        rows = []
        for seq, page in enumerate(pages):
            body, status, url = (page if isinstance(page, tuple) else (page, 200, None))
            rows.append((harvest, seq, url or f"https://x.example.org/{seq}", status, "application/json", body))
        schema = "harvest_id string, seq bigint, url string, status int, content_type string, body string"
        return spark.createDataFrame(rows, schema)

    return make
