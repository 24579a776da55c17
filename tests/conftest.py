import os
import sys
from collections import Counter

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from threadloom import schemas  # noqa: E402
from threadloom.plans.workspace import workspace  # noqa: E402
from threadloom.session import local_session  # noqa: E402

DATA = os.environ.get("THREADLOOM_TEST_DATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", 8)
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def ws(spark):
    return workspace(spark, DATA)


@pytest.fixture(scope="session")
def data_directory():
    return DATA


@pytest.fixture(scope="session")
def flat_frame(spark):
    """Build a flat comment table from partial rows; missing columns are plausible defaults."""
    defaults = dict(
        link_id="t3_p", parent_id="t3_p", subreddit_id="t5_s", subreddit="news", author="ann",
        author_flair_text=None, author_flair_css_class=None, body="text", created_utc=1431000000,
        retrieved_on=1433000000, score=1, ups=1, downs=0, score_hidden=0, gilded=0,
        controversiality=0, edited=0, archived=0, distinguished=None, removal_reason=None,
    )

    def build(*rows):
        full = []
        for i, row in enumerate(rows):
            values = {"id": f"c{i}", **defaults, **row}
            values.setdefault("name", None if values["id"] is None else f"t1_{values['id']}")
            full.append(tuple(values[f.name] for f in schemas.FLAT.fields))
        return spark.createDataFrame(full, schemas.FLAT)

    return build


@pytest.fixture(scope="session")
def table_frame(spark):
    """Build one relational table from partial rows; missing columns are NULL."""

    def build(table, *rows):
        schema = schemas.RELATIONAL[table]
        return spark.createDataFrame(
            [tuple(row.get(f.name) for f in schema.fields) for row in rows], schema
        )

    return build


@pytest.fixture(scope="session")
def rows_of():
    """All rows as a multiset of tuples in column-name order."""

    def collect(df):
        columns = sorted(df.columns)
        return Counter(tuple(str(r[c]) for c in columns) for r in df.collect())

    return collect
