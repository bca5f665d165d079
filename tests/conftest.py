import os
import sys
import tempfile
import uuid

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [REPO, os.path.join(REPO, "tests")]

import __spark_entry__  # noqa: E402, F401  (functions travel with the tasks)

from lakesieve.session import build_session, small_frame  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="lakesieve-tests-"),
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(params=["one range", "many ranges"])
def ranges(spark, request):
    """Whether small tables fall into one range partition or into several."""
    if request.param == "many ranges":
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "13")
    yield request.param
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "4")


@pytest.fixture
def frame(spark):
    """Rows given as tuples, with a DDL schema."""
    from pyspark.sql.types import StructType

    def build(schema, *rows):
        names = StructType.fromDDL(schema).names
        return small_frame(spark, [dict(zip(names, row)) for row in rows], schema)

    return build


@pytest.fixture
def sample(frame):
    """Five rows with a missing category, a negative and a huge amount."""
    return frame(
        "id bigint, category string, amount double",
        (1, "a", 10.0), (2, "b", 20.0), (3, "a", 30.0), (4, "c", -5.0), (5, None, 1000.0),
    )


@pytest.fixture
def duplicated(frame):
    return frame("id bigint, value bigint", (1, 10), (1, 10), (2, 20), (3, 30), (None, 40))


@pytest.fixture
def folder(tmp_path):
    return lambda: str(tmp_path / uuid.uuid4().hex)


def rows_of(df, *columns):
    """Rows as a sorted list of tuples."""
    found = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
    return sorted(found, key=lambda r: tuple((v is not None, v) for v in r))
