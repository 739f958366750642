"""One local session for all tests."""

import os
import sys

# A threaded solve can hang in a process that has forked, as starting the JVM does.
os.environ.setdefault("OPENBLAS_NUM_THREADS", "1")

import pytest  # noqa: E402

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from wardline.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, 4, "wardline-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def frame(spark):
    """``frame(rows, "a int, b string")``."""

    def make(rows, schema):
        return spark.createDataFrame(rows, schema)

    return make


@pytest.fixture
def rows():
    """Rows of a frame as sorted tuples in the order of the named columns."""

    def get(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple((v is not None, v) for v in r))

    return get
