import tempfile

import pytest

from tablewright import build_session
from tablewright.session import prepare


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", 4, {"spark.driver.memory": "4g", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="tests-")})
    session.sparkContext.setLogLevel("ERROR")
    prepare(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def rows():
    """Sorted plain rows of a DataFrame. NULLs sort first."""

    def collect(df, *cols):
        picked = df.select(*cols) if cols else df
        found = [tuple(r) for r in picked.collect()]
        return sorted(found, key=lambda r: [(v is not None, v) for v in r])

    return collect
