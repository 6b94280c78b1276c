import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from clearlot.session import local_session  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "clearlot-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return FOLDER


def rows_of(frame, *names):
    """Rows as sorted tuples."""
    chosen = frame.select(*names) if names else frame
    return sorted((tuple(row) for row in chosen.collect()), key=repr)


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()
