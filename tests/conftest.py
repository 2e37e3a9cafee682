import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from litquarry.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df):
    """Rows as sorted tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan_of(df):
    """The physical plan, as ``explain`` prints it."""
    import contextlib
    import io

    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()
