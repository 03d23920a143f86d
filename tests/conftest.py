import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SMALL_SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from ticketlens.session import build_session

    # build_session uses spark.checkpoint.dir when the environment names one
    # and makes a scratch folder only when it is unset (local mode)
    session = build_session("local[4]", app_name="ticketlens-tests", shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="ticketlens-test-")


def rows(df, *cols):
    """Collected rows as sorted tuples (for order-insensitive asserts)."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def plan_text(df, mode: str = "simple") -> str:
    """The plan text ``df.explain(mode)`` prints (public API, captured)."""
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()
