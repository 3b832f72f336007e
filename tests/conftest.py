import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from shroud.session import local_session

    s = local_session(os.environ.get("SHROUD_TEST_CORES", "*"), 8, app="shroud-tests",
                      checkpoint_dir=tempfile.mkdtemp(prefix="shroud-ckpt-"))
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(autouse=True, scope="module")
def let_go(spark):
    """No table stays in memory after a module."""
    from shroud.session import release_kept

    yield
    release_kept(spark)


def rows(df, *cols):
    """Collected rows as tuples, in a stable order."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.select(*cols).collect()),
                  key=lambda t: tuple("" if v is None else str(v) for v in t))
