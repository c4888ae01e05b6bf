import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from martlane.session import get_spark

    ckpt = tempfile.mkdtemp(prefix="martlane-test-ckpt-")
    s = get_spark("local[4]", 8, "martlane-tests", {"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="martlane-test-")


def rows(df, *cols):
    """Sorted list of tuples (for order-insensitive comparisons)."""
    cols = cols or tuple(df.columns)
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())
