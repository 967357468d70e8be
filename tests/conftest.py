import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidelog.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="tidelog-tests-")
    s = get_session(
        "local[4]",
        app_name="tidelog-tests",
        shuffle_partitions=4,
        extra={"spark.checkpoint.dir": os.path.join(scratch, "ckpt"), "spark.local.dir": os.path.join(scratch, "local")},
    )
    yield s
    s.stop()


def rows(df, *cols):
    """Sorted list of tuples (nulls sort first)."""
    cols = cols or tuple(df.columns)
    out = [tuple(r[c] for c in cols) for r in df.collect()]
    return sorted(out, key=lambda t: tuple((v is not None, v) for v in t))
