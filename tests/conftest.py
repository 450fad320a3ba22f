import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_GATE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from needbridge.session import local_session

    ckpt = tempfile.mkdtemp(prefix="nb-test-ckpt-")
    s = local_session("*", shuffle_partitions=8, app="needbridge-tests", checkpoint_dir=ckpt)
    yield s
    s.stop()


def rows(df, order=None):
    """Collected rows as plain tuples, sorted (None sorts first)."""
    out = [tuple(r) for r in df.collect()]
    key = (lambda t: tuple((v is not None, v) for v in t))
    return sorted(out, key=key) if order is None else out
