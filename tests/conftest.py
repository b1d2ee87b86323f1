import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from rollmatch.session import local_session

    s = local_session("*", shuffle_partitions=8, app="rollmatch-tests")
    yield s
    s.stop()


def rows(df, *cols):
    """Collected rows as sorted tuples (NULL-safe ordering)."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=lambda t: tuple((v is None, str(v)) for v in t))
