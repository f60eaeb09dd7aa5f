import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(8, "tests", 8)


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"


def rows(df, *cols):
    """Rows as a sorted list of tuples."""
    picked = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda t: tuple((v is None, str(v)) for v in t))
