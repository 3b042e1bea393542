from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from shoplens.session import get_session
    s = get_session("local[4]", shuffle_partitions=4, app_name="shoplens-tests")
    yield s
    s.stop()


def rows(df, *cols):
    """Sorted list of tuples of the given columns (all columns if none)."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=_key)


def _key(row):
    return tuple((x is not None, "" if x is None else x) for x in row)
