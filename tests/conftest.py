import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from gigframe.session import build_session

    s = build_session("local[*]", shuffle_partitions=8,
                      extra={"spark.ui.showConsoleProgress": "false"})
    yield s
    s.stop()


def rows(df, *cols):
    """Sorted list of tuples (of ``cols`` or all columns)."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=lambda t: tuple(map(repr, t)))
