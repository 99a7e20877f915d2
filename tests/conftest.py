import datetime as dt
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from cardsentry.session import build_session

    s = build_session(master="local[*]", shuffle_partitions=8, app="cardsentry-tests")
    yield s
    s.stop()


def ts(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)
