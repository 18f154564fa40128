import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from signalyard.session import build_session
    s = build_session("local[8]", shuffle_partitions=8)
    yield s
    s.stop()


def local(path: str) -> str:
    """Plain local path of a ``file:`` URI (tests write fixture files with
    Python I/O; the library itself only uses Spark/Hadoop paths)."""
    return path[len("file:"):] if path.startswith("file:") else path
