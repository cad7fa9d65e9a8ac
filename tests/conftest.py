import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from tierlake.session import local_session, run_dir, to_local  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, shuffle_partitions=8, app="tierlake-tests")
    yield s


@pytest.fixture
def workdir(spark):
    """A fresh folder under the shared checkpoint root (a local path in tests)."""
    d = run_dir(spark, "test")
    os.makedirs(to_local(d), exist_ok=True)
    return to_local(d)


def write_text(path: str, text: str, encoding: str = "ISO-8859-1") -> None:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding=encoding, newline="") as f:
        f.write(text)
