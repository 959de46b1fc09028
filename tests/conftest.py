import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from quillmill.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=8, app="tests")
    yield session
    session.stop()


@pytest.fixture()
def small_buckets(monkeypatch):
    """Many key ranges on little data, so that the two-level paths are used."""
    from quillmill.operators import ordering

    original = ordering.range_bucket
    monkeypatch.setattr(ordering, "range_bucket", lambda df, order, least=None: original(df, order, rows_per_bucket=7))
