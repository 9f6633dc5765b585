import os
import sys
import warnings
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
warnings.filterwarnings("ignore")
FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from tillwork.session import local_session

    session = local_session(8, "tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return FOLDER


def values(df, *columns):
    """Rows as sorted tuples."""
    rows = (df.select(*columns) if columns else df).collect()
    return sorted((tuple(r) for r in rows), key=repr)
