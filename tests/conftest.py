import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from strata.session import build_session, shared_dir  # noqa: E402
from strata.sources.paths import Lake  # noqa: E402

@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "local[4]",
        app_name="strata-tests",
        shuffle_partitions=4,
        extra_conf={"spark.ui.enabled": "false", "spark.sql.adaptive.enabled": "true"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture()
def lake(spark):
    root = tempfile.mkdtemp(prefix="lake-", dir=_scratch_root(spark))
    return Lake(root)


def _scratch_root(spark) -> str:
    base = shared_dir(spark)
    if base.startswith("file:"):
        base = base[len("file:"):]
    Path(base).mkdir(parents=True, exist_ok=True)
    return base
