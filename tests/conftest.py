import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from harborline.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = build_session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.checkpoint.dir": str(base / "shared"),
        "spark.sql.warehouse.dir": str(base / "warehouse"), "spark.ui.showConsoleProgress": "false",
        "spark.log.level": "ERROR"})
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Collected rows as a sorted list of tuples."""
    def collect(df):
        return sorted((tuple(r) for r in df.collect()), key=lambda r: [(v is not None, str(v)) for v in r])

    return collect
