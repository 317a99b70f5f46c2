import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))
sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from compare import SMALL  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from tradewind.session import build_session

    session = build_session("tests", "local[8]", **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture(scope="session")
def warehouse(spark):
    from tradewind.plans.warehouse import open_generated

    return open_generated(spark, SMALL)


@pytest.fixture
def store(spark):
    from tradewind.session import scratch_path
    from tradewind.sources.tables import TableStore

    return TableStore(spark, scratch_path(spark, "test-store"))


@pytest.fixture(autouse=True, scope="module")
def no_views_left(spark):
    """Views that a module registers end with it: ``listTables`` shows them under every database."""
    yield
    for t in spark.catalog.listTables():
        if t.isTemporary:
            spark.catalog.dropTempView(t.name)
