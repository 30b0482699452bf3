import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from terrella.plans.views import TABLES, Tables  # noqa: E402
from terrella.session import local_session  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("shared"))
    session = local_session(8, 4, **{"spark.checkpoint.dir": folder})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables(spark):
    return Tables(spark, DATA)


@pytest.fixture(scope="session")
def seven_parts(spark, tables, tmp_path_factory):
    """The same tables with their rows shuffled into seven files each."""
    folder = tmp_path_factory.mktemp("seven")
    for name in TABLES:
        getattr(tables, name).repartition(7).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)
