import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from traitrank.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    scratch = tmp_path_factory.mktemp("spark")
    session = local_session(
        8,
        **{
            "spark.checkpoint.dir": f"{scratch}/shared",
            "spark.sql.warehouse.dir": f"{scratch}/warehouse",
        },
    )
    yield session
    session.stop()


@pytest.fixture
def database(spark):
    from traitrank.plans.queries import scratch_database

    name = scratch_database(spark)
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")
