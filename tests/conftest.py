import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from bizmetrics.session import local_session  # noqa: E402

TESTDATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        8,
        app="tests",
        **{
            "spark.sql.shuffle.partitions": "4",
            # Plans are checked as text, so they must not be abridged.
            "spark.sql.maxMetadataStringLength": "10000",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small_dir():
    return f"{TESTDATA}/sf0.001"
