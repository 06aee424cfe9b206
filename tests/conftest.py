from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from windrow.schemas import CARRIER, FLIGHTS  # noqa: E402
from windrow.session import local_session  # noqa: E402

TESTDATA = Path("/root/testdata")


#: Few tasks per job, as the test tables are tiny.
SMALL = {"spark.sql.shuffle.partitions": "2", "spark.default.parallelism": "2"}


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    session = local_session(8, app="tests", **SMALL, **{"spark.checkpoint.dir": shared})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    folder = TESTDATA / "sf0.001"
    if not folder.exists():
        pytest.skip("test tables are not there")
    return str(folder)


@pytest.fixture
def table(tmp_path):
    return str(tmp_path / "table")


#: A record that passes every quality rule.
GOOD = {
    "flight_id": "0" * 32, "Year": 2024, "Month": 1, "DayofMonth": 5, "DayOfWeek": 5,
    CARRIER: "AA", "Origin": "JFK", "Dest": "LAX", "CRSDepTime": 930, "CRSArrTime": 1200,
    "DepDelay": 5.0, "ArrDelay": 7.0, "Cancelled": 0.0, "Diverted": 0.0,
    "Distance": 500.0, "AirTime": 60.0,
}


@pytest.fixture
def flights(spark):
    """Makes a frame of records, each the good record with some values changed."""

    def make(*changes: dict):
        rows = []
        for number, change in enumerate(changes):
            row = {**GOOD, "flight_id": f"{number:032x}", **change}
            rows.append(tuple(row[name] for name in FLIGHTS.names))
        return spark.createDataFrame(rows, FLIGHTS)

    return make
