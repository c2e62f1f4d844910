import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from rowproof.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    return local_session("8", app="tests", **{
        "spark.sql.shuffle.partitions": "4",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
    })


@pytest.fixture
def rows():
    """Rows of a frame as a sorted list of tuples, nulls first."""

    def collect(df, *columns):
        picked = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
        return sorted(picked, key=lambda r: [(v is not None, str(v)) for v in r])

    return collect
