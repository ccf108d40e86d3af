import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DATA = os.environ.get("WARDGRID_TESTDATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from wardgrid.session import get_spark, ship_package

    session = get_spark("tests", 4)
    ship_package(session)
    session.conf.set("spark.sql.shuffle.partitions", "5")
    yield session


@pytest.fixture
def data():
    if not os.path.exists(DATA):
        pytest.skip("no test tables")
    return DATA


def rows(df, *columns):
    """The rows as sorted tuples, nulls first."""
    picked = [tuple(r) for r in df.select(*columns).collect()] if columns else [tuple(r) for r in df.collect()]
    return sorted(picked, key=lambda r: [(v is not None, v) for v in r])
