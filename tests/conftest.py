import datetime as dt
import decimal
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    import tempfile
    from cohortcast.session import build_session, shared_dir
    # catalog tables written by tests go to a fresh scratch folder
    wh = tempfile.mkdtemp(prefix="run-warehouse-", dir="/tmp")
    s = build_session(master="local[*]", shuffle_partitions=8, app="cohortcast-tests",
                      extra={"spark.sql.warehouse.dir": wh})
    shared_dir(s)  # sets a private checkpoint folder only when none is configured
    yield s


def mk(spark, ddl: str, rows: list[tuple]):
    return spark.createDataFrame(rows, ddl)


D = dt.date
TS = dt.datetime


# The cube's carried sums (functions.numeric): exact, plain, terms beyond decimal.
CUBE_SUMS = ", ".join(f"{m}_exact decimal(38,16), {m}_plain double, {m}_odd long" for m in ("net_revenue", "trips"))


def cube_sum(x: float):
    return (decimal.Decimal(str(x)), x, 0)
