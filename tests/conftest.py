"""One session for all tests, and a way to hold a frame against DuckDB."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import os
import sys

import duckdb
import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SMALL = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse"))).getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture(scope="session")
def duck():
    c = duckdb.connect()
    for path in glob.glob(f"{SMALL}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return c


def plain(v):
    if isinstance(v, float):
        return "nan" if v != v else repr(round(v, 6) + 0.0)
    if isinstance(v, decimal.Decimal):
        return repr(round(float(v), 6) + 0.0)
    if isinstance(v, (list, tuple)):
        return str([plain(x) for x in v])
    return v.isoformat() if isinstance(v, dt.datetime) else str(v)


def rows_of(df):
    names = sorted(df.columns)
    return sorted(tuple(plain(r[n]) for n in names) for r in df.collect())


@pytest.fixture(scope="session")
def same_as_sql(spark, small, duck):
    def check(function, sql):
        df = function(spark, small)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BatchEvalPython" not in plan and "LocalCheckpoint" not in plan
        result = duck.execute(sql)
        names = [x[0] for x in result.description]
        assert sorted(names) == sorted(df.columns)
        at = [names.index(n) for n in sorted(names)]
        assert rows_of(df) == sorted(tuple(plain(r[i]) for i in at) for r in result.fetchall())

    return check
