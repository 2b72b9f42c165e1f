"""Every registered query against its SQL, on the smallest tables."""

import datetime
import glob
import os

import duckdb
import pytest

import __spark_entry__ as registry

SF_DIR = os.environ.get("LOGTIDE_TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = registry.queries(), registry.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def canonical(rows):
    return sorted(rows, key=lambda row: [(v is None, str(v)) for v in row])


def test_every_query_has_its_sql():
    assert set(ORACLES) <= set(QUERIES)
    own = {name for module in registry._MODULES if module.__name__.startswith("suite.") for name in module.QUERIES}
    assert own <= set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    found = [tuple(row[c] for c in columns) for row in df.collect()]
    cursor = duck.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    wanted = [tuple(row[i] for i in at) for row in cursor.fetchall()]
    assert canonical(found) == canonical(wanted)
    plain = (int, float, str, bool, type(None), datetime.datetime)
    assert all(isinstance(v, plain) for row in found for v in row)


def test_flagship(spark):
    assert registry.entry(spark).count() == 3
