"""Every query of the library's own operators against its SQL."""

import math
import os

import duckdb
import pytest

from wideskein.plans import queries as plans

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def rows(frame):
    names = sorted(frame.columns)
    plain = lambda v: "nan" if isinstance(v, float) and math.isnan(v) else f"{v:.10g}" if isinstance(v, float) else str(v)
    return names, sorted(tuple(plain(v) for v in r) for r in frame[names].astype(object).where(frame[names].notna(), None).values.tolist())


@pytest.mark.parametrize("name", sorted(plans.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    found = rows(plans.queries()[name](spark, SF).toPandas())
    assert found == rows(duck.execute(plans.oracle_sql()[name]).df())


def test_every_query_has_sql():
    assert set(plans.queries()) == set(plans.oracle_sql())


def test_entry_is_stable(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.columns == ["time", "flight_id", "class", "altitude"] and df.count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
