import os
from collections import Counter

import pytest

from docketry.plans.catalog import CORE
from oracle_check import canon

DATA = os.environ.get("DOCKETRY_DATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM read_parquet('{DATA}/{f}')")
    return con


@pytest.mark.parametrize("name", sorted(CORE.queries))
def test_query_against_its_sql(spark, duck, name):
    df = CORE.queries[name](spark, DATA)
    cols = sorted(df.columns)
    rows = Counter(repr([canon(r[c]) for c in cols]) for r in df.collect())
    if name in CORE.sql:
        cur = duck.execute(CORE.sql[name])
        names = [d[0] for d in cur.description]
        assert sorted(names) == cols
        assert rows == Counter(repr([canon(dict(zip(names, r))[c]) for c in cols]) for r in cur.fetchall())


def test_flagship_runs(spark):
    import __spark_entry__

    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert __spark_entry__.entry(spark).count() > 0
