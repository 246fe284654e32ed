"""Every registered query on the smallest tables, against its SQL where it has one."""

import os

import pytest

from hazardline.plans.catalog import CATALOG
from hazardline.plans.compare import difference

FOLDER = os.environ.get("CATALOG_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.fixture(scope="module")
def engine():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", list(CATALOG))
def test_query(spark, engine, name):
    run, sql = CATALOG[name]
    df = run(spark, FOLDER)
    got = [tuple(r) for r in df.collect()]
    if sql is None:
        assert got
        return
    cur = engine.execute(sql)
    want = cur.fetchall()
    assert difference((df.columns, got), ([c[0] for c in cur.description], want)) is None
