"""Every registered engine query against its oracle in DuckDB, on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from variantloom import plans

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"):
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 5) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return float(v) if type(v).__name__ == "Decimal" else v


def table(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(float(x) if isinstance(x, int) and not isinstance(x, bool) else x for x in (plain(r[i]) for i in order)) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(plans.QUERIES))
def test_query(spark, con, name):
    df = plans.QUERIES[name](spark, SF)
    got = df.collect()
    if name in plans.ORACLES:
        want = con.sql(plans.ORACLES[name])
        assert sorted(df.columns) == sorted(want.columns)
        assert table(got, df.columns) == table(want.fetchall(), want.columns)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and df.columns == ["rsid", "chrom", "pos", "pvalue", "gene_id", "score", "rank"]
    assert set(plans.QUERIES) <= set(entry.queries()) and set(plans.ORACLES) <= set(entry.oracle_sql())
