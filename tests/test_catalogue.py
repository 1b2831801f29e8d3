import math
import os

import duckdb
import pandas as pd
import pytest

from weftline.plans import catalogue, catalogue_more, catalogue_rules  # noqa: F401

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        path = f"{SF}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}{'/*.parquet' if os.path.isdir(path) else ''}')")
    return con


def rows(df):
    def plain(v):
        if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
            return ""
        if isinstance(v, bool):
            return str(v)
        if isinstance(v, (int, float)) or hasattr(v, "dtype") or type(v).__name__ == "Decimal":
            return f"{float(v):.9g}"
        return str(v)

    return sorted(tuple(map(plain, r)) for r in df[sorted(df.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_query_equals_its_sql(spark, duck, name):
    own, sql = catalogue.QUERIES[name](spark, SF).toPandas(), duck.execute(catalogue.ORACLES[name]).df()
    assert sorted(own.columns) == sorted(sql.columns)
    assert rows(own) == rows(sql)


def test_queries_without_sql_run(spark):
    for name in set(catalogue.QUERIES) - set(catalogue.ORACLES):
        assert catalogue.QUERIES[name](spark, SF).count()


def test_filters_reach_the_scan(spark):
    plan = catalogue.linked_list(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(c_mktsegment), EqualTo(c_mktsegment,BUILDING)" in plan and "GreaterThan(o_totalprice,200000.0)" in plan
    assert "c_acctbal" not in plan
