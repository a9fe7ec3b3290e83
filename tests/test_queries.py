"""Every registered query with SQL gives the rows of that SQL on the smallest tables."""

import glob
import os

import duckdb
import pytest

from cohortry.plans.catalogue import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def rows(df):
    """Column names, and the rows as texts in order; whole numbers are the same whether integers or not."""
    columns = sorted(df.columns)
    text = lambda v: "" if v is None or v != v else str(float(v)) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)
    return columns, sorted(tuple(map(text, r)) for r in df[columns].astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, tables, name):
    assert rows(QUERIES[name](spark, SF).toPandas()) == rows(tables.execute(ORACLE_SQL[name]).df())
