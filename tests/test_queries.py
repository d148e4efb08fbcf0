"""Every registered query of the package's own operators against its SQL."""

from __future__ import annotations

import math

import duckdb
import pandas as pd
import pytest

from pagemill.plans import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def value(x):
    if x is None or x is pd.NaT or x is pd.NA or (isinstance(x, float) and math.isnan(x)):
        return None
    if isinstance(x, bool):
        return x
    try:
        return round(float(x), 9)
    except (TypeError, ValueError):
        return str(x)


def plain(df: pd.DataFrame) -> list:
    df = df[sorted(df.columns)]
    return sorted(repr(tuple(map(value, row))) for row in df.itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_agrees_with_its_sql(spark, sf, duck, name):
    got = registry.QUERIES[name](spark, sf).toPandas()
    if name in registry.ORACLES:
        want = duck.execute(registry.ORACLES[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert plain(got) == plain(want)
    assert len(got) or name == "pending_page_cursor"  # the smallest table has one page


def test_queries_without_sql_are_few():
    assert set(registry.QUERIES) - set(registry.ORACLES) == {"text_similarity"}
