"""Every registered query of the platform against the same SQL in another engine, at the smallest size."""

import duckdb
import pandas as pd
import pytest
from conftest import DATA

from busmill.plans.oracles import ORACLE_SQL
from busmill.plans.queries import QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows(df: pd.DataFrame) -> list[tuple]:
    def text(v):
        if isinstance(v, list | tuple) or not pd.isna(v):
            return f"{v:.6f}" if isinstance(v, float) else str(v).removesuffix(" 00:00:00")
        return ""

    columns = sorted(df.columns)
    floats = {c for c in columns if str(df[c].dtype).lower().startswith(("float", "int"))}
    return sorted(tuple(text(float(v)) if c in floats and not pd.isna(v) else text(v) for c, v in zip(columns, r, strict=True)) for r in df[columns].astype(object).itertuples(index=False))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def test_each_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    ours, theirs = QUERIES[name](spark, DATA).toPandas(), duck.sql(ORACLE_SQL[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows(ours) == rows(theirs)
