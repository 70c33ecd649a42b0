"""The registered queries: SQL, native plans, and one entry for each operator."""

import hashlib

import __spark_entry__ as entry
import duckdb
import pandas as pd
import pytest

from vitalis.llm import oracle, queries

SF = "/root/testdata/sf0.001"


def plain(x):
    """One form for what pandas has for nulls and for whole numbers."""
    if x is None or pd.api.types.is_scalar(x) and pd.isna(x):
        return None
    x = x.item() if hasattr(x, "item") else x
    return int(x) if isinstance(x, float) and x.is_integer() else x


def digest(df):
    rows = sorted(repr(tuple(map(plain, r))) for r in df[sorted(df.columns)].astype(object).itertuples(index=False, name=None))
    return len(rows), hashlib.sha256("\n".join(rows).encode()).hexdigest()


@pytest.mark.parametrize("key", sorted(oracle.SQL))
def test_sql(spark, key):
    con = duckdb.connect()
    for t in ("documents", "labels", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.execute(oracle.SQL[key]).df()
    got = queries.QUERIES[key](spark, SF).toPandas()
    assert sorted(got.columns) == sorted(want.columns)
    assert digest(got) == digest(want)


@pytest.mark.parametrize("key", ["op1_licenses", "op2_secrets", "op7_pii"])
def test_native_plans(spark, key):
    plan = queries.QUERIES[key](spark, SF)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "InArrow", "ArrowEval"))


def test_every_operator_is_registered():
    found = entry.queries()
    numbers = [k.split("_")[0] for k in found if k.startswith("op")]
    assert sorted(numbers, key=lambda x: int(x[2:])) == [f"op{n}" for n in range(1, 14)]
    assert "pipeline" in found
