"""Every registered query against its independently written DuckDB text
(sf0.001 here; the driver repeats this at sf0.01)."""

import hashlib
import math
import os
import subprocess
import sys

import __spark_entry__ as entry
import duckdb
import pandas as pd
import pytest

from vitalis.plans import registry

SF = os.environ.get("VITALIS_TEST_SF", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SQL = registry.oracle_sql()


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if hasattr(v, "item") and not isinstance(v, pd.Timestamp):
        v = v.item()
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return int(v) if v.is_integer() else repr(v)
    if hasattr(v, "isoformat"):
        return pd.Timestamp(v).strftime("%Y-%m-%d %H:%M:%S.%f")
    return v


def _digest(df):
    cols = sorted(df.columns)
    rows = sorted(repr(tuple(_norm(x) for x in r)) for r in df[cols].astype(object).itertuples(index=False, name=None))
    return hashlib.sha1("\n".join(rows).encode()).hexdigest()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle():
    missing = sorted(set(registry.queries()) - set(SQL))
    assert missing == []


@pytest.mark.parametrize("key", sorted(SQL))
def test_query_matches_oracle(spark, con, key):
    got = registry.queries()[key](spark, SF).toPandas()
    exp = con.execute(SQL[key]).df()
    assert sorted(got.columns) == sorted(exp.columns)
    assert len(got) == len(exp)
    assert _digest(got) == _digest(exp)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns[:2] == ["patientid", "hour"]
    assert df.count() > 0


def test_entry_without_the_training_data_operators():
    """The entry still has every sensor key where the subpackage, or a library it needs, cannot be imported."""
    code = "import sys; sys.modules['{}'] = None; import __spark_entry__ as e; from vitalis.plans import registry as r; assert set(e.queries()) == set(r.queries()) == set(e.oracle_sql()) and not e.HAS_LLM"
    for missing in ("vitalis.llm", "corpus_pipeline", *(["tokenizers"] if entry.HAS_LLM else [])):
        subprocess.run([sys.executable, "-c", code.format(missing)], cwd=os.path.dirname(entry.__file__), check=True)


def test_queries_and_oracle_of_the_entry():
    assert set(registry.queries()) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
