"""The driver contract, and every oracle twin checked against DuckDB at sf0.001."""

import hashlib
import math
from pathlib import Path

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert len(df.columns) == 17 and df.count() > 0


def test_every_oracle_key_is_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = Path(SF) / f"{t}.parquet"
        if p.exists():
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "null"
    if isinstance(v, (int, float)) and not isinstance(v, bool):
        r = round(float(v), 5)
        return repr(0.0 if r == 0 else r)
    if isinstance(v, pd.Timestamp):
        return v.isoformat()
    return repr(v)


def _digest(pdf):
    cols = sorted(pdf.columns)
    obj = pdf[cols].astype(object).where(pdf[cols].notna(), None)
    rows = sorted("|".join(_norm(x) for x in r) for r in obj.itertuples(index=False, name=None))
    return len(pdf), cols, hashlib.sha256("\n".join(rows).encode()).hexdigest()


@pytest.mark.parametrize("key", sorted(E.oracle_sql()))
def test_oracle_twin(spark, con, key):
    got = _digest(E.queries()[key](spark, SF).toPandas())
    exp = _digest(con.execute(E.oracle_sql()[key]).df())
    assert got == exp
