"""The driver contract: flagship entry, and every query against its oracle."""

import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as contract
from strata.sources.testdata import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def test_entry_flagship(spark):
    df = contract.entry(spark)
    assert df.columns == ["region", "sale_month", "total_revenue", "total_orders", "avg_ticket"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    # the optional training-data operators have tests of their own
    own = {k for k in contract.queries() if k != "pipeline" and not (k.startswith("op") and k[2].isdigit())}
    assert own <= set(contract.oracle_sql()) <= set(contract.queries())


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    return v.isoformat() if hasattr(v, "isoformat") else v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", sorted(contract.oracle_sql()))
def test_query_matches_oracle(spark, con, key):
    df = contract.queries()[key](spark, SF_SMALL)
    cols = sorted(df.columns)
    got = Counter(tuple(_norm(r[c]) for c in cols) for r in df.collect())
    rel = con.execute(contract.oracle_sql()[key])
    names = [d[0] for d in rel.description]
    assert sorted(names) == cols
    want = Counter(tuple(_norm(dict(zip(names, r))[c]) for c in cols) for r in rel.fetchall())
    assert got == want
