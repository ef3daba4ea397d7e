"""A few named queries against their DuckDB twins on sf0.001 (the driver
runs all of them at sf0.01; tools/check_oracle.py does the same locally)."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF001

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    fix = lambda v: "nan" if isinstance(v, float) and math.isnan(v) else repr(v)
    return sorted(tuple(fix(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", ["column_profiles", "profile_top_values", "relationship_tiers",
                                  "semantic_prompts", "discovery_inventory"])
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF001)
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _norm([tuple(r) for r in df.collect()], df.columns) == _norm(res.fetchall(), dcols)
