"""Scalar functions against their Python definitions (and the DuckDB twins)."""

import difflib
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from cartograph.functions.names import (levenshtein_ratio_sql, name_similarity, name_tokens,
                                        token_jaccard, token_jaccard_sql)
from cartograph.functions.rounding import fixed2, py_round, py_round_sql
from cartograph.functions.text import py_title, py_title_sql

EDGE = [0.665, 2.675, 0.125, 0.375, -0.125, 0.03125, 0.00005, 1.00005, 0.0, -2.5e-5,
        123456.78905, 1e20, -1e-9, 0.1 + 0.2, 0.6 * 0.9 + 0.2 * 0.6212 + 0.2 * 1.0]


def values():
    rng = random.Random(7)
    vs = list(EDGE)
    vs += [rng.uniform(-10, 10) for _ in range(300)]
    vs += [round(rng.uniform(0, 1), 5) for _ in range(300)]   # decimal ties
    vs += [k / 20000 for k in range(0, 400)]                   # rational ties
    return vs


def test_py_round_matches_python(spark):
    vs = values()
    df = spark.createDataFrame([(v,) for v in vs], "x double")
    got = df.select("x", py_round(F.col("x"), 4).alias("r4"), py_round(F.col("x"), 2).alias("r2"),
                    fixed2(F.col("x")).alias("f2")).collect()
    for r in got:
        assert r.r4 == round(r.x, 4), r
        assert r.r2 == round(r.x, 2), r
        assert r.f2 == f"{r.x:.2f}", r


def test_py_round_sql_same_in_duckdb():
    vs = values()
    con = duckdb.connect()
    for v in vs:
        got = con.execute(f"SELECT {py_round_sql(repr(v), 4)}").fetchone()[0]
        assert got == round(v, 4), v


def py_tokens(name):
    t = re.sub(r"([A-Z])", r"_\1", name).lower()
    return {x for x in re.split(r"[_\s\-]+", t) if x}


def py_similarity(a, b):
    ta, tb = py_tokens(a), py_tokens(b)
    j = len(ta & tb) / len(ta | tb) if (ta | tb) else 0.0
    e = difflib.SequenceMatcher(None, a.lower(), b.lower()).ratio()
    return round(0.5 * j + 0.5 * e, 4)


NAMES = ["id", "order id", "customer_id", "customerID", "is_active", "unit-price", "a.b",
         "c_custkey", "o_custkey", "n_nationkey", "s_nationkey", "doc_id", "conv_id", "l2norm",
         "CamelCaseName", "__x__", "r_regionkey", "n_regionkey"]


def test_tokens_and_similarity(spark):
    pairs = [(a, b) for a in NAMES for b in NAMES]
    df = spark.createDataFrame(pairs, "a string, b string")
    rows = df.select("a", "b", name_tokens(F.col("a")).alias("t"),
                     token_jaccard(F.col("a"), F.col("b")).alias("j"),
                     name_similarity(F.col("a"), F.col("b"), "difflib").alias("s")).collect()
    for r in rows:
        assert set(r.t) == py_tokens(r.a)
        ta, tb = py_tokens(r.a), py_tokens(r.b)
        assert r.j == (len(ta & tb) / len(ta | tb) if (ta | tb) else 0.0)
        assert r.s == py_similarity(r.a, r.b), (r.a, r.b)


def test_name_sql_twins(spark):
    con = duckdb.connect()
    for a in NAMES[:8]:
        for b in NAMES[6:]:
            ta, tb = py_tokens(a), py_tokens(b)
            j = len(ta & tb) / len(ta | tb) if (ta | tb) else 0.0
            got = con.execute(f"SELECT {token_jaccard_sql(repr(a), repr(b))}").fetchone()[0]
            assert got == pytest.approx(j), (a, b)
    lev = spark.createDataFrame([("customer_id", "c_custkey")], "a string, b string").select(
        F.levenshtein("a", "b").alias("d")).first().d
    got = con.execute(f"SELECT {levenshtein_ratio_sql(repr('customer_id'), repr('c_custkey'))}"
                      ).fetchone()[0]
    assert got == pytest.approx(1 - lev / 11)


@pytest.mark.parametrize("s", ["l2norm", "order id", "customer id", "x", "ABC def", "a.b",
                               "it's", "unit-price", "ñandú grande"])
def test_py_title(spark, s):
    got = spark.createDataFrame([(s,)], "s string").select(py_title(F.col("s")).alias("t")).first().t
    assert got == s.title()
    con = duckdb.connect()
    lit = "'" + s.replace("'", "''") + "'"
    assert con.execute(f"SELECT {py_title_sql(lit)}").fetchone()[0] == s.title()
