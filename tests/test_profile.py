"""Column profiles on the tiny fixture frames (FIXTURES.md section 2)."""

import datetime as dt
import decimal
from collections import Counter

from pyspark.sql import functions as F

from cartograph import Analysis, Options, discover_frames


def profile(spark, frames, **opts):
    est = discover_frames(spark, frames, Options(**opts))
    rows = Analysis(est, materialize=False).profiles.collect()
    return {(r.table_name, r.column_name): r for r in rows}


def test_edge_frames(spark):
    frames = {
        "empty": spark.createDataFrame([], "id long, s string"),
        "all_null": spark.createDataFrame([(None,)] * 3, "a string"),
        "one_null": spark.createDataFrame([(1,), (2,), (None,)], "a int"),
        "zero_mean": spark.createDataFrame([(-1.0,), (1.0,)], "x double"),
        "ties": spark.createDataFrame([(v,) for v in "babac"], "s string"),
        "null_slot": spark.createDataFrame([(None,)] * 3 + [("a",)] * 2 + [("b",)], "s string"),
    }
    p = profile(spark, frames, sample_values=2)
    e = p[("empty", "id")]
    assert (e.total_rows, e.null_rate, e.is_unique, e.pk_candidate) == (0, 0.0, False, False)
    a = p[("all_null", "a")]
    assert a.min_value is None and a.max_value is None and a.sample_values == []
    assert (a.distinct_count, a.null_count, a.null_rate) == (1, 3, 1.0)
    o = p[("one_null", "a")]
    assert o.is_unique and not o.pk_candidate and o.null_rate == round(1 / 3, 4)
    assert p[("zero_mean", "x")].mean_value == 0.0
    assert p[("ties", "s")].sample_values == ["a", "b"]
    assert p[("null_slot", "s")].sample_values == ["a"]


def test_odd_types_keep_every_table(spark):
    row = (1, 2, decimal.Decimal("1.50"), dt.date(2024, 1, 2), True, bytearray(b"\x00\xff"),
           dt.timedelta(days=1, seconds=5), (1, "x"), {"k": 1})
    schema = ("b byte, sh short, d decimal(10,2), dd date, f boolean, bin binary, "
              "iv interval day to second, st struct<a:int,b:string>, m map<string,int>")
    df = spark.createDataFrame([row, row], schema).withColumn("v", F.parse_json(F.lit('{"a":1}')))
    p = profile(spark, {"odd": df})
    assert len(p) == 10
    t = {k[1]: r.inferred_type for k, r in p.items()}
    assert t["b"] == "numeric" and t["sh"] == "numeric" and t["d"] == "numeric"
    assert t["dd"] == "datetime" and t["f"] == "boolean_flag" and t["iv"] == "unknown"
    assert t["st"] == "nested" and t["m"] == "nested" and t["bin"] == "unknown"
    assert p[("odd", "m")].distinct_count == 1 and p[("odd", "m")].min_value is None
    assert p[("odd", "bin")].sample_values == ["00FF"]
    assert p[("odd", "d")].mean_value == 1.5


def test_names_and_emails(spark):
    cols = ["id", "order id", "customer_id", "customerID", "is_active", "unit-price", "a.b"]
    df = spark.createDataFrame([tuple(f"v{i}{j}" for i in range(len(cols))) for j in range(3)],
                               ", ".join(f"`{c}` string" for c in cols))
    emails = spark.createDataFrame([("a@example.org",), ("b@example.org",), ("c@example.org",)],
                                   "contact string")
    p = profile(spark, {"names": df, "emails": emails})
    t = {k[1]: r.inferred_type for k, r in p.items()}
    assert t["contact"] == "email"
    assert t["id"] == "identifier" and t["order id"] == "identifier"
    assert t["customer_id"] == "unique_text"        # \b treats _ as a word character
    assert t["customerID"] == "unique_text"         # lower-cased to customerid: no boundary
    assert t["is_active"] == "unique_text" and t["unit-price"] == "monetary_amount"
    assert p[("names", "a.b")].distinct_count == 3  # dotted name read literally
    tok = profile(spark, {"names": df}, name_match="token")
    assert tok[("names", "customer_id")].inferred_type == "identifier"
    assert tok[("names", "is_active")].inferred_type == "boolean_flag"


def test_floats_distinct_and_strings(spark):
    df = spark.createDataFrame([(-0.0,), (0.0,), (float("nan"),), (1e7,), (1.5,)], "x double")
    r = profile(spark, {"floats": df})[("floats", "x")]
    assert r.distinct_count == 4            # -0.0 and 0.0 are one value
    assert set(r.sample_values) == {"0.0", "NaN", "1.0E7", "1.5"}
    assert r.min_value == "0.0"


def test_long_values_keyed_by_digest(spark):
    long_a, long_b = "x" * 300 + "a", "x" * 300 + "b"
    df = spark.createDataFrame([(long_a,), (long_a,), (long_b,), ("short",)], "t string")
    p = profile(spark, {"docs": df}, max_value_chars=128)[("docs", "t")]
    assert p.distinct_count == 3
    assert p.sample_values == [long_a, "short", long_b] or p.sample_values[0] == long_a
    assert long_b in p.sample_values and "short" in p.sample_values
    full = profile(spark, {"docs": df}, max_value_chars=0)[("docs", "t")]
    assert full.distinct_count == 3 and full.sample_values[0] == long_a


def test_sf0001_counts(spark):
    from cartograph import discover
    est = discover(spark, "/root/testdata/sf0.001")
    rows = Analysis(est).profiles.collect()
    assert len(rows) == 63
    assert sum(r.pk_candidate for r in rows) == 27
    for r in rows:  # property checks
        assert r.distinct_count <= r.total_rows + 1
        assert 0.0 <= r.null_rate <= 1.0


def test_batched_plans_same_profiles(spark):
    from cartograph import discover
    cols = ["table_name", "column_name", "total_rows", "null_count", "distinct_count",
            "min_value", "max_value", "mean_value", "sample_values", "inferred_type"]
    one = Analysis(discover(spark, "/root/testdata/sf0.001")).profiles.select(*cols)
    many = Analysis(discover(spark, "/root/testdata/sf0.001",
                             options=Options(datasets_per_plan=3))).profiles.select(*cols)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, many.collect()))


def _typed_frame(spark):
    return spark.sql("""
        SELECT CAST(b AS tinyint) b, CAST(l AS bigint) l, CAST(d AS double) d, CAST(f AS float) f, CAST(day AS date) day,
               CAST(at AS timestamp) at, s
        FROM VALUES (1, 7, '-0.0', '0.1', '2024-02-29', '2024-02-29 01:02:03.000004', '7'),
                    (1, 7, '0.0', '0.1', '1969-12-31', '1969-12-31 23:59:59.5', ''),
                    (-1, -9223372036854775808, 'NaN', '16777216', '2024-02-29', '2024-02-29 01:02:03.000004', null),
                    (null, null, null, null, null, null, 'x'),
                    (2, 1, '1e300', 'Infinity', '0001-01-01', '1900-01-01 00:00:00', 'x') t(b, l, d, f, day, at, s)""")


def test_values_are_printed_after_the_grouping(spark):
    from cartograph.operators import values as V
    from cartograph.sources.discovery import discover_frames
    df = _typed_frame(spark)
    est = discover_frames(spark, {"t": df})
    found = V.column_values(est, 128)
    got = {(r.ordinal, r.key): r.n for r in found.collect()}
    want = Counter()
    for i, f in enumerate(df.schema.fields):
        want.update((i, r[0]) for r in df.select(V.value_key(V.value_string(f), f, 128)).collect())
    assert got == dict(want)
    below = found.drop("s")._jdf.queryExecution().executedPlan().toString().split("Exchange", 1)[1]
    assert "as string" not in below.replace("null as string", "")


def test_numbers_are_compared_apart_from_texts(spark):
    from cartograph.operators import profile as P
    from cartograph.sources.discovery import discover_frames
    est = discover_frames(spark, {"t": spark.range(9).selectExpr("id", "id / 2 AS half", "string(id) AS s")})
    typed = P.typed_stats(est)
    plan = typed._jdf.queryExecution().executedPlan().toString()
    sorted_ones = [line for line in plan.splitlines() if "SortAggregate" in line]
    assert sorted_ones and not any("id#" in line.split("functions=")[1].replace("min(s", "") and "half" in line for line in sorted_ones)
    assert "HashAggregate" in plan
    rows = {r.ordinal: (r.rows, r.known, r.min_value, r.max_value, r.mean_raw) for r in typed.collect()}
    assert rows == {0: (9, 9, "0", "8", 4.0), 1: (9, 9, "0.0", "4.0", 2.0), 2: (9, 9, "0", "8", None)}
