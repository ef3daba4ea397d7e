"""Counts from Parquet footers, and statistics on request."""

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from cartograph import Analysis, Options, discover
from cartograph.operators import profile as P
from cartograph.sources.files import has_plain_footer

SF = "/root/testdata/sf0.001"
COUNTS = ("table_name", "column_name", "total_rows", "null_count", "null_rate")


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=str)


def test_counts_equal_a_scan_and_read_no_page(spark):
    a = Analysis(discover(spark, SF))
    assert rows(a.statistics("counts"), *COUNTS) == rows(a.basics, *COUNTS)
    plain = [ds for ds in a.estate.datasets if has_plain_footer(ds)]
    assert len(plain) > 8
    plan = P.footer_counts(a.estate, plain)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PushedAggregation: [COUNT(*)") == len(plain)


def test_only_what_is_asked_for_is_read(spark):
    a = Analysis(discover(spark, SF))
    for need, columns in (("range", ("min_value", "max_value", "min_num", "max_num")), ("mean", ("mean_value",))):
        assert rows(a.statistics(need), "ordinal", *COUNTS[:3], *columns) == rows(a.basics, "ordinal", *COUNTS[:3], *columns)
    customer = [ds for ds in a.estate.datasets if ds.table_name == "customer.parquet"]
    plan = P.typed_stats(a.estate, customer, needs=frozenset({"mean"}))._jdf.queryExecution().executedPlan().toString()
    assert "c_acctbal" in plan and "c_name" not in plan and "c_mktsegment" not in plan


def write(path, statistics=True, **columns):
    pq.write_table(pa.table(columns), str(path), write_statistics=statistics)


@pytest.mark.parametrize("granularity", ["file", "directory"])
def test_files_whose_footers_do_not_tell(spark, tmp_path, granularity):
    """Columns in another order, nested columns, no statistics, odd names, no rows."""
    a, b = pa.array([1, None, 3], pa.int64()), pa.array(["x", None, None])
    write(tmp_path / "one.parquet", a=a, b=b)
    write(tmp_path / "two.parquet", b=b, a=a)
    (tmp_path / "n").mkdir(), (tmp_path / "s").mkdir(), (tmp_path / "e").mkdir()
    write(tmp_path / "n" / "nested.parquet", s=pa.array([{"u": 1, "v": None}] * 3), a=a)
    write(tmp_path / "s" / "silent.parquet", statistics=False, **{"odd.na`me": a, "b": b})
    write(tmp_path / "e" / "empty.parquet", a=a[:0], b=b[:0])
    before = dict(spark.conf.getAll)
    an = Analysis(discover(spark, str(tmp_path), options=Options(granularity=granularity)))
    got = rows(an.statistics("counts"), *COUNTS)
    assert got == rows(an.basics, *COUNTS)
    assert {(t, c): (n, k) for t, c, n, k, _ in got if t in ("silent.parquet", "s")} == {
        (t, c): (3, k) for t in ("silent.parquet", "s") for c, k in (("odd.na`me", 1), ("b", 2))
        if t == ("s" if granularity == "directory" else "silent.parquet")}
    assert dict(spark.conf.getAll) == before
    ordered = [ds for ds in an.estate.datasets if len(ds.reader["paths"]) > 1]
    assert len(ordered) == (granularity == "directory") and not any(map(has_plain_footer, ordered))


def test_a_file_that_cannot_be_read_is_a_warning(spark, tmp_path):
    write(tmp_path / "good.parquet", a=[1, 2])
    write(tmp_path / "bad.parquet", a=[1.5, 2.5])
    estate = discover(spark, str(tmp_path))
    assert estate.row_counts().count() == 2
    (tmp_path / "bad.parquet").write_bytes(b"PAR1 no file PAR1")
    (tmp_path / ".bad.parquet.crc").unlink(missing_ok=True)
    a = Analysis(estate)
    got = {r.table_name: r.total_rows for r in a.statistics("counts").collect()}
    assert got["good.parquet"] == 2 and [w[0].endswith("bad.parquet") for w in a.failures] == [True]
