"""File discovery: formats, counts, an unreadable file, other extensions."""

import gzip

from cartograph import Options, discover


def test_mixed_files(spark, tmp_path):
    root = tmp_path / "vol"
    (root / "sub").mkdir(parents=True)
    spark.createDataFrame([(1, "a"), (2, "b")], "id long, s string").toPandas().to_parquet(
        root / "t1.parquet")
    (root / "sub" / "people.CSV").write_text("id,name\n1,ann\n\n2,bob\n3,cy\n")
    (root / "events.json").write_text('{"k": 1, "v": "x"}\n{"k": 2, "v": "y"}\n')
    (root / "broken.parquet").write_bytes(b"not a parquet file")
    (root / "notes.txt").write_text("ignored")
    est = discover(spark, str(root), options=Options())
    inv = {r.table_name: r for r in est.inventory().collect()}
    assert set(inv) == {"t1.parquet", "people.CSV", "events.json"}
    assert inv["t1.parquet"].row_count == 2
    assert inv["people.CSV"].row_count == 3           # blank line skipped, header not counted
    assert inv["events.json"].row_count == 2
    assert inv["people.CSV"].raw_schema == {"id": "IntegerType()", "name": "StringType()"}
    assert len(est.warnings) == 1 and est.warnings[0][0].endswith("broken.parquet")
    cols = {(r.table_name, r.column_name) for r in est.columns().collect()}
    assert ("events.json", "v") in cols


def test_extensions_option(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x\n1\n")
    (tmp_path / "b.json").write_text('{"x": 1}\n')
    est = discover(spark, str(tmp_path), options=Options(extensions=(".parquet", ".csv")))
    assert [d.table_name for d in est.datasets] == ["a.csv"]


def test_sampling(spark):
    from cartograph import Analysis
    est = discover(spark, "/root/testdata/sf0.001", options=Options(sample_rows=500))
    rows = {r.table_name: r.total_rows for r in Analysis(est, materialize=False).profiles.collect()}
    assert rows["region.parquet"] == 5          # small tables are read whole
    assert 300 < rows["lineitem.parquet"] < 700  # Bernoulli: about, not at most, 500


def _folder_parts(spark, root):
    """Two tables that are folders of part files of the same names."""
    for table, frame in (("docs", "id long, text string"), ("pages", "id long, url string, n int")):
        for part in range(2):
            rows = [(i, f"v{i}", part)[:2 if table == "docs" else 3] for i in range(2 + part)]
            (root / f"{table}.parquet").mkdir(exist_ok=True)
            spark.createDataFrame(rows, frame).toPandas().to_parquet(root / f"{table}.parquet" / f"part-{part}.parquet")
    return str(root)


def test_csv_copies_of_files_of_the_same_name(spark, tmp_path):
    from cartograph.plans import queries as Q
    found = Q.discover_csv(spark, _folder_parts(spark, tmp_path)).collect()
    assert sorted(tuple(r) for r in found) == [("part-0", "csv", 2, 2), ("part-0", "csv", 2, 3),
                                               ("part-1", "csv", 3, 2), ("part-1", "csv", 3, 3)]


def test_json_copies_of_files_of_the_same_name(spark, tmp_path):
    from cartograph.plans import queries as Q
    found = Q.discover_json(spark, _folder_parts(spark, tmp_path)).collect()
    assert sorted(tuple(r) for r in found) == [("part-0", "json", 2, 2), ("part-0", "json", 2, 3),
                                               ("part-1", "json", 3, 2), ("part-1", "json", 3, 3)]


def _copied(spark, call):
    """The rows of ``call`` and the part files it wrote under the scratch folder."""
    from pathlib import Path

    from cartograph import plan_utils as pu
    at = Path(pu.scratch_path(spark, "derived"))
    before = set(at.rglob("part-*"))
    return sorted(tuple(r) for r in call().collect()), sorted(set(at.rglob("part-*")) - before)


def test_json_copies_are_not_many_times_their_tables(spark, tmp_path, monkeypatch):
    from cartograph.plans import queries as Q
    rows = spark.range(30_000).selectExpr("id AS a_rather_long_key", "id % 7 AS another_long_name",
                                          "date_add(DATE'2020-01-01', CAST(id % 900 AS INT)) AS day_of_shipping")
    rows.toPandas().to_parquet(tmp_path / "t.parquet")
    found, files = _copied(spark, lambda: Q.discover_json(spark, str(tmp_path)))
    assert found == [("t", "json", 30_000, 3)]
    assert sum(f.stat().st_size for f in files) < 2 * (tmp_path / "t.parquet").stat().st_size
    # no file holds more than a task should read alone; all rows are there
    monkeypatch.setitem(Q.JSON_COPY, "maxRecordsPerFile", "7000")
    found, files = _copied(spark, lambda: Q.discover_json(spark, str(tmp_path)))
    assert found == [("t", "json", 30_000, 3)]
    records = [sum(1 for _ in gzip.open(f)) for f in files]
    assert sum(records) == 30_000 and max(records) == 7000


def test_json_copies_of_empty_and_null_tables(spark, tmp_path):
    from cartograph.plans import queries as Q
    for name, rows in (("empty", []), ("nulls", [(None, None)] * 3), ("some", [(1, None), (None, "x")])):
        spark.createDataFrame(rows, "id long, s string").coalesce(1).write.parquet(str(tmp_path / name))
    found = sorted(tuple(r)[1:] for r in Q.discover_json(spark, str(tmp_path)).collect())
    assert found == [("json", 2, 2), ("json", 3, 0)]


def test_compressed_json_is_found_where_asked_for(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"x": 1}\n')
    with gzip.open(tmp_path / "b.JSON.gz", "wt") as f:
        f.write('{"x": 1, "y": "p"}\n{"x": 2}\n')
    with gzip.open(tmp_path / "c.csv.gz", "wt") as f:
        f.write("x\n1\n")
    found = lambda **o: {r.table_name: (r.format, r.row_count, r.columns)
                         for r in discover(spark, str(tmp_path), options=Options(**o)).inventory().collect()}
    assert found() == {"a.json": ("json", 1, ["x"])}
    assert found(extensions=(".json.gz",)) == {"b.JSON.gz": ("json", 2, ["x", "y"])}
