"""Result tables whose writers' schemas differ."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartograph import KEY_DISCOVERY, get_review_queue, run_pipeline
from cartograph.operators import runs as RUN
from cartograph.operators import tables

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def schema(spark):
    spark.sql("CREATE SCHEMA IF NOT EXISTS cg_tables")
    yield "cg_tables"
    spark.sql("DROP SCHEMA cg_tables CASCADE")


def test_newer_and_older_writers(spark, schema, tmp_path):
    name, path = f"{schema}.t", str(tmp_path / "t")
    assert tables.append(spark.range(2).selectExpr("id", "'a' AS s"), name, "parquet", path) == []
    newer = spark.range(2).selectExpr("id", "'b' AS S", "named_struct('x', 1, 'odd name', array('q')) AS st", "null AS untyped")
    assert tables.append(newer, name, "parquet", path) == ["st"]
    assert tables.append(spark.range(1), name, "parquet", path) == []
    got = sorted(map(tuple, spark.table(name).selectExpr("id", "s", "st.`odd name`[0]").collect()), key=str)
    assert got == sorted([(0, "a", None), (1, "a", None), (0, "b", "q"), (1, "b", "q"), (0, None, None)], key=str)


def test_types(spark, schema):
    name = f"{schema}.kinds"
    tables.append(spark.sql("SELECT 1L AS n, 1.5D AS x, array(1L) AS a, cast(1 AS decimal(20,4)) AS d"), name, "parquet")
    tables.append(spark.sql("SELECT cast(2 AS short) AS n, 2 AS x, array(2) AS a, cast(2 AS decimal(10,2)) AS d"), name, "parquet")
    assert [f.dataType.simpleString() for f in spark.table(name).schema] == ["bigint", "double", "array<bigint>", "decimal(20,4)"]
    assert spark.table(name).selectExpr("sum(n)", "sum(x)", "sum(a[0])", "cast(sum(d) AS int)").first()[:] == (3, 3.5, 3, 3)
    for bad in ("'x' AS n", "2.5D AS n", "map('k', 1) AS a", "cast(1 AS decimal(30,2)) AS d", "1L AS x"):
        with pytest.raises(tables.SchemaConflict):
            tables.append(spark.sql(f"SELECT {bad}, 1 AS fresh"), name, "parquet")
    assert "fresh" not in spark.table(name).columns and spark.table(name).count() == 2


def test_a_folder_the_catalog_does_not_know(spark, schema, tmp_path):
    name, path = f"{schema}.old", str(tmp_path / "old")
    tables.append(spark.range(3).selectExpr("id", "id * 2 AS twice"), name, "parquet", path)
    tables.append(spark.range(1).selectExpr("id", "true AS later"), name, "parquet", path)
    spark.sql(f"DROP TABLE {name}")  # the files stay
    tables.append(spark.range(1).selectExpr("id", "'x' AS third"), name, "parquet", path)
    assert sorted(spark.table(name).columns) == ["id", "later", "third", "twice"]
    assert spark.table(name).selectExpr("count(*)", "count(twice)", "count(later)", "count(third)").first()[:] == (5, 3, 1, 1)


def test_another_writer_is_first(spark, schema, monkeypatch):
    name = f"{schema}.race"
    tables.append(spark.range(1), name, "parquet")
    real = tables.add_columns

    def late(spark, name, fields):
        monkeypatch.setattr(tables, "add_columns", real)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS (s string)")  # meanwhile, elsewhere
        real(spark, name, fields)

    monkeypatch.setattr(tables, "add_columns", late)
    assert tables.append(spark.range(1).selectExpr("id", "'v' AS s", "1 AS k"), name, "parquet") == ["k"]
    assert spark.table(name).selectExpr("count(s)", "count(k)").first()[:] == (1, 1)


def test_conform(spark):
    schema = T.StructType([T.StructField("b", T.LongType()), T.StructField("gone", T.StringType())])
    df = spark.sql("SELECT 1 AS a, 2 AS B, 3 AS `c.d`")
    assert tables.conform(df, schema).columns == ["b", "gone"]
    out = tables.conform(df, schema, keep_others=True)
    assert out.columns == ["b", "gone", "a", "c.d"] and out.first()[:] == (2, None, 1, 3) and out.schema["b"].dataType == T.LongType()


def test_run_records_and_queue_of_an_older_version(spark, tmp_path):
    """Tables that an older version made, without columns of today's, take today's runs."""
    opts = KEY_DISCOVERY.replace(provider="rules", output_schema="cg_older", artefacts_path=str(tmp_path / "art"))
    loc = str(tmp_path / "t")
    RUN.ensure_schema(spark, opts)
    old = spark.sql("SELECT 'run_0' AS run_id, timestamp'2020-01-01 00:00:00' AS run_ts, 'complete' AS status")
    tables.append(old, "cg_older.pipeline_runs", "parquet", f"{loc}/pipeline_runs")
    tables.append(old.selectExpr("run_id", "run_ts", "'t' AS table_name", "'x' AS note"), RUN.table_name(opts, "semantic"),
                  "parquet", f"{loc}/{opts.tables['semantic']}")
    out = run_pipeline(spark, SF, opts, table_location=loc)
    assert out["status"] == "complete"
    runs = RUN.read_table(spark, "cg_older.pipeline_runs", RUN.RUNS_SCHEMA).orderBy("run_ts").collect()
    assert [(r.run_id, r.summary_json is None) for r in runs] == [("run_0", True), (out["run_id"], False)]
    sem = spark.table(RUN.table_name(opts, "semantic"))
    assert sem.where("note IS NOT NULL").count() == 1 and sem.where("business_label IS NOT NULL").count() == 63
    assert get_review_queue(spark, opts)["relationships_pending_review"] == 107


def test_artefacts_are_read_back(spark, tmp_path):
    df = spark.sql("SELECT 1 AS a, 'x' AS b")
    RUN.write_artefact(df, str(tmp_path), "one")
    RUN.write_artefact(df.limit(0), str(tmp_path), "none")
    assert RUN.read_artefact(spark, str(tmp_path), "one").first()[:] == (1, "x")
    assert RUN.read_artefact(spark, str(tmp_path), "none", "a int, b string").count() == 0
