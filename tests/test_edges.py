"""Inputs that the given tables do not have: ties, odd types, zones, damaged and odd files, failing models."""

import decimal
import os
import threading

import pandas as pd
from pyspark.sql import functions as F

from cartograph import KEY_DISCOVERY, Analysis, Options, discover, discover_frames, get_review_queue, run_pipeline
from cartograph.operators import relate as R
from cartograph.operators import semantic as S


def profile(spark, frames, materialize=False, **opts):
    est = discover_frames(spark, frames, Options(**opts))
    return {(r.table_name, r.column_name): r for r in Analysis(est, materialize=materialize).profiles.collect()}


def test_all_batches_without_materialisation(spark):
    frames = {f"t{k}": spark.createDataFrame([(k,)], "x long") for k in range(3)}
    assert len(profile(spark, frames, datasets_per_plan=1)) == 3


def test_no_column_cap_by_default(spark):
    wide = spark.createDataFrame([tuple([f"v{k}" for k in range(60)])] * 2, ", ".join(f"c{k} string" for k in range(60)))
    a = Analysis(discover_frames(spark, {"wide": wide}, Options()), materialize=False)
    assert R.fk_columns(a.profiles, Options()).count() == 60
    capped = Options(max_cols_per_table=50)
    assert R.fk_columns(a.profiles, capped).count() == 50
    assert sorted(r.ordinal for r in R.left_out_columns(a.profiles, capped).collect()) == list(range(50, 60))


def test_tied_long_values_rank_by_value(spark):
    texts = ["z" * 150 + c for c in "kgeabcdf"] + ["z" * 128, "y" * 200]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = profile(spark, {"d": df}, sample_values=4)["d", "t"]
    assert got.sample_values == sorted(texts)[:4] and got.distinct_count == 10
    assert (got.min_value, got.max_value) == (min(texts), max(texts))


def test_nested_values_are_told_apart(spark):
    df = spark.sql("SELECT array('a, b') v, named_struct('x', 'null') s UNION ALL "
                   "SELECT array('a', 'b'), named_struct('x', cast(null as string)) UNION ALL SELECT null, null")
    p = profile(spark, {"n": df})
    assert p["n", "v"].distinct_count == 3 and p["n", "s"].distinct_count == 3
    assert p["n", "v"].sample_values == ["[a, b]", "[a, b]"] and p["n", "v"].null_count == 1


def test_instants_in_a_zone_with_a_repeated_hour(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql("SELECT timestamp_seconds(1730611800) t UNION ALL SELECT timestamp_seconds(1730615400)")
        got = profile(spark, {"z": df})["z", "t"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got.distinct_count == 2 and got.pk_candidate
    assert (got.min_value, got.max_value) == ("2024-11-03 05:30:00", "2024-11-03 06:30:00")


def test_decimals_floats_and_far_dates(spark):
    d = decimal.Decimal
    df = spark.createDataFrame([(d("1.000000000001"), d(10 ** 37), 16777.217), (d("1.000000000002"), d(2), 16777.217)],
                               "a decimal(20,12), b decimal(38,0), f float")
    df = df.withColumn("day", F.when(F.col("b") > 5, F.expr("make_date(10000, 1, 1)")).otherwise(F.expr("make_date(2024, 1, 1)")))
    p = profile(spark, {"n": df})
    assert p["n", "a"].max_value == "1.000000000002" and p["n", "b"].max_value == str(10 ** 37)
    assert p["n", "f"].mean_value == 16777.2168
    assert (p["n", "day"].min_value, p["n", "day"].max_value) == ("2024-01-01", "+10000-01-01")


def test_model_is_called_once_a_table_in_several_tasks(spark, tmp_path):
    frames = {f"t{k}": spark.createDataFrame([(k,)], "x long") for k in range(12)}
    a = Analysis(discover_frames(spark, frames, Options()), materialize=False)
    folder = str(tmp_path)

    def model(pdf: pd.DataFrame) -> list:
        import uuid
        from pyspark import TaskContext
        name = pdf["table_name"].iloc[0]
        open(f"{folder}/{name}-{TaskContext.get().partitionId()}-{uuid.uuid4().hex}", "w").close()
        if name == "t3":
            raise RuntimeError("no answer")
        return ['[{"column_name": "x", "confidence": 0.9}]']

    replies = S.ask(a.profiles, Options(provider=model, model_tasks=4))
    assert S.annotations(replies, a.profiles, Options()).filter("from_reply").count() == 11
    calls = [f.split("-") for f in os.listdir(folder)]
    assert sorted(c[0] for c in calls) == sorted(frames) and len({c[1] for c in calls}) > 1
    assert [(r.table_name, "no answer" in r.error) for r in S.failures(replies).collect()] == [("t3", True)]


def test_options_with_a_stateful_provider():
    class Model:
        lock = None

        def __init__(self):
            self.lock = threading.Lock()

        def __call__(self, pdf):
            return []

    opts = Options(provider=Model(), jdbc_sources=({"name": "s", "url": "jdbc:x://u:secret@h", "password": "p"},))
    kept = opts.replace(sample_values=3).snapshot(({"name": "t", "url": "secret"},))
    assert kept["provider"] == "Model" and "secret" not in str(kept) and len(kept["jdbc_sources"]) == 2


def test_odd_paths_and_folders(spark, tmp_path):
    root = tmp_path / "my lake+x"
    one = spark.createDataFrame([(1, "a"), (2, "b")], "id long, s string")
    one.coalesce(1).write.parquet(str(root / "plain dir"))
    one.withColumn("p", F.col("id") * 10).write.partitionBy("p").parquet(str(root / "table"))
    mixed = root / "mixed"
    one.coalesce(1).write.parquet(str(mixed))
    (mixed / "extra.csv").write_text("q,r\n1,x\n2,y\n3,z\n")
    est = discover(spark, [str(root), str(tmp_path / "absent")], options=Options(granularity="directory"))
    assert [w[0] for w in est.warnings] == [str(tmp_path / "absent")]
    got = {(r.table_name, r.format): (r.row_count, sorted(r.columns)) for r in est.inventory().collect()}
    assert got == {("plain dir", "parquet"): (2, ["id", "s"]), ("table", "parquet"): (2, ["id", "p", "s"]),
                   ("mixed", "parquet"): (2, ["id", "s"]), ("mixed", "csv"): (3, ["q", "r"])}
    assert all(est.load(d).count() == est.row_count(d) for d in est.datasets)


def test_damaged_table_is_a_warning(spark, tmp_path):
    for k in range(5):
        (spark.range(20_000).select(F.col("id").alias(f"c{k}"), F.sha2(F.col("id").cast("string"), 256).alias("s"))
         .coalesce(1).write.option("compression", "none").parquet(str(tmp_path / "in" / f"t{k}")))
    bad = next((tmp_path / "in" / "t2").glob("*.parquet"))
    (tmp_path / "in" / "t2" / f".{bad.name}.crc").unlink()
    raw = bytearray(bad.read_bytes())
    raw[4:60_000] = os.urandom(60_000 - 4)
    bad.write_bytes(bytes(raw))
    opts = KEY_DISCOVERY.replace(output_schema="cg_damaged", granularity="directory", artefacts_path=str(tmp_path / "a"))
    out = run_pipeline(spark, str(tmp_path / "in"), opts, table_location=str(tmp_path / "t"))
    assert (out["status"], out["datasets_found"], out["columns_profiled"], out["warnings"]) == ("complete", 4, 8, 1)
    assert "t2" in spark.read.text(f"{out['artefacts_dir']}/warnings").first().value


def test_queue_follows_the_newest_complete_run(spark, tmp_path):
    spark.createDataFrame([(k,) for k in range(9)], "id long").coalesce(1).write.parquet(str(tmp_path / "a" / "x"))
    spark.createDataFrame([(k % 9,) for k in range(30)], "id long").coalesce(1).write.parquet(str(tmp_path / "a" / "y"))
    spark.createDataFrame([(1,), (1,)], "v long").coalesce(1).write.parquet(str(tmp_path / "b" / "z"))
    opts = KEY_DISCOVERY.replace(output_schema="cg_queue", granularity="directory", auto_accept=2.0, human_review=0.0,
                                 artefacts_path=str(tmp_path / "art"))
    loc = str(tmp_path / "t")
    run_pipeline(spark, str(tmp_path / "a"), opts, table_location=loc)
    assert get_review_queue(spark, opts)["relationships_pending_review"] == 1
    run_pipeline(spark, str(tmp_path / "absent"), opts, table_location=loc)  # stops without data
    assert get_review_queue(spark, opts)["relationships_pending_review"] == 1
    run_pipeline(spark, str(tmp_path / "b"), opts, table_location=loc)
    assert get_review_queue(spark, opts)["relationships_pending_review"] == 0
