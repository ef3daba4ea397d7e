"""Relationship candidates: overlap edge cases and the sf0.001 expectations."""

from pyspark.sql import functions as F

from cartograph import KEY_DISCOVERY, Analysis, Options, discover, discover_frames
from cartograph.operators import relate as R


def analysis(spark, frames, options=KEY_DISCOVERY):
    return Analysis(discover_frames(spark, frames, options), materialize=False)


def test_mixed_key_types_do_not_match(spark):
    pk = spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string")
    fk = spark.createDataFrame([(1.0,), (2.0,), (1.0,)], "ref double")
    a = analysis(spark, {"pk": pk, "fk": fk})
    assert a.candidates.count() == 0   # values compare as strings: 1 <> 1.0


def test_half_overlap_below_cut(spark):
    pk = spark.createDataFrame([(i,) for i in range(1000, 1100)], "k long")
    # 32 distinct FK values, one of them found among the PK values
    fk = spark.createDataFrame([(1000,)] * 2 + [(i,) for i in range(1, 32)] * 2, "ref long")
    a = analysis(spark, {"pk": pk, "fk": fk})
    ov = R.value_overlap(a.estate, a.column_values, a.profiles,
                         KEY_DISCOVERY.replace(min_overlap=0.0)).collect()
    assert [r.overlap_score for r in ov] == [0.0312]     # 1/32, half-even
    assert a.candidates.count() == 0                      # below 0.05


def test_no_self_reference(spark):
    emp = spark.createDataFrame([(i, (i // 2) if i else None) for i in range(10)],
                                "id long, manager_id long")
    a = analysis(spark, {"employee": emp})
    assert a.candidates.count() == 0


def test_pair_counts_without_enumeration(spark):
    est = discover(spark, "/root/testdata/sf0.001", options=Options())
    a = Analysis(est)
    lit = R.candidate_pair_counts(a.profiles, Options()).agg(F.sum("pk_partners")).first()[0]
    key = R.candidate_pair_counts(a.profiles, KEY_DISCOVERY).agg(F.sum("pk_partners")).first()[0]
    assert (lit, key) == (382, 877)


def test_sf0001_tiers_both_edit_measures(spark):
    est = discover(spark, "/root/testdata/sf0.001", options=KEY_DISCOVERY)
    a = Analysis(est)
    for edit, want in (("difflib", {"auto_accepted": 22, "needs_review": 107, "discarded": 38}),
                       ("levenshtein", {"auto_accepted": 17, "needs_review": 112,
                                        "discarded": 38})):
        opts = KEY_DISCOVERY.replace(edit=edit)
        c = R.candidates(a.estate, a.column_values, a.profiles, opts)
        got = {r[0]: r[1] for r in c.groupBy("status").count().collect()}
        assert got == want, edit
    rows = R.candidates(a.estate, a.column_values, a.profiles, KEY_DISCOVERY).collect()
    for r in rows:                     # property checks
        assert 0.05 <= r.overlap_score <= 1.0
        assert r.cardinality_score in (0.75, 1.0)
    lit = Analysis(discover(spark, "/root/testdata/sf0.001", options=Options())).candidates
    assert {r[0]: r[1] for r in lit.groupBy("status").count().collect()} == {
        "needs_review": 11, "discarded": 1}


def test_same_basename_two_datasets(spark, tmp_path):
    for sub, rows in (("x", [(1,), (2,)]), ("y", [(3,), (4,), (5,)])):
        spark.createDataFrame(rows, "k long").coalesce(1).write.parquet(str(tmp_path / sub / "t"))
    est = discover(spark, str(tmp_path), options=Options(granularity="directory"))
    inv = {r.location.rstrip("/").split("/")[-2]: r.row_count for r in est.inventory().collect()}
    assert inv == {"x": 2, "y": 3}
    a = Analysis(est, materialize=False)
    assert sorted(r.total_rows for r in a.profiles.collect()) == [2, 3]
