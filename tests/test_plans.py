"""Physical-plan properties the design depends on (checked with explain)."""

from cartograph import KEY_DISCOVERY, Analysis, discover
from cartograph.operators import profile as P
from cartograph.operators import relate as R
from cartograph.operators import values as V

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_frequency_table_one_shuffle(spark):
    est = discover(spark, SF)
    p = plan_of(V.column_values(est, 128))
    assert p.count("Expand") == len(est.datasets)          # one un-pivot per dataset
    assert p.count("Exchange") == 1                          # a single shuffle
    assert "partial_count" in p                              # map-side combine


def test_top_n_limited_before_shuffle(spark):
    est = discover(spark, SF)
    p = plan_of(P.ranked_keys(V.column_values(est, 128), 10, 128))
    assert "WindowGroupLimit" in p


def test_statistics_need_no_sort(spark):
    est = discover(spark, SF)
    p = plan_of(P.value_stats(V.column_values(est, 128)))
    assert "SortAggregate" not in p and "Sort " not in p
    typed = plan_of(P.typed_stats(est))
    assert "Sort " not in typed and "hashpartitioning" not in typed


def test_overlap_scans_the_frequencies_once(spark):
    a = Analysis(discover(spark, SF, options=KEY_DISCOVERY))
    freq = a.column_values
    p = plan_of(R.matched_values(a.estate, freq, a.profiles, KEY_DISCOVERY))
    assert p.count("column_values") == 1 and "collect_set" not in p


def test_no_pair_enumeration(spark):
    a = Analysis(discover(spark, SF, options=KEY_DISCOVERY))
    plans = [plan_of(R.candidates(a.estate, a.column_values, a.profiles, KEY_DISCOVERY)),
             plan_of(R.candidate_pair_counts(a.profiles, KEY_DISCOVERY))]
    for p in plans:
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_broadcast_only_with_bound(spark):
    from cartograph import plan_utils as pu
    df = spark.range(10)
    hinted = pu.small(df, 10)._jdf.queryExecution().analyzed().toString()
    assert "strategy=broadcast" in hinted
    big = pu.small(df, pu.BROADCAST_ROW_LIMIT + 1)
    assert big is df
