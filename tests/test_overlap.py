"""Shared values of column pairs: counting, hot signatures, pruning; exact distinct counts; scans by schema."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from cartograph import KEY_DISCOVERY, Analysis, Options, discover, discover_frames
from cartograph.operators import cardinality as D
from cartograph.operators import overlap as O
from cartograph.operators import relate as R
from cartograph.operators import values as V


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _by_hand(values):
    """values: {value: [(column, is_pk)]}"""
    return Counter((f, p) for cols in values.values() for f, a in cols if not a for p, b in cols if b)


def _counted(values, blocks=1):
    rows = [(h, 7 * h % 11, c, k) for h, cols in values.items() for c, k in cols]
    got = Counter()
    for part in np.array_split(np.arange(len(rows)), blocks) if blocks == 1 else [np.arange(len(rows))]:
        h1, h2, c, k = (np.array(x) for x in zip(*[rows[i] for i in part]))
        for f, p, n in O.count_pairs(h1, h2, c.astype(np.int64), k.astype(bool)):
            for x in zip(f.tolist(), p.tolist(), n.tolist()):
                got[x[:2]] += x[2]
    return got


def test_pairs_equal_brute_force(monkeypatch):
    rng = random.Random(2)
    for cells in (O.CELLS, 64):
        monkeypatch.setattr(O, "CELLS", cells)
        for hot in (O.HOT, 0.0, 2.0):  # by both ways of counting
            monkeypatch.setattr(O, "HOT", hot)
            for _ in range(10):
                cols = [(c, rng.random() < .4) for c in range(rng.choice([2, 6, 40]))]
                values = {v: rng.sample(cols, rng.randrange(1, len(cols) + 1)) for v in range(rng.choice([1, 30, 200]))}
                values |= {1000 + v: cols for v in range(50)}
                assert _counted(values) == _by_hand(values)
    assert list(O.count_pairs(*[np.zeros(0, np.int64)] * 3, np.zeros(0, bool))) == []


def test_blocks_end_between_values(monkeypatch):
    import pyarrow as pa

    rng = random.Random(3)
    values = {v: [(c, c % 3 == 0) for c in rng.sample(range(9), rng.randrange(1, 9))] for v in range(100)}
    rows = [(v, -v, 2 * c + k) for v, cols in values.items() for c, k in cols]
    batches = [pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows[i:i + 7])], ["h1", "h2", "code"])
               for i in range(0, len(rows), 7)]
    monkeypatch.setattr(O, "ROWS", 20)
    got = Counter()
    for b in O._count(iter(batches)):
        for f, p, n in zip(*(b.column(k).to_pylist() for k in range(3))):
            got[f, p] += n
    assert got == _by_hand(values) and list(O._count(iter([]))) == []


def test_wide_estate_of_small_integers(spark):
    """2,000 columns that share small integers: every value's signature is another one."""
    tables, wide, keys = 10, 200, 300
    col = spark.range(tables * wide).selectExpr(f"cast(id div {wide} AS int) AS dataset_id", f"cast(id % {wide} AS int) AS ordinal")
    value = spark.range(keys).selectExpr("id AS v")
    held = "CASE WHEN ordinal = 0 THEN v >= dataset_id ELSE v < 20 + 7 * dataset_id + ordinal % 50 END"
    keyed = (col.join(value, F.expr(held)).selectExpr("dataset_id", "ordinal", "ordinal = 0 AS is_pk", "cast(v AS string) AS key"))
    m = O.matched_pairs(keyed)
    plan = plan_of(m)
    assert "ObjectHashAggregate" not in plan and "Generate" not in plan
    got = {tuple(r)[:4]: r["matched"] for r in m.collect()}
    assert len(got) == tables * (wide - 1) * (tables - 1)  # every FK column with the key of every other table
    for (t, c, o, _), n in got.items():
        assert n == 20 + 7 * t + c % 50 - o


def test_columns_that_cannot_match_stay_out(spark):
    frames = {
        "pk": spark.sql("SELECT cast(id AS int) AS id, concat('n', id) AS name, date_add(date'2020-01-01', cast(id AS int)) AS d, "
                        "cast(id AS decimal(9,0)) AS dec FROM range(100)"),
        "fk": spark.sql("SELECT id % 5 AS near, 1000 + id % 5 AS far, id % 3 + 0.5D AS half, id % 2 = 0 AS flag, 'n7' AS word, "
                        "'zz' AS beyond, cast(null AS string) AS nothing, cast(id % 4 AS string) AS digits, "
                        "date'2020-01-05' AS day, timestamp_ntz'2020-01-05 00:00:00' AS at, array(1) AS a FROM range(50)")}
    opts = Options(fk_excluded_types=(), min_overlap=0.0)
    a = Analysis(discover_frames(spark, frames, opts), materialize=False)
    p = a.profiles
    live = O.can_match(R.fk_columns(p, opts), R.pk_columns(p)).join(p, ["dataset_id", "ordinal"])
    names = {r.column_name for r in live.collect()}
    assert names >= {"near", "word", "digits", "day", "id", "name", "d", "dec"}
    assert not names & {"far", "half", "beyond", "nothing", "at", "a"}
    got = {(r.fk_ordinal, r.pk_ordinal): r.matched for r in R.matched_values(a.estate, a.column_values, p, opts).collect()}
    assert got == {(0, 0): 5, (0, 3): 5, (4, 1): 1, (7, 0): 4, (7, 3): 4, (8, 2): 1}


def test_printed_forms_never_meet_where_pruned(spark):
    one = spark.sql("SELECT cast(1 AS byte) a, 1.0D b, cast(1 AS float) c, cast(1 AS decimal(5,2)) d, cast(1 AS decimal(5,0)) e, "
                    "true f, date'2020-01-01' g, timestamp'2020-01-01 00:00:00' h, timestamp_ntz'2020-01-01 00:00:00' i, "
                    "double('nan') j, -1e30D k, cast(0.0000001 AS decimal(20,10)) l")
    est = discover_frames(spark, {"t": one}, Options())
    kinds = {r.column_name: r.form for r in est.columns().withColumn("form", O.printed_form()).collect()}
    text = one.select(*[V.value_string(f).alias(f.name) for f in one.schema.fields]).first()
    for c, form in kinds.items():
        low, high = O.SPAN[form]
        assert low.encode() <= text[c].encode() < high.encode(), (c, text[c])
    assert {kinds[c] for c in "ae"} == {"whole"} and {kinds[c] for c in "bcdjkl"} == {"fraction"}


# ---- distinct counts -------------------------------------------------------------------

def test_distinct_counts_equal_the_frequencies(spark):
    df = spark.sql("""SELECT id - 70 AS l, cast(id % 7 AS byte) AS b, cast(null AS int) AS n, if(id % 3 = 0, null, id) AS some,
        cast(id % 5 AS double) / 3 AS x, if(id = 0, double('nan'), -0.0D) AS z, concat('v', id % 11) AS s, repeat('q', 300) || id % 4 AS long,
        date_add(date'1960-01-01', cast(id % 90 AS int)) AS d, timestamp_micros(id * 999983 - 50) AS t,
        timestamp_ntz'2020-01-01 00:00:00' AS ntz, array(id % 2, null) AS a, named_struct('k', id % 6) AS st, map('k', id % 2) AS m,
        cast(id AS decimal(30,3)) AS dec, cast(cast(id % 3 AS string) AS binary) AS bin, id * 9007199254740993 AS far, true AS f FROM range(400)""")
    frames = {"a": df, "b": df.selectExpr("l", "s").limit(0), "c": spark.createDataFrame([(None,), ("",)], "only string")}
    a = Analysis(discover_frames(spark, frames, Options()), materialize=False)
    want = {(r.table_name, r.column_name): (r.total_rows, r.distinct_count, r.is_unique) for r in a.profiles.collect()}
    got = {(r.table_name, r.column_name): (r.total_rows, r.distinct_count, r.is_unique) for r in a.cardinalities.collect()}
    assert got == want and len(got) == 21
    basic = {(r.table_name, r.column_name): (r.total_rows, r.null_count, r.null_rate, r.min_value, r.max_value, r.mean_value)
             for r in a.basics.collect()}
    whole = {(r.table_name, r.column_name): (r.total_rows, r.null_count, r.null_rate, r.min_value, r.max_value, r.mean_value)
             for r in a.profiles.collect()}
    assert str(basic) == str({k: whole[k] for k in basic})


def test_distinct_counts_shuffle_bits_not_values(spark):
    df = spark.range(0, 100_000, 1, 4).selectExpr("id", "cast(id AS string) AS s")
    est = discover_frames(spark, {"t": df}, Options())
    rows = est.scans()[0]
    words = D._words(rows.frame, rows.ident, [(0, rows.fields[0])]).select(F.shiftright("value", 6).alias("w"))
    assert words.distinct().count() == 1563
    plan = plan_of(D.distinct_counts(est))
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan


def test_unique_columns_need_no_grouping(spark, tmp_path):
    spark.sql("SELECT id, id % 1000 AS ref, concat('n', id) AS name, if(id = 3, null, id) AS gap, "
              "if(id = 3 OR id = 4, null, id) AS gaps FROM range(20000)").write.parquet(str(tmp_path / "big"))
    spark.sql("SELECT id AS k FROM range(50)").write.parquet(str(tmp_path / "small"))
    opts = KEY_DISCOVERY.replace(granularity="directory")
    lean = Analysis(discover(spark, str(tmp_path), options=opts.replace(lean_min_bytes=50_000)))
    assert lean.unique_columns == {(0, 0), (0, 2), (0, 3)}
    plain = Analysis(discover(spark, str(tmp_path), options=opts))
    assert plain.unique_columns == frozenset()
    rows = lambda a: sorted(map(str, a.profiles.collect()))
    assert rows(lean) == rows(plain)
    assert sorted(map(str, lean.candidates.collect())) == sorted(map(str, plain.candidates.collect()))


# ---- scans -----------------------------------------------------------------------------

def test_one_branch_a_schema(spark, tmp_path):
    root = tmp_path / "a lake"
    for k in range(12):
        (spark.range(3 + k % 4).selectExpr(f"id + {k} AS id", f"'t{k}' AS s").toPandas()
         .to_parquet((root / f"p{k % 2}").mkdir(parents=True, exist_ok=True) or root / f"p{k % 2}" / f"f {k}.parquet"))
    for k in range(4):
        (root / f"c{k}.csv").write_text(f"q,w\n{k},x\n{k + 1},y\n")
        (root / f"j{k}.json").write_text(f'{{"__dataset": {k}, "z": "a"}}\n')
    est = discover(spark, str(root))
    assert len(est.datasets) == 20 and len(est.scans()) == 3
    a = Analysis(est)
    plan = plan_of(V.column_values(est, 128))
    assert plan.count("Expand") == 3 and "CartesianProduct" not in plan
    got = {(r.location.rsplit("/", 1)[-1]): r.row_count for r in est.inventory().collect()}
    assert got["f%207.parquet" if "f%207.parquet" in got else "f 7.parquet"] == 6
    one_by_one = Analysis(discover(spark, str(root)))
    one_by_one.estate.scans = lambda ds=None: [s for d in (ds if ds is not None else est.datasets)
                                               for s in discover_scans(one_by_one.estate, d)]
    assert sorted(map(str, a.profiles.collect())) == sorted(map(str, one_by_one.profiles.collect()))
    counts = lambda x: sorted(map(tuple, x.cardinalities.select("dataset_id", "ordinal", "total_rows", "distinct_count").collect()))
    assert counts(a) == counts(one_by_one)
    est.release()


def discover_scans(estate, ds):
    from cartograph.sources.discovery import Scan
    return [Scan([ds], estate.load(ds), F.lit(ds.dataset_id))]


def test_isolated_halves():
    from cartograph import plan_utils as pu

    calls = []

    def attempt(some):
        calls.append(len(some))
        if 13 in some:
            raise ValueError("thirteen")
        return sum(some)

    done, lost = pu.isolated(list(range(64)), attempt)
    assert sum(r for _, r in done) == sum(range(64)) - 13 and lost == [(13, "ValueError: thirteen")]
    assert len(calls) <= 2 * 6 + 1 and pu.isolated([], attempt) == ([], [])


def test_memory_of_a_block_is_bounded():
    """The pair count of a task holds a bounded block, however many rows there are."""
    import tracemalloc

    def batches():
        for k in range(100):
            value = np.repeat(np.arange(k * 1000, (k + 1) * 1000), 10)
            yield pa.RecordBatch.from_arrays(
                [pa.array(value), pa.array(value), pa.array(2 * np.tile(np.arange(10), 1000) + np.tile([0, 1], 5000))],
                ["h1", "h2", "code"])

    tracemalloc.start()
    found = sum(sum(b.column("n").to_pylist()) for b in O._count(batches()))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == 100_000 * 25
    assert peak < 60e6
