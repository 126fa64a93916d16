import datetime
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tierflow.functions import hash_flag
from tierflow.operators import quality
from tierflow.operators.aggregate import Metric, conditional_aggs
from tierflow.operators.changes import apply_changes, table_changes
from tierflow.operators.joins import anti_keys, assign_key, dim_left_join, left_join_fill
from tierflow.operators.keys import continue_key, dense_index
from tierflow.operators.latest import latest_by_key, latest_by_key_agg, scd2_history
from tierflow.operators.projection import conform, lead_with, select_except
from tierflow.operators.quality import reconcile
from tierflow.operators.sets import set_difference, set_except
from tierflow.operators.snapshot import evolve_snapshot, grow_snapshot, snapshot_drift
from tierflow.session import scratch


def day(n):
    return datetime.datetime(2026, 1, n)


@pytest.fixture
def history(spark):
    data = [
        (1, day(1), 1, "old"),
        (1, day(2), 2, "tied low"),
        (1, day(2), 3, "tied high"),
        (2, None, 4, "no time"),
        (2, day(1), 5, "timed"),
        (None, day(1), 6, "null key"),
        (None, day(3), 7, "null key newer"),
    ]
    return spark.createDataFrame(data, "k bigint, ts timestamp, id bigint, v string")


@pytest.mark.parametrize("operator", [latest_by_key, latest_by_key_agg])
def test_latest_keeps_one_row_per_key(history, as_rows, operator):
    newest = operator(history, ["k"], ["ts"], ["id"])
    assert newest.columns == history.columns
    assert sorted(r.v for r in newest.collect()) == ["null key newer", "tied high", "timed"]


def test_latest_limits_each_partition_before_the_shuffle(history):
    plan = latest_by_key(history, ["k"], ["ts"], ["id"])._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


@pytest.mark.parametrize("heavy_rows, partitions", [(10**6, None), (20, 5), (0, None), (0, 9)])
def test_history_ranges_do_not_change_the_intervals(spark, as_rows, heavy_rows, partitions):
    start = datetime.datetime(2025, 12, 30)
    data = [
        (None if i % 7 == 0 else i % 3, start + datetime.timedelta(hours=5 * (i // 2)), i)
        for i in range(60)
    ] + [(0, None, 100), (0, None, 101), (None, None, 102)]

    def place(ts, i):
        return (ts is not None, ts or start, i)
    df = spark.createDataFrame(data, "k int, ts timestamp, id int")
    made = scd2_history(df, ["k"], "ts", ["id"], heavy_rows=heavy_rows, partitions=partitions)
    expected = []
    for k, ts, i in data:
        later = sorted(
            (place(t, j), t) for kk, t, j in data if kk == k and place(t, j) > place(ts, i)
        )
        expected.append((k, ts, i, ts, later[0][1] if later else None))
    assert as_rows(made) == sorted(expected, key=repr)


def test_history_of_one_key_at_one_time_is_shared_by_tasks(spark):
    """All rows but one have one key and one time; every range ends where the next begins."""
    at, later = datetime.datetime(2026, 1, 1), datetime.datetime(2026, 1, 2)
    same = spark.range(0, 20_000, numPartitions=4).select(
        F.lit(1).alias("k"), F.lit(at).alias("ts"), (F.col("id") % 100).alias("id")
    )
    df = same.unionByName(spark.createDataFrame([(1, later, 0)], same.schema))
    made = scd2_history(df, ["k"], "ts", ["id"], heavy_rows=1000, partitions=8)
    ends = {r.ends: r.n for r in made.groupBy(F.col("__END_AT").alias("ends")).agg(F.count("*").alias("n")).collect()}
    assert ends == {at: 19_999, later: 1, None: 1}
    folders = Path(scratch(spark, "x")).parent.glob("history-*")
    newest = spark.read.parquet(str(max(folders, key=lambda p: p.stat().st_mtime)))
    sizes = [r["count"] for r in newest.groupBy("_part").count().collect()]
    assert len(sizes) > 4 and max(sizes) < 10_000


def test_left_join_keeps_left_only_and_drops_right_only(spark, as_rows):
    left = spark.createDataFrame([(1, "a"), (2, "b")], "k int, l string")
    right = spark.createDataFrame([(1, 1.0), (3, 3.0)], "rk int, r double")
    assert as_rows(dim_left_join(left, right, "k", "rk")) == [(1, "a", 1.0), (2, "b", None)]


def test_zero_fill_touches_measures_only(spark, as_rows):
    left = spark.createDataFrame([(1, None), (2, "b")], "k int, note string")
    right = spark.createDataFrame([(1, 5)], "k int, n bigint")
    assert as_rows(left_join_fill(left, right, "k", {"n": 0})) == [(1, None, 5), (2, "b", 0)]


@pytest.mark.parametrize("scale", [None, 2])
def test_conditional_metrics(spark, as_rows, scale):
    data = [(1, "C", 10.0), (1, "C", None), (1, "P", 2.5), (2, "X", 9.0), (None, "C", 1.0)]
    df = spark.createDataFrame(data, "k int, t string, a double")
    kind = F.col("t")
    metrics = [
        Metric("n", "count", kind == "C"),
        Metric("mean", "avg", kind == "C", "a", scale),
        Metric("paid", "sum", kind == "P", "a", scale),
    ]
    assert as_rows(conditional_aggs(df, ["k"], metrics)) == sorted(
        [(1, 2, 5.0, 2.5), (2, 0, 0.0, 0.0), (None, 1, 1.0, 0.0)], key=repr
    )


def test_lead_with_orders_and_reports_missing_columns(spark):
    names = [f"c{i}" for i in range(40)]
    wide = spark.createDataFrame([tuple(range(40))], names)
    moved = lead_with(wide, ["c35", "c2"])
    assert moved.columns == ["c35", "c2", *[n for n in names if n not in ("c35", "c2")]]
    assert moved.first().c35 == 35
    with pytest.raises(ValueError, match="nope"):
        lead_with(wide, ["c1", "nope"])
    assert lead_with(wide, []).columns == names


def test_bookkeeping_columns_are_dropped_and_absent_ones_ignored(spark):
    df = spark.createDataFrame([(1, "x", 2026)], ["k", "_rescued_data", "año"])
    assert select_except(df).columns == ["k"]


def test_conform_adds_typed_nulls(spark):
    df = spark.createDataFrame([(1, "x")], "b int, z string")
    schema = spark.createDataFrame([], "a date, b bigint").schema
    made = conform(df, schema)
    assert made.dtypes == [("a", "date"), ("b", "bigint")]
    assert tuple(made.first()) == (None, 1)


def test_dense_index_has_no_gaps_on_any_layout(spark, as_rows):
    keys = spark.range(0, 3000, 3).withColumnRenamed("id", "k")
    first = dense_index(keys, "k", buckets=16, start=5)
    again = dense_index(keys.repartition(11), "k", buckets=16, start=5)
    assert sorted(r.idx for r in first.collect()) == list(range(5, 1005))
    assert as_rows(first) == as_rows(again)
    with pytest.raises(ValueError):
        dense_index(keys, "k", buckets=0)


def test_assigned_keys_exist_and_empty_dimension_gives_nulls(spark):
    facts = spark.range(500).withColumnRenamed("id", "f")
    dim = spark.createDataFrame([(10,), (20,), (20,), (30,), (None,)], "k bigint")
    assigned = assign_key(facts, "f", dim, "k")
    assert assigned.count() == 500
    assert {r.k for r in assigned.collect()} == {10, 20, 30}
    empty = assign_key(facts, "f", dim.filter("k < 0"), "k")
    assert empty.filter("k is null").count() == 500


def test_dense_index_keeps_a_null_key(spark):
    keys = spark.createDataFrame([(1,), (2,), (None,)], "k bigint")
    numbered = dense_index(keys, "k", buckets=2, bucket=F.col("k"))
    assert sorted(r.idx for r in numbered.collect()) == [0, 1, 2]


def test_continued_keys_start_after_the_highest(spark):
    old = spark.createDataFrame([(3,), (9,)], "k bigint")
    new = spark.createDataFrame([("x",), ("y",)], "name string")
    assert sorted(r.k for r in continue_key(old, "k", new, "name").collect()) == [10, 11]
    assert sorted(r.k for r in continue_key(old.limit(0), "k", new, "name").collect()) == [0, 1]


def test_anti_keys_count_rows_and_null_is_an_orphan(spark, as_rows):
    facts = spark.createDataFrame([(1,), (5,), (5,), (None,)], "k int")
    known = spark.createDataFrame([(1,), (1,), (None,)], "d int")
    assert as_rows(anti_keys(facts, known, "k", "d")) == [(5, 2), (None, 1)]


def test_set_except_compares_nulls_and_removes_copies(spark, as_rows):
    left = spark.createDataFrame([(1, None), (1, None), (2, "b"), (3, "c")], "a int, b string")
    right = spark.createDataFrame([("b", 2), (None, 9)], "b string, a int")
    assert as_rows(set_except(left, right)) == as_rows(left.subtract(right.select("a", "b")))


@pytest.mark.parametrize("fraction, changed", [(0.0, 0), (1.0, 100)])
def test_evolve_fraction_limits(spark, fraction, changed):
    old = spark.range(100).select(F.col("id").alias("k"), F.lit("a").alias("v"))
    new = evolve_snapshot(old, hash_flag("k", fraction), {"v": F.lit("b")})
    drift = snapshot_drift(old, new, "k", ["v"]).first()
    assert (drift.n_kept, drift.n_changed, drift.n_added, drift.n_removed) == (100, changed, 0, 0)


def test_growth_is_rounded_and_keys_continue(spark):
    old = spark.range(10, 260).select(F.col("id").alias("k"), F.lit("a").alias("v"))
    new = grow_snapshot(old, "k", 0.006, {"v": F.lit("n")})
    assert sorted(map(tuple, new.collect())) == [(260, "n"), (261, "n")]
    assert grow_snapshot(old, "k", 0.0).count() == 0


def test_drift_sees_changes_to_null(spark):
    old = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    new = spark.createDataFrame([(1, None), (2, None)], "k int, v string")
    assert snapshot_drift(old, new, "k", ["v"]).first().n_changed == 1


def test_changes_lead_from_old_to_new(spark, as_rows):
    schema = "k int, v string, w double"
    old = spark.createDataFrame([(1, "a", 1.0), (2, None, 2.0), (3, "c", 3.0), (None, "n", 0.0)], schema)
    new = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (4, "d", 4.0), (None, "n", 9.0)], schema)
    changes = table_changes(old, new, ["k"])
    assert as_rows(changes.select("k", "_change_type")) == sorted(
        [
            (2, "update_preimage"),
            (2, "update_postimage"),
            (3, "delete"),
            (4, "insert"),
            (None, "update_preimage"),
            (None, "update_postimage"),
        ],
        key=repr,
    )
    assert as_rows(apply_changes(old, changes, ["k"])) == as_rows(new)
    assert table_changes(old, old, ["k"]).count() == 0


def test_repeated_keys_fail_instead_of_multiplying(spark):
    once = spark.createDataFrame([(1, "a")], "k int, v string")
    twice = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    for audit in (
        table_changes(once, twice, ["k"]),
        snapshot_drift(twice, once, "k", ["v"]),
        quality.reconcile(once, twice, "k", ["v"]),
    ):
        with pytest.raises(PySparkException, match="more than once"):
            audit.collect()


def test_reconcile_counts_differences_and_one_sided_keys(spark):
    left = spark.createDataFrame([(1, 1.0, "a"), (2, None, "b"), (3, 3.0, "c")], "k int, x double, s string")
    right = spark.createDataFrame([(1, 1.005, "a"), (2, None, "z"), (4, 3.0, "c")], "k int, x double, s string")
    made = {r.column_name: (r.n_keys, r.n_breaks) for r in quality.reconcile(left, right, "k", ["x", "s"], 0.01).collect()}
    assert made == {"k": (2, 2), "x": (2, 0), "s": (2, 1)}


def test_expectations(spark):
    df = spark.createDataFrame([(1,), (None,), (-1,)], "x int")
    seen = Observation()
    kept = quality.expect(df, "positive", "x > 0", observation=seen)
    assert kept.count() == 1
    assert seen.get == {"n_rows": 3, "n_violations": 2}
    assert quality.expect(df, "positive", "x > 0", action="keep").count() == 3
    with pytest.raises(PySparkException):
        quality.expect(df, "positive", "x > 0", action="fail").collect()
    assert quality.expect(df, "any", "true", action="fail").count() == 3
    with pytest.raises(ValueError):
        quality.expect(df, "positive", "x > 0", action="ignore")


def test_audits_on_an_empty_table(spark):
    empty = spark.createDataFrame([], "k int, v double")
    assert quality.key_uniqueness(empty, ["k"]).first().ok
    assert quality.null_nan_counts(empty, ["k", "v"]).count() == 2
    assert quality.one_to_one(empty, empty, "k").first().ok
    assert not quality.volume_check(empty, at_least=1).first().ok
    assert quality.expectation_metrics(empty, {"x": "k > 0"}).first().n_violations == 0


def test_blank_configuration_values_do_not_count(spark):
    config = spark.createDataFrame([("a", "x"), ("b", "  ")], "Clave string, Valor string")
    found = {r.required: r.ok for r in quality.config_completeness(config, ["a", "b", "c"]).collect()}
    assert found == {"a": True, "b": False, "c": False}


def test_comparisons_sort_for_no_aggregate(spark):
    old = spark.range(50).selectExpr("id", "cast(id as string) as name")
    new = spark.range(5, 60).selectExpr("id", "cast(id * 2 as string) as name")
    compared = [
        table_changes(old, new, ["id"]),
        snapshot_drift(old, new, "id", ["name"]),
        reconcile(old, new, "id", ["name"]),
    ]
    for df in compared:
        assert "SortAggregate" not in df._jdf.queryExecution().executedPlan().toString()


def test_grow_snapshot_reads_its_input_a_few_times(spark):
    root = scratch(spark, "grow")
    spark.range(1000).selectExpr("id as k", "id % 7 as v").write.parquet(root)
    grown = grow_snapshot(spark.read.parquet(root), "k", 0.05)
    plan = grown._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") <= 6
    got = grown.collect()
    assert sorted(r.k for r in got) == list(range(1000, 1050))


def test_set_difference_is_both_exceptions(spark):
    left = spark.createDataFrame([(1, None), (1, None), (2, "b"), (3, "c")], "k int, v string")
    right = spark.createDataFrame([("c", 3), (None, 1), ("x", 2), ("x", 2)], "v string, k int")
    assert sorted(map(tuple, set_difference(left, right).collect())) == [(2, "b"), (2, "x")]
