"""Changes applied from streams: upserts with deletes, histories, gold by deltas, table streams."""

import random

import pytest
from pyspark.sql import functions as F

from tierflow.operators.latest import scd2_history
from tierflow.session import scratch
from tierflow.sources import storage
from tierflow.streaming.append import stream_files
from tierflow.streaming.history import apply_history, history_rows
from tierflow.streaming.runs import RunLog
from tierflow.streaming.upsert import current_rows, fold, upsert_stream

SCHEMA = "k int, seq int, id int, op string"
RULE = (["k"], ["seq"], ["id"])
GONE = "op = 'D'"


def land(spark, root, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/in")
    return stream_files(spark, spark.createDataFrame([], SCHEMA).schema, f"{root}/in")


def test_deletes_win_by_sequence_even_before_their_insert(spark, as_rows):
    root = scratch(spark, "deletes")
    loads = [
        [(1, 5, 1, "U"), (2, 7, 2, "D")],  # key 2 is deleted at 7 before it is known
        [(2, 3, 3, "U"), (1, 6, 4, "D"), (3, 1, 5, "U")],
        [(1, 4, 6, "U"), (3, 1, 7, "D"), (4, 1, 8, "U")],  # the delete of 3 has the insert's place
        [(2, 9, 9, "U")],
    ]
    for n, rows in enumerate(loads):
        upsert_stream(land(spark, root, rows), f"{root}/t", f"{root}/check", *RULE, deletes=GONE, fanout=2)
        if n == 2:
            fold(spark, f"{root}/t", *RULE)
    assert as_rows(current_rows(spark, f"{root}/t", *RULE)) == [(2, 9, 9, "U"), (4, 1, 8, "U")]


def test_many_batches_leave_few_runs_and_a_constant_number_of_file_tests(spark, as_rows, monkeypatch):
    root = scratch(spark, "tiers")
    log = RunLog(spark, root, lambda rows: rows.groupBy("k").agg(F.sum("n").alias("n")), fanout=4)
    tests = []
    opened = storage._open
    monkeypatch.setattr(storage, "_open", lambda spark, path: tests.append(path) or opened(spark, path))
    asked = []
    for n in range(40):
        assert log.apply(n, spark.createDataFrame([(n % 3, 1), (9, 1)], "k int, n bigint").coalesce(1))
        tests.clear()
        runs = log.live()
        asked.append(len(tests))
        assert len(runs) <= 3 * 3 + 1
    assert set(asked) == {2}
    assert not log.apply(39, spark.createDataFrame([(0, 100)], "k int, n bigint"))
    total = log.merge(log.rows())
    assert as_rows(total) == [(0, 14), (1, 13), (2, 13), (9, 40)]
    before = {r["path"] for r in log.live()}
    gone = log.vacuum()
    assert gone and not before & set(gone)
    log.fold()
    assert len(log.live()) == 1
    assert as_rows(log.rows()) == [(0, 14), (1, 13), (2, 13), (9, 40)]
    assert len(storage.names(spark, f"{root}/state")) <= 8


def test_an_unfinished_batch_is_replaced(spark, as_rows):
    root = scratch(spark, "unfinished")
    log = RunLog(spark, root, lambda rows: rows)
    one = spark.createDataFrame([(1,)], "k int")
    one.write.parquet(f"{root}/runs/batch=0")  # written, but without its state
    assert log.rows() is None
    assert log.apply(0, one.withColumn("extra", F.lit("x")))
    assert log.apply(1, one)
    assert as_rows(log.rows()) == [(1, "x"), (1, None)]


CHANGES = [(k, seq, 100 * k + seq, "D" if seq % 5 == 4 else "U") for k in (1, 2, 3) for seq in range(12)]
CHANGES += [(None, 3, 1, "U"), (None, 5, 2, "U"), (2, None, 7, "U"), (7, 1, 1, "D")]


@pytest.mark.parametrize("heavy_rows", [10**6, 4])
def test_history_by_batches_equals_history_over_all(spark, as_rows, heavy_rows):
    rows = list(CHANGES)
    random.Random(3).shuffle(rows)
    root = scratch(spark, "history")
    for part in (rows[:15], rows[15:30], rows[30:]):
        apply_history(
            land(spark, root, part), f"{root}/t", f"{root}/check", ["k"], "seq", ["id"],
            deletes=GONE, buckets=4, fanout=2, heavy_rows=heavy_rows,
        )
    over_all = scd2_history(spark.createDataFrame(rows, SCHEMA), ["k"], "seq", ["id"]).filter("op <> 'D'")
    made = history_rows(spark, f"{root}/t", ["k"], "seq", ["id"]).select(*over_all.columns)
    assert as_rows(made) == as_rows(over_all)


def test_a_late_event_splits_and_a_correction_replaces(spark, as_rows):
    root = scratch(spark, "late")
    rule = (f"{root}/t", f"{root}/check", ["k"], "seq", ["id"])
    apply_history(land(spark, root, [(1, 1, 1, "a"), (1, 9, 1, "c"), (2, 1, 1, "z")]), *rule)
    apply_history(land(spark, root, [(1, 5, 1, "b"), (1, 9, 1, "corrected")]), *rule)
    read = [f"{root}/t", ["k"], "seq", ["id"]]
    made = history_rows(spark, *read)
    assert as_rows(made.select("k", "op", "__START_AT", "__END_AT")) == [
        (1, "a", 1, 5), (1, "b", 5, 9), (1, "corrected", 9, None), (2, "z", 1, None),
    ]
    # The second run holds the three intervals that changed, and none of key 2.
    assert spark.read.parquet(f"{root}/t/runs/batch=1").groupBy("k").count().collect() == [(1, 3)]


# gold by deltas


def test_delta_view_adds_and_takes_back(spark, as_rows):
    from tierflow.operators.aggregate import Metric, conditional_aggs
    from tierflow.streaming.deltas import DeltaView

    kind = F.col("t")
    metrics = [
        Metric("n", "count", kind == "C"),
        Metric("mean", "avg", kind == "C", "a", 2),
        Metric("paid", "sum", kind == "P", "a", 2),
    ]
    schema = "k int, t string, a double"
    first = spark.createDataFrame([(1, "C", 10.0), (1, "C", None), (1, "P", 2.5), (2, "X", 9.0)], schema)
    second = spark.createDataFrame([(1, "C", 0.1), (None, "P", 1.0), (3, "C", 4.0)], schema)
    wrong = spark.createDataFrame([(1, "C", 10.0), (2, "X", 9.0), (3, "C", 4.0)], schema)
    right = spark.createDataFrame([(1, "C", 20.0), (3, "P", 5.0)], schema)
    view = DeltaView(spark, scratch(spark, "delta"), ["k"], metrics, fanout=2)
    assert view.rows() is None
    assert view.apply(0, first) and view.apply(1, second) and view.apply(4, right, retracted=wrong)
    assert not view.apply(4, right)
    left = first.unionByName(second).exceptAll(wrong).unionByName(right)
    expected = conditional_aggs(left, ["k"], metrics)
    assert as_rows(view.rows()) == as_rows(expected)
    assert 2 not in {r.k for r in view.rows().collect()}


def test_behaviour_reads_only_new_fact_batches(spark, as_rows):
    """The old fact batch is gone when the second one arrives; the view equals a full rebuild."""
    from tierflow.plans import contracts
    from tierflow.plans.gold import atm_behaviour
    from tierflow.plans.pipeline import FACTS, bronze_table, refresh_behaviour, refresh_facts
    from tierflow.plans.silver import enriched_transactions
    from tierflow.streaming.ingest import ingest_files

    root = scratch(spark, "behaviour")
    layout = contracts.source_schema(contracts.TRANSACTIONS)

    def load(number, lines):
        made = [dict(zip(("TRXID", "CUSTID", "TRXTYP", "TRXAMT"), one, strict=True)) for one in lines]
        rows = spark.createDataFrame([tuple(r.get(f.name) for f in layout.fields) for r in made], layout)
        rows.coalesce(1).write.parquet(f"{root}/in/{number}")
        lead = contracts.CLUSTERING["trxpfl"]
        ingest_files(spark, f"{root}/in", f"{root}/bronze/trxpfl", f"{root}/check", lead=lead)
        assert refresh_facts(spark, root)[1] == 1
        assert refresh_facts(spark, root)[1] == 0

    load(1, [(1, 1, "CATM", 10.0), (2, 2, "DATM", 3.0), (3, 1, "PGSL", 1.5)])
    assert refresh_behaviour(spark, root, 2)[1] == [0]
    load(2, [(4, 1, "CATM", 5.0), (5, 3, "PGSL", 2.0)])
    storage.delete(spark, f"{root}/silver/{FACTS}/batch_id=0")
    view, added = refresh_behaviour(spark, root, 2)
    assert added == [1]
    assert refresh_behaviour(spark, root, 2)[1] == []
    whole = atm_behaviour(enriched_transactions(bronze_table(spark, root, "trxpfl")), 2)
    assert as_rows(view) == as_rows(whole)


# table streams


def test_table_stream_gives_every_row_once(spark, as_rows):
    from tierflow.streaming.ingest import ingest_files
    from tierflow.streaming.tables import append_flow, for_each_batch, read_flows

    root = scratch(spark, "table-stream")

    def load(name, number, rows):
        spark.range(*rows).write.parquet(f"{root}/{name}-in/{number}")
        ingest_files(spark, f"{root}/{name}-in", f"{root}/{name}", f"{root}/{name}-check")

    def flow(name):
        append_flow(
            spark, f"{root}/{name}", f"{root}/sink", f"{root}/{name}-flow", name,
            lambda rows: rows.select("id", F.lit(name).alias("source")),
        )

    def held():
        return as_rows(read_flows(spark, f"{root}/sink", ["a", "b"]))

    flow("a")  # an empty table is legal
    load("a", 1, (0, 5))
    # A batch that is being written is not seen.
    spark.range(100, 105).write.parquet(f"{root}/a/flow=main/batch_id=9")
    storage.delete(spark, f"{root}/a/flow=main/batch_id=9/_SUCCESS")
    flow("a")
    flow("a")
    load("b", 1, (50, 52))
    load("a", 2, (5, 8))
    flow("b")
    flow("a")
    expected = [(k, "a") for k in range(8)] + [(k, "b") for k in (50, 51)]
    assert held() == sorted(expected, key=repr)
    # The last commit of the checkpoint is lost: the call is made again, the rows stay once.
    commits = [n for n in storage.names(spark, f"{root}/a-flow/commits") if n.isdigit()]
    storage.delete(spark, f"{root}/a-flow/commits/{max(commits, key=int)}")
    flow("a")
    assert held() == sorted(expected, key=repr)
    with pytest.raises(ValueError, match="another name"):
        append_flow(spark, f"{root}/a", f"{root}/sink", f"{root}/other-flow", "a")
    calls = []
    for_each_batch(spark, f"{root}/a", f"{root}/watch", lambda rows, landed, n: calls.append((landed, n, rows.count())))
    assert calls == [([0, 1], 0, 8)]


# expectations on a stream


def test_stream_expectations_count_per_batch_and_fail_before_the_commit(spark, as_rows):
    from pyspark.errors import StreamingQueryException

    from tierflow.streaming.expectations import expectation_counts, expected_rows, expecting_stream

    root = scratch(spark, "stream-expect")
    place = [f"{root}/t", f"{root}/metrics", f"{root}/check"]
    rules = {"drop": {"known": "op <> 'X'"}, "keep": {"low": "seq < 5"}, "fail": {"keyed": "k IS NOT NULL"}}
    assert expectation_counts(spark, place[1]).count() == 0
    expecting_stream(land(spark, root, [(1, 1, 1, "U"), (2, 9, 2, "X"), (3, 9, 3, None)]), *place, **rules)
    expecting_stream(land(spark, root, [(4, 2, 4, "U")]), *place, **rules)
    bad = land(spark, root, [(5, 1, 5, "U"), (None, 1, 6, "U")])
    with pytest.raises(StreamingQueryException, match="keyed"):
        expecting_stream(bad, *place, **rules)
    assert as_rows(expected_rows(spark, place[0]).select("k")) == [(1,), (4,)]
    assert as_rows(expectation_counts(spark, place[1])) == [
        (0, "keyed", "fail", 3, 0), (0, "known", "drop", 3, 2), (0, "low", "keep", 3, 2),
        (1, "keyed", "fail", 1, 0), (1, "known", "drop", 1, 0), (1, "low", "keep", 1, 0),
    ]


def test_ingest_time_is_one_value_per_batch(spark):
    from tierflow.streaming.ingest import ingest_files, read_ingested

    root = scratch(spark, "stamp")
    for k in range(2):
        spark.range(0, 1000, numPartitions=8).write.parquet(f"{root}/in/{k}")
        ingest_files(spark, f"{root}/in", f"{root}/t", f"{root}/check")
    stamps = read_ingested(spark, f"{root}/t").groupBy("FechaIngestaDatos").count().collect()
    assert sorted(r["count"] for r in stamps) == [1000, 1000]
