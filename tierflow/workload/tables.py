"""Queries over table writes and streams.

Each writes a whole input table to a fresh folder under the shared root, runs the
operator and reads the outcome back.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.operators.sets import set_difference
from tierflow.plans.mapping import transaction_rows
from tierflow.plans.silver import enriched_transactions
from tierflow.session import scratch
from tierflow.sources import sinks, storage
from tierflow.sources.filelist import FileList
from tierflow.sources.files import scan_dated, scan_days
from tierflow.streaming.append import append_stream, incremental_view, stream_files
from tierflow.streaming.deltas import DeltaView
from tierflow.streaming.expectations import expectation_counts, expected_rows, expecting_stream
from tierflow.streaming.history import apply_history, history_rows
from tierflow.streaming.ingest import INGESTED, RESCUED, ingest_files, read_ingested
from tierflow.streaming.tables import append_flow, read_flows
from tierflow.streaming.upsert import current_rows, fold, upsert_stream
from tierflow.workload.registry import Tables, query
from tierflow.workload.relational import ORDER_METRICS_SQL, order_metrics

AT = datetime.datetime(2001, 8, 1)
SPLIT = "1998-01-01"


def halves(orders: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The orders before the split date, and all others."""
    early = F.col("o_orderdate") < F.lit(SPLIT).cast("timestamp_ntz")
    return orders.filter(early), orders.filter(~early)


def ingest_in_turn(t: Tables, name: str, parts: list[DataFrame]) -> DataFrame:
    """Land the parts one after the other with an ingest run after each, and one more."""
    root = scratch(t.spark, name)
    for i, part in enumerate(parts):
        part.write.parquet(f"{root}/landing/load{i}")
        ingest_files(t.spark, f"{root}/landing", f"{root}/table", f"{root}/checkpoint", ingested_at=AT)
    ingest_files(t.spark, f"{root}/landing", f"{root}/table", f"{root}/checkpoint", ingested_at=AT)
    return read_ingested(t.spark, f"{root}/table")


@query("select * from orders")
def stream_ingest_append(t: Tables):
    return ingest_in_turn(t, "append", list(halves(t.orders))).drop(RESCUED, INGESTED)


@query(
    f"""select * replace (case when o_orderdate >= timestamp '{SPLIT}' then o_orderpriority end
      as o_orderpriority) from orders"""
)
def schema_evolution_merge(t: Tables):
    early, late = halves(t.orders)
    landed = ingest_in_turn(t, "evolve", [early.drop("o_orderpriority"), late])
    return landed.drop(RESCUED, INGESTED)


@query(
    f"""select o_orderkey, case when o_orderdate >= timestamp '{SPLIT}' and o_orderstatus = 'P'
        then null else o_totalprice end as o_totalprice,
      case when o_orderdate >= timestamp '{SPLIT}' and o_orderstatus = 'P' then 'pending' end
        as rescued from orders"""
)
def rescued_data(t: Tables):
    early, late = halves(t.orders)
    as_text = F.col("o_totalprice").cast("string")
    misfit = late.withColumn(
        "o_totalprice", F.when(F.col("o_orderstatus") == "P", "pending").otherwise(as_text)
    )
    landed = ingest_in_turn(t, "rescue", [early, misfit])
    rescued = F.get_json_object(RESCUED, "$.o_totalprice").alias("rescued")
    return landed.select("o_orderkey", "o_totalprice", rescued)


@query("select * from orders")
def native_stream_append(t: Tables):
    root = scratch(t.spark, "native")
    schema = t.orders.schema
    for i, part in enumerate(halves(t.orders)):
        part.write.mode("append").parquet(f"{root}/landing")
        stream = stream_files(t.spark, schema, f"{root}/landing")
        append_stream(stream, f"{root}/table", f"{root}/checkpoint")
    return t.spark.read.parquet(f"{root}/table")


@query("select * from events")
def late_file_ingest(t: Tables):
    """The second load comes in files dated a month before those of the first."""
    root = scratch(t.spark, "late")
    later = F.dayofmonth("ts") > 20
    for i, part in enumerate((t.events.filter(later), t.events.filter(~later))):
        part.write.parquet(f"{root}/landing/load{i}")
        if i:
            storage.set_age(t.spark, f"{root}/landing/load{i}", 30)
        ingest_files(t.spark, f"{root}/landing", f"{root}/table", f"{root}/checkpoint", ingested_at=AT)
    return read_ingested(t.spark, f"{root}/table").select(*t.events.columns)


@query("select count(*) as n_full, count(*) as n_incremental, 0::bigint as n_different from orders")
def incremental_equals_full(t: Tables):
    root = scratch(t.spark, "incremental")
    for part in halves(t.orders):
        feed = transaction_rows(part, t.lineitem).withColumn(INGESTED, F.lit(AT))
        feed.write.mode("append").parquet(f"{root}/bronze")
        stream = stream_files(t.spark, feed.schema, f"{root}/bronze")
        incremental_view(stream, enriched_transactions, f"{root}/silver", f"{root}/checkpoint")
    full = enriched_transactions(t.spark.read.parquet(f"{root}/bronze"))
    made = t.spark.read.parquet(f"{root}/silver")
    missing = set_difference(full, made)
    return (
        full.agg(F.count(F.lit(1)).alias("n_full"))
        .withColumn("n_incremental", made.agg(F.count(F.lit(1)).alias("n")).scalar())
        .withColumn("n_different", missing.agg(F.count(F.lit(1)).alias("n")).scalar())
    )


@query(
    """select * exclude (rn) from (select *, row_number() over (
        partition by user_id order by ts desc, event_id desc) as rn from events) where rn = 1"""
)
def scd1_upsert(t: Tables):
    root = scratch(t.spark, "scd1")
    rule = (["user_id"], ["ts"], ["event_id"])
    later = F.dayofmonth("ts") > 20
    for part in (t.events.filter(later), t.events.filter(~later)):
        part.write.mode("append").parquet(f"{root}/landing")
        stream = stream_files(t.spark, t.events.schema, f"{root}/landing")
        upsert_stream(stream, f"{root}/table", f"{root}/checkpoint", *rule)
        fold(t.spark, f"{root}/table", *rule)
    return current_rows(t.spark, f"{root}/table", *rule)


@query(
    """select * exclude (rn) from (select *, row_number() over (partition by user_id
        order by ts desc, event_type = 'purchase' desc, event_id desc) as rn from events)
    where rn = 1 and event_type <> 'purchase'"""
)
def scd1_deletes(t: Tables):
    """A purchase deletes its user; the batches come in any order of time."""
    root = scratch(t.spark, "scd1-deletes")
    rule = (["user_id"], ["ts"], ["event_id"])
    for part in range(3):
        t.events.filter(F.col("event_id") % 3 == part).write.mode("append").parquet(f"{root}/landing")
        stream = stream_files(t.spark, t.events.schema, f"{root}/landing")
        upsert_stream(
            stream, f"{root}/table", f"{root}/checkpoint", *rule, deletes="event_type = 'purchase'", fanout=2
        )
    return current_rows(t.spark, f"{root}/table", *rule)


@query(
    """select * from (select *, ts as valid_from,
        lead(ts) over (partition by user_id order by ts, event_id) as valid_to from events)
    where event_type <> 'purchase'"""
)
def scd2_apply(t: Tables):
    """Three batches of events in any order of time; a purchase closes the user's interval."""
    root = scratch(t.spark, "scd2-apply")
    rule = (["user_id"], "ts", ["event_id"])
    for part in range(3):
        t.events.filter(F.col("event_id") % 3 == part).write.mode("append").parquet(f"{root}/landing")
        stream = stream_files(t.spark, t.events.schema, f"{root}/landing")
        apply_history(
            stream, f"{root}/table", f"{root}/checkpoint", *rule, deletes="event_type = 'purchase'",
            start="valid_from", end="valid_to", buckets=8, fanout=2,
        )
    return history_rows(t.spark, f"{root}/table", *rule)


@query(
    f"""with o as (select * replace (case when o_orderkey % 11 = 0 then o_totalprice * 2
        else o_totalprice end as o_totalprice) from orders where o_orderkey % 13 <> 0)
    select o_custkey, {ORDER_METRICS_SQL} from o group by o_custkey"""
)
def gold_incremental(t: Tables):
    """Two batches of orders, then corrections: some prices double, some orders are withdrawn."""
    view = DeltaView(t.spark, scratch(t.spark, "gold-states"), ["o_custkey"], order_metrics(), fanout=2)
    for n, part in enumerate(halves(t.orders)):
        view.apply(n, part)
    doubled = (F.col("o_orderkey") % 11 == 0) & (F.col("o_orderkey") % 13 != 0)
    withdrawn = F.col("o_orderkey") % 13 == 0
    after = t.orders.filter(doubled).withColumn("o_totalprice", F.col("o_totalprice") * 2)
    view.apply(2, after, retracted=t.orders.filter(doubled | withdrawn))
    return view.rows()


@query(
    """select o_orderkey, o_custkey, case when o_orderstatus = 'F' then 'done' else 'open' end as flow
    from orders"""
)
def table_stream_flows(t: Tables):
    """Two ingested tables flow into one sink, a load at a time."""
    root = scratch(t.spark, "flows")
    done = F.col("o_orderstatus") == "F"
    sides = {"done": t.orders.filter(done), "open": t.orders.filter(~done)}
    for k in range(2):
        for name, side in sides.items():
            side.filter(F.col("o_orderkey") % 2 == k).write.parquet(f"{root}/{name}-landing/load{k}")
            ingest_files(
                t.spark, f"{root}/{name}-landing", f"{root}/{name}", f"{root}/{name}-checkpoint", ingested_at=AT
            )
            append_flow(
                t.spark, f"{root}/{name}", f"{root}/sink", f"{root}/{name}-flow", name,
                lambda rows, name=name: rows.select("o_orderkey", "o_custkey", F.lit(name).alias("flow")),
            )
    return read_flows(t.spark, f"{root}/sink", list(sides))


@query("select * from events")
def partitioned_scan(t: Tables):
    root = scratch(t.spark, "dated")
    dated = t.events.withColumns({"anio": F.year("ts"), "mes": F.month("ts"), "dia": F.dayofmonth("ts")})
    parts = ["anio", "mes", "dia"]
    dated.hint("rebalance", *parts).write.partitionBy(*parts).parquet(root)
    return scan_dated(t.spark, root)


@query("select * from events where ts >= timestamp '2024-01-08' and ts < timestamp '2024-01-13'")
def dated_folder_scan(t: Tables):
    """Five days; the folders of all others are not listed."""
    root = scratch(t.spark, "days")
    parts = {"anio": F.year("ts"), "mes": F.month("ts"), "dia": F.dayofmonth("ts")}
    t.events.withColumns(parts).hint("rebalance", *parts).write.partitionBy(*parts).parquet(root)
    return scan_days(t.spark, root, datetime.date(2024, 1, 8), datetime.date(2024, 1, 12))


@query(
    """select l_orderkey, l_linenumber, l_quantity, l_discount, l_returnflag from lineitem
    where l_quantity > 5"""
)
def stream_expect_or_drop(t: Tables):
    return expected_items(t)[0]


@query(
    """select (l_returnflag = 'R')::bigint as batch_id, unnest(['bulk', 'discounted', 'keyed']) as expectation,
      unnest(['drop', 'keep', 'fail']) as action, count(*) as n_rows,
      unnest([count(*) filter (where l_quantity <= 5), count(*) filter (where coalesce(l_discount, 0) <= 0),
        0]) as n_violations from lineitem group by l_returnflag = 'R'"""
)
def stream_expect_counts(t: Tables):
    return expected_items(t)[1]


def expected_items(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Two loads of lineitem through a stream with expectations: rows and counts."""
    root = scratch(t.spark, "expect")
    columns = ["l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_returnflag"]
    returned = F.col("l_returnflag") == "R"
    items = t.lineitem.select(*columns)
    for part in (items.filter(~returned), items.filter(returned)):
        part.write.mode("append").parquet(f"{root}/landing")
        expecting_stream(
            stream_files(t.spark, items.schema, f"{root}/landing"), f"{root}/table", f"{root}/metrics",
            f"{root}/checkpoint", drop={"bulk": "l_quantity > 5"}, keep={"discounted": "l_discount > 0"},
            fail={"keyed": "l_orderkey IS NOT NULL"},
        )
    return expected_rows(t.spark, f"{root}/table"), expectation_counts(t.spark, f"{root}/metrics")


@query("select * from events")
def recursive_scan(t: Tables):
    root = scratch(t.spark, "folders")
    late = F.dayofmonth("ts") > 15
    t.events.filter(late).write.parquet(f"{root}/2024/01/b")
    t.events.filter(~late).write.parquet(f"{root}/2024/01/a")
    return scan_dated(t.spark, f"{root}", recursive=True)


@query(
    """select o_custkey, count(*) as n_orders, max(o_orderdate) as last_order from orders
    group by o_custkey"""
)
def mv_refresh(t: Tables):
    root = scratch(t.spark, "view")
    for orders in (halves(t.orders)[0], t.orders):
        view = orders.groupBy("o_custkey").agg(
            F.count(F.lit(1)).alias("n_orders"), F.max("o_orderdate").alias("last_order")
        )
        sinks.refresh_view(view, root)
    return sinks.current_view(t.spark, root)


@query("select * from orders")
def clustered_layout(t: Tables):
    path = scratch(t.spark, "clustered")
    sinks.write_clustered(t.orders, path, ["o_orderdate", "o_custkey", "o_orderpriority"], 8)
    return t.spark.read.parquet(path)


@query(
    """select count(*) as n_written, count(*) as n_read, 11 as columns_written, 11 as columns_read,
      true as ok from lineitem"""
)
def write_readback_counts(t: Tables):
    return sinks.write_verified(t.lineitem, scratch(t.spark, "verified"))


@query("select * from orders")
def compact_files(t: Tables):
    root = scratch(t.spark, "small")
    sinks.write_files(t.orders, f"{root}/many", 64)
    sinks.compact(t.spark, f"{root}/many", f"{root}/few")
    return t.spark.read.parquet(f"{root}/few")


@query("select * from orders")
def compact_incremental(t: Tables):
    """Many small files, packed after each load; the second time only new files are rewritten."""
    table = FileList(t.spark, scratch(t.spark, "file-list"))
    for part in halves(t.orders):
        table.append(part.repartition(24))
        table.compact(target_bytes=128 << 10, order=["o_orderdate"])
    return table.read()


@query("select * from orders where o_custkey between 100 and 120")
def nested_layout(t: Tables):
    """A filter on the second cluster column, which skips most files."""
    path = scratch(t.spark, "nested")
    sinks.write_nested(t.orders, path, ["o_orderdate", "o_custkey"], file_bytes=16 << 10)
    return t.spark.read.parquet(path).filter(F.col("o_custkey").between(100, 120))


@query("select * from lineitem")
def balanced_write(t: Tables):
    path = scratch(t.spark, "balanced")
    sinks.write_balanced(t.lineitem, path, "l_returnflag")
    return t.spark.read.parquet(path)
