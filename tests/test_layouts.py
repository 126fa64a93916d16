"""Footers, dated folders, nested clusters and packed files."""

import datetime
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.session import scratch
from tierflow.sources import storage
from tierflow.sources.filelist import FileList, first_fit
from tierflow.sources.files import dated_folders, scan_days
from tierflow.sources.footers import file_schema, grouped_by_schema
from tierflow.sources.sinks import bucket_of, column_bounds, ranges_for, write_nested
from tierflow.streaming.ingest import file_groups, ingest_files, read_ingested


def test_footers_of_many_files_in_one_job(spark):
    """A thousand files of two types: one job reads the footers, two scans read the rows."""
    root = scratch(spark, "footers")
    rows = spark.range(0, 500, numPartitions=500)
    rows.select("id", F.col("id").alias("v")).write.parquet(f"{root}/in/a")
    rows.select("id", F.col("id").cast("string").alias("v"), F.lit(1).alias("more")).write.parquet(f"{root}/in/b")
    paths = [f"{root}/in/{p}" for p, _ in storage.data_files(spark, f"{root}/in")]
    assert len(paths) == 1000
    spark.sparkContext.setJobGroup("footers", "footers")
    groups, unread = grouped_by_schema(spark, paths)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("footers")
    spark.sparkContext._jsc.clearJobGroup()
    # Adaptive execution runs the map side of the one shuffle query as jobs of its own.
    assert unread == [] and len(jobs) <= 3
    assert [(len(p), s.simpleString()) for p, s in groups] == [
        (500, "struct<id:bigint,v:bigint>"), (500, "struct<id:bigint,v:string,more:int>"),
    ]
    ingest_files(spark, f"{root}/in", f"{root}/t", f"{root}/check")
    made = read_ingested(spark, f"{root}/t")
    assert made.count() == 1000 and made.agg(F.sum("v")).first()[0] == 2 * sum(range(500))


def test_footers_join_columns_and_keep_types_apart(spark):
    root = scratch(spark, "groups")
    kinds = ["k bigint, a int", "k bigint, b string", "k string", "k bigint, a string"]
    for n, kind in enumerate(kinds):
        spark.createDataFrame([], kind).coalesce(1).write.parquet(f"{root}/{n} [x]")
    paths = [f"{root}/{p}" for p, _ in storage.data_files(spark, root)]
    found = [s.simpleString() for _, s in file_groups(spark, paths)]
    assert found == ["struct<k:bigint,a:int,b:string>", "struct<k:string>", "struct<k:bigint,a:string>"]
    groups, unread = grouped_by_schema(spark, [*paths, "nosuch://x/y", f"{root}/missing"])
    assert len(groups) == 3 and sorted(unread) == sorted(["nosuch://x/y", f"{root}/missing"])


def test_footers_of_files_that_spark_did_not_write(spark, tmp_path):
    import pyarrow as pa

    pq.write_table(pa.table({"k": pa.array([1], pa.int32()), "s": ["x"]}), f"{tmp_path}/own.parquet")
    schema = file_schema(f"file:{tmp_path}/own.parquet")
    assert schema == T.StructType.fromDDL("k int, s string")


@pytest.mark.parametrize("names", ["{y:04d}/{m:02d}/{d:02d}", "anio={y}/mes={m}/dia={d}"])
def test_a_scan_of_days_lists_only_their_folders(spark, names, monkeypatch):
    root = scratch(spark, "days")
    days = [datetime.date(2001, 7, 31) + datetime.timedelta(days=k) for k in range(0, 40, 4)]
    days += [datetime.date(2000, 1, 1), datetime.date(2002, 5, 5)]
    for d in days:
        spark.createDataFrame([(d,)], "d date").coalesce(1).write.parquet(
            f"{root}/{names.format(y=d.year, m=d.month, d=d.day)}"
        )
    one = datetime.date(2001, 8, 4)
    assert scan_days(spark, root, one, one).collect() == [(one,)]
    listed = []
    opened = storage._open
    monkeypatch.setattr(storage, "_open", lambda spark, path: listed.append(path) or opened(spark, path))
    found = dated_folders(spark, root, one, one)
    month = names.format(y=2001, m=8, d=0).rpartition("/")[0]
    assert found == [f"{root}/{names.format(y=2001, m=8, d=4)}"]
    assert listed == [root, f"{root}/{month.partition('/')[0]}", f"{root}/{month}"]
    files = scan_days(spark, root, one, one).inputFiles()
    assert len(files) == 1 and found[0] in files[0]
    for first, last in [("2001-07-31", "2001-09-30"), ("2000-01-01", "2001-12-31"), ("1990-01-01", "2030-01-01")]:
        first, last = datetime.date.fromisoformat(first), datetime.date.fromisoformat(last)
        rows = scan_days(spark, root, first, last).collect()
        assert sorted(r.d for r in rows) == sorted(d for d in days if first <= d <= last)
    none = datetime.date(2010, 1, 1)
    assert scan_days(spark, root, none, none, T.StructType.fromDDL("d date")).count() == 0
    with pytest.raises(ValueError):
        scan_days(spark, root, none, none)


def test_bounds_and_buckets(spark):
    df = spark.range(10_000).select(F.when(F.col("id") % 10 > 0, F.col("id")).alias("v"))
    bounds = column_bounds(df, "v", 8, 10_000)
    assert len(bounds) == 7 and bounds == sorted(bounds)
    shares = df.groupBy(bucket_of("v", bounds).alias("b")).count().collect()
    sizes = {r.b: r["count"] for r in shares}
    assert sizes.pop(-1) == 1000 and set(sizes) == set(range(8)) and max(sizes.values()) < 2 * min(sizes.values())
    assert column_bounds(df, "v", 1, 10_000) == [] == column_bounds(df.filter("false"), "v", 4, 0)


@pytest.mark.parametrize("hot", [False, True])
def test_nested_layout_prunes_on_every_column(spark, hot):
    """Filters on any column skip most files, and no file passes twice the target."""
    path = scratch(spark, "nested")
    a, b, c = (F.pmod(F.xxhash64("id", F.lit(k)), F.lit(100_000)) for k in range(3))
    if hot:
        a = F.when(F.col("id") % 3 == 0, 5).otherwise(a)
    rows = spark.range(0, 200_000, numPartitions=8).select(a.alias("a"), b.alias("b"), c.alias("c"), "id")
    target, total = 100_000, 200_000 * 26
    per_file = write_nested(rows, path, ["a", "b", "c"], target, total)
    files = sorted(Path(path).glob("*.parquet"))
    assert sum(pq.ParquetFile(f).metadata.num_rows for f in files) == 200_000
    assert all(pq.ParquetFile(f).metadata.num_rows <= per_file for f in files)
    assert max(f.stat().st_size for f in files) <= 2 * target
    for k in range(2 if hot else 3):
        ranges = []
        for f in files:
            meta = pq.ParquetFile(f).metadata
            stats = [meta.row_group(g).column(k).statistics for g in range(meta.num_row_groups)]
            ranges.append((min(s.min for s in stats), max(s.max for s in stats)))
        touched = sum(low <= 70_123 <= high for low, high in ranges)
        assert touched <= len(files) / 2


def test_first_fit_leaves_nothing_to_pack_again():
    sizes = [5, 3, 9, 1, 1, 2, 8, 4, 30]
    bins = first_fit(sizes, 10)
    assert sorted(k for held in bins for k in held) == list(range(len(sizes)))
    sums = [sum(sizes[k] for k in held) for held in bins]
    assert all(s <= 10 or len(held) == 1 for s, held in zip(sums, bins, strict=True))
    assert all(x + y > 10 for n, x in enumerate(sums) for y in sums[:n])


def test_compaction_rewrites_small_files_once(spark, as_rows):
    table = FileList(spark, scratch(spark, "packed"))
    with pytest.raises(ValueError):
        table.read()
    table.append(spark.range(0, 60_000, numPartitions=1))
    big = table.files()
    table.append(spark.range(60_000, 61_000, numPartitions=20).withColumn("x", F.lit("y")))
    target = 2 * big[0]["bytes"]
    assert table.compact(target, ["id"]) == 20
    files = table.files()
    assert big[0] in files and len(files) < 6
    assert table.compact(target, ["id"]) == 0 and table.files() == files
    ordered = [r.id for r in spark.read.parquet(f"{table.root}/{files[-1]['path']}").collect()]
    assert ordered == sorted(ordered)
    rows = table.read()
    assert rows.count() == 61_000 and rows.filter("x = 'y'").count() == 1000
    before = as_rows(rows.filter("id > 59990"))
    assert table.vacuum(keep_states=1) == 20
    assert as_rows(table.read().filter("id > 59990")) == before
    with pytest.raises(ValueError, match="bigint"):
        table.append(spark.createDataFrame([("a",)], "id string"))


def test_ranges_follow_the_memory_of_wide_rows():
    assert ranges_for(1000, 70, 10_000) == 1
    assert ranges_for(9_000_000, 70, 200 << 20) >= 9_000_000 * 70 * 8 / (512 << 20)
    assert ranges_for(10, 2, 3 << 30) == 12
