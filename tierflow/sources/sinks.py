"""Table writes: versioned refresh, clustered layout, compaction and verified writes."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tierflow.operators.projection import lead_with
from tierflow.sources import storage


def refresh_view(df: DataFrame, root: str) -> str:
    """Write the full result as the next version folder and return its path.

    The folder being read is never overwritten, and a version that did not finish is
    never read, so a refresh may fail and be repeated.
    """
    taken = storage.numbered(df.sparkSession, root, "version")
    path = f"{root}/version={(taken[-1] if taken else 0) + 1}"
    df.write.mode("errorifexists").parquet(path)
    return path


def current_view(spark: SparkSession, root: str) -> DataFrame:
    """The newest completed version."""
    done = storage.newest_complete(spark, root, "version")
    if done is None:
        raise ValueError(f"no completed version under {root}")
    return spark.read.parquet(f"{root}/version={done}")


def files_for(total_bytes: int, target_bytes: int = 256 << 20) -> int:
    return max(1, math.ceil(total_bytes / target_bytes))


#: Memory of the rows that one task of a clustered write sorts, about, and bytes a column takes there.
SORT_BYTES, COLUMN_BYTES = 256 << 20, 16


def ranges_for(rows: int, columns: int, total_bytes: int, target_bytes: int = 256 << 20) -> int:
    """Ranges of a clustered write: by the size of its files, and by the memory that sorting takes.

    Wide rows of many nulls are small as files and large when they are sorted.
    """
    return max(files_for(total_bytes, target_bytes), math.ceil(rows * columns * COLUMN_BYTES / SORT_BYTES))


#: Ranges per clustered write, at most: more would be bounded by too few sampled rows each.
#: `write_nested` cuts the files of larger ranges in the task.
MAX_RANGES = 4096


def cluster_rows(
    df: DataFrame,
    columns: Sequence[str],
    partitions: int | None = None,
    salt: Sequence[str] | None = None,
) -> DataFrame:
    """Range-partition and sort on the clustering columns, so file and row-group
    min/max ranges barely overlap and filters on them skip data.

    A hash of the `salt` columns (a key of the table; by default of the whole row) and
    then the input partition id extend the range key: a value that fills a large share of
    the table, even as copies of one row, is cut over neighbouring files instead of
    filling one. Both are the same when a task is rerun. Without `partitions` adaptive execution merges the ranges up to its advisory size.
    """
    ordered = lead_with(df, columns)
    salts = [F.xxhash64(*(salt or df.columns)), F.spark_partition_id()]
    count = [] if partitions is None else [min(partitions, MAX_RANGES)]
    return ordered.repartitionByRange(*count, *columns, *salts).sortWithinPartitions(*columns)


def write_clustered(
    df: DataFrame, path: str, columns: Sequence[str], partitions: int | None = None
) -> None:
    if not 1 <= len(columns) <= 4:
        raise ValueError("cluster on one to four columns")
    cluster_rows(df, columns, partitions).write.mode("overwrite").parquet(path)


#: Buckets of a leading column in a nested layout, and rows sampled per bucket for its bounds.
MAX_BUCKETS, SAMPLED = 1024, 200


def column_bounds(df: DataFrame, column: str, buckets: int, rows: int) -> list:
    """Values that cut the column into about equal buckets, from a sample whose size they bound."""
    if buckets < 2 or not rows:
        return []
    wanted = buckets * SAMPLED
    some = df.select(F.col(column).alias("v")).filter("v is not null")
    sample = some.sample(min(1.0, 2 * wanted / rows), seed=7).limit(4 * wanted)
    values = sorted(r.v for r in sample.collect())
    if not values:
        return []
    return sorted({values[len(values) * k // buckets] for k in range(1, buckets)})


def bucket_of(column: str, bounds: Sequence) -> Column:
    """The number of bounds up to the value, by halving; nulls stand before the first bucket."""

    def place(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(F.col(column) < F.lit(bounds[middle]), place(low, middle)).otherwise(place(middle + 1, high))

    return F.when(F.col(column).isNull(), F.lit(-1)).otherwise(place(0, len(bounds)))


def write_nested(
    df: DataFrame, path: str, columns: Sequence[str], file_bytes: int = 256 << 20, total_bytes: int | None = None
) -> int:
    """Clustered files on two or three columns, each of which prunes; returns the rows a file may hold.

    All columns but the last are cut into buckets at sampled quantiles. Rows are range-partitioned
    on the buckets and the last column (with a row hash and the input partition, so that a
    hot value is cut too) into MAX_RANGES ranges at most, sorted, and cut in the task into
    files of about `file_bytes`. `total_bytes` is the size of the whole table as files (by default that of
    the files it is read from).
    """
    if not 2 <= len(columns) <= 3:
        raise ValueError("nest two or three columns")
    spark = df.sparkSession
    if total_bytes is None:
        total_bytes = sum(storage.total_bytes(spark, f) for f in df.inputFiles())
    rows = df.count()
    files = files_for(total_bytes, file_bytes)
    per_file = max(1, math.ceil(rows / files))
    buckets = min(MAX_BUCKETS, math.ceil(files ** (1 / len(columns))))
    numbers = {}
    for k, c in enumerate(columns[:-1]):
        numbers[f"_nest{k}"] = bucket_of(c, column_bounds(df, c, buckets, rows))
    nested = lead_with(df, columns).withColumns(numbers)
    salts = [F.xxhash64(*df.columns), F.spark_partition_id()]
    ranged = nested.repartitionByRange(min(files, MAX_RANGES), *numbers, columns[-1], *salts)
    ordered = ranged.sortWithinPartitions(*numbers, columns[-1]).drop(*numbers)
    ordered.write.mode("overwrite").option("maxRecordsPerFile", per_file).parquet(path)
    return per_file


def write_files(df: DataFrame, path: str, files: int) -> None:
    """Overwrite with a given number of evenly filled files."""
    df.repartition(files).write.mode("overwrite").parquet(path)


def write_balanced(df: DataFrame, path: str, *columns: str) -> None:
    """Overwrite with adaptively sized files, rows of equal `columns` kept near each
    other; adaptive execution splits the large partitions and joins the small ones."""
    df.hint("rebalance", *columns).write.mode("overwrite").parquet(path)


def compact(spark: SparkSession, source: str, target: str, target_bytes: int = 256 << 20) -> int:
    """Rewrite many small files as files of about `target_bytes`, without a shuffle.

    The scan itself packs small files into splits of that size; each split becomes
    one file. Returns the planned number of files.
    """
    total = storage.total_bytes(spark, source)
    own = spark.newSession()
    own.conf.set("spark.sql.files.maxPartitionBytes", str(target_bytes))
    own.conf.set("spark.sql.files.openCostInBytes", "0")
    own.conf.set("spark.sql.files.minPartitionNum", "1")
    own.read.parquet(source).write.mode("errorifexists").parquet(target)
    return files_for(total, target_bytes)


def write_verified(df: DataFrame, path: str) -> DataFrame:
    """Write, read back, and compare with the rows counted while writing."""
    spark = df.sparkSession
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(path)
    written = spark.read.parquet(path)
    return written.agg(F.count(F.lit(1)).alias("n_read")).select(
        F.lit(seen.get["n"]).cast("bigint").alias("n_written"),
        "n_read",
        F.lit(len(df.columns)).alias("columns_written"),
        F.lit(len(written.columns)).alias("columns_read"),
        (
            (F.col("n_read") == seen.get["n"]) & F.lit(written.columns == df.columns)
        ).alias("ok"),
    )
