"""Dense indexes and surrogate keys without a single-task sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_BUCKETS = 100_000


def one_row_per_key(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], key: str, row: str
) -> DataFrame:
    """Key struct and row struct of a table whose keys are unique; a repeated key fails.

    A count per key (a hash aggregate over the keys alone, combined on the map side) runs
    first, as a scalar subquery; its maximum decides before any row is joined. As a
    struct, null keys compare equal.
    """
    most = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("m")).scalar()
    stop = F.raise_error(F.lit(f"the key {', '.join(keys)} occurs more than once"))
    checked = F.when(F.coalesce(most, F.lit(0)) <= 1, F.struct(*columns)).otherwise(stop)
    return df.select(F.struct(*keys).alias(key), checked.alias(row))


def dense_index(
    df: DataFrame,
    key: str,
    name: str = "idx",
    start: int | Column = 0,
    buckets: int = 4096,
    bucket: Column | None = None,
) -> DataFrame:
    """Number the rows start, start+1, ... without gaps; `key` must be unique.

    Rows are ranked inside hash buckets and shifted by the size of all earlier
    buckets, so the numbering depends on the keys only, not on partitioning or
    retries. The offset table has at most `buckets` rows, which bounds both its
    running-sum task and its broadcast.
    """
    if not 0 < buckets <= MAX_BUCKETS:
        raise ValueError(f"buckets must be between 1 and {MAX_BUCKETS}")
    slot = F.pmod(F.xxhash64(key) if bucket is None else bucket, F.lit(buckets))
    cut = df.withColumn("_bucket", F.coalesce(slot, F.lit(0)))
    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        cut.groupBy("_bucket")
        .agg(F.count(F.lit(1)).alias("_size"))
        .select("_bucket", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset"))
    )
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy(key))
    shift = F.lit(start) if isinstance(start, int) else start
    return (
        cut.withColumn("_rank", rank)
        .join(F.broadcast(offsets), "_bucket")
        .withColumn(name, (F.col("_offset") + F.col("_rank") - 1 + shift).cast("bigint"))
        .drop("_bucket", "_rank", "_offset")
    )


def row_sequence(df: DataFrame, name: str = "id") -> DataFrame:
    """The integers 0 .. number of rows - 1."""
    return df.sparkSession.range(df.count()).withColumnRenamed("id", name)


def continue_key(
    df: DataFrame, key: str, newcomers: DataFrame, order: str, **index_args
) -> DataFrame:
    """Newcomers with `key` running on from the highest key of `df`."""
    following = F.coalesce(df.agg(F.max(key).alias("m")).scalar(), F.lit(-1)) + 1
    return dense_index(newcomers.drop(key), order, key, start=following, **index_args)
