"""Newest row per key and slowly changing history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierflow.session import scratch


def latest_by_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    tie: Sequence[str],
) -> DataFrame:
    """One row per key: the highest `order`, ties decided by the highest `tie`.

    The row_number() = 1 filter becomes a per-partition limit ahead of the shuffle,
    so a key holding a large share of the rows sends one row per input partition.
    """
    newest = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in [*order, *tie]])
    return df.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")


def latest_by_key_agg(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], tie: Sequence[str]
) -> DataFrame:
    """Same result as `latest_by_key` through an aggregate with map-side combine."""
    others = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*others), F.struct(*order, *tie))
    picked = df.groupBy(*keys).agg(best.alias("_row")).select(*keys, "_row.*")
    return picked.select(*df.columns)


#: A key with more rows than this is spread over several tasks by `scd2_history`.
HEAVY_ROWS = 4_000_000


def scd2_history(
    df: DataFrame,
    keys: Sequence[str],
    seq: str,
    tie: Sequence[str],
    start: str = "__START_AT",
    end: str = "__END_AT",
    heavy_rows: int = HEAVY_ROWS,
    partitions: int | None = None,
) -> DataFrame:
    """Validity interval of every row: from its own `seq` to the next one of its key.

    Keys of up to `heavy_rows` rows take a window per key. Those of heavier keys are
    range-partitioned on key, `seq`, `tie` and a row hash, into `partitions` if given, so that one key
    may hold all rows, even at one time: the next row is looked up inside each partition,
    and its last row takes the first row of the following partition from a summary of one row per
    partition. `seq` may have any type that sorts; nulls come first and are equal as keys.
    """
    keyed = df.withColumn("_key", F.struct(*keys))
    counted = keyed.groupBy("_key").agg(F.count(F.lit(1)).alias("n"))
    heavy = counted.filter(F.col("n") > heavy_rows).select("_key")
    order = [seq, *tie]
    if heavy.isEmpty():
        ended = _next_in(keyed, ["_key"], order, seq)
    else:
        # At most one key per `heavy_rows` rows; written, since it is used twice.
        path = scratch(df.sparkSession, "heavy-keys")
        heavy.write.parquet(path)
        heavy = df.sparkSession.read.schema(heavy.schema).parquet(path)
        light = keyed.join(heavy, "_key", "left_anti")
        hot = _in_ranges(keyed.join(heavy, "_key", "left_semi"), keys, order, partitions)
        ended = _next_in(light, ["_key"], order, seq).unionByName(_next_across(hot, order, seq))
    return ended.withColumns({start: F.col(seq), end: F.col("_next.at")}).select(*df.columns, start, end)


def _next_in(df: DataFrame, group: Sequence[str], order: Sequence[str], seq: str) -> DataFrame:
    """Adds the `seq` of the next row of the group, as a struct that is null for the last one."""
    within = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("_next", F.lead(F.struct(F.col(seq).alias("at"))).over(within))


def _in_ranges(df: DataFrame, keys: Sequence[str], order: Sequence[str], partitions: int | None) -> DataFrame:
    """Rows in ascending ranges, numbered by `_part`. Written once: the numbers must not
    change between the two uses, nor when a task is run again."""
    salt = [F.xxhash64(*[c for c in df.columns if c != "_key"]), F.spark_partition_id()]
    count = [] if partitions is None else [partitions]
    ranged = df.repartitionByRange(*count, *keys, *order, *salt)
    path = scratch(df.sparkSession, "history")
    ranged.withColumn("_part", F.spark_partition_id()).write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _next_across(ranged: DataFrame, order: Sequence[str], seq: str) -> DataFrame:
    """The next row of the key inside each range, or else the first one of the range that follows."""
    first = F.min(F.struct("_key", F.col(seq).alias("at"))).alias("first")
    following = F.lead("first").over(Window.orderBy("_part"))
    # One row per range.
    carry = ranged.groupBy("_part").agg(first).select("_part", following.alias("_carry"))
    inside = _next_in(ranged, ["_part", "_key"], order, seq)
    carried = F.when(F.col("_carry._key").eqNullSafe(F.col("_key")), F.struct(F.col("_carry.at").alias("at")))
    joined = inside.join(carry, "_part", "left").withColumn("_next", F.coalesce("_next", carried))
    return joined.drop("_part", "_carry")
