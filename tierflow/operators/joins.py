"""Dimension joins, zero-filled measures, code lookups and key assignment.

No join here carries a broadcast hint on data of unknown size: Catalyst and adaptive
execution broadcast a side only when its measured size is under
spark.sql.autoBroadcastJoinThreshold, and split skewed partitions otherwise.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.functions.scalar import as_col
from tierflow.operators.keys import dense_index
from tierflow.operators.literals import literal_table


def dim_left_join(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str
) -> DataFrame:
    """Left join of two one-row-per-key tables; the right key column is dropped."""
    lookup = right.withColumnRenamed(right_key, "_right_key")
    return left.join(lookup, F.col(left_key) == F.col("_right_key"), "left").drop("_right_key")


def qualified_join(
    left: DataFrame,
    right: DataFrame,
    on: str,
    left_suffix: str,
    right_suffix: str,
) -> DataFrame:
    """Left join on a shared key; names present on both sides get a side suffix."""
    shared = (set(left.columns) & set(right.columns)) - {on}

    def side(df: DataFrame, suffix: str) -> DataFrame:
        return df.toDF(*[c + suffix if c in shared else c for c in df.columns])

    return side(left, left_suffix).join(side(right, right_suffix), on, "left")


def left_join_fill(
    left: DataFrame, right: DataFrame, on: str | Sequence[str], fills: Mapping[str, object]
) -> DataFrame:
    """Left join, then the listed right-hand measures become their fill where null."""
    joined = left.join(right, on, "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in fills.items()})


def code_table(
    spark: SparkSession, rows: Mapping[str, Sequence[object]], schema: str
) -> DataFrame:
    """A code list as a table: code first, then its values."""
    return literal_table(spark, [(code, *values) for code, values in rows.items()], schema)


def lookup(
    df: DataFrame, codes: DataFrame, on: str, defaults: Mapping[str, object] | None = None
) -> DataFrame:
    """Attach the code table's columns; unknown codes take the defaults."""
    fills = defaults or {}
    joined = df.join(codes, on, "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in fills.items()})


def anti_keys(df: DataFrame, known: DataFrame, key: str, known_key: str) -> DataFrame:
    """Keys of `df` absent from `known`, with their row counts.

    Both sides are reduced to one row per key before the join, so neither a hot key
    nor repeated parents make a large join partition.
    """
    counted = df.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n_rows"))
    parents = known.select(F.col(known_key).alias("key")).distinct()
    return counted.join(parents, "key", "left_anti")


def has_only(df: DataFrame, keys: Sequence[str], kind: str, wanted: str, absent: str) -> DataFrame:
    """Keys with at least one `wanted` row and not a single `absent` row, in one pass."""
    per_key = df.groupBy(*keys).agg(
        F.count_if(F.col(kind) == wanted).alias("n_rows"),
        F.count_if(F.col(kind) == absent).alias("_absent"),
    )
    return per_key.filter("n_rows > 0 AND _absent = 0").drop("_absent")


def assign_key(
    facts: DataFrame,
    fact_id: str,
    dim: DataFrame,
    key: str,
    digest: Column | None = None,
    buckets: int = 4096,
    dim_bucket: Column | None = None,
) -> DataFrame:
    """Give every fact an existing dimension key, the same one on every run.

    The distinct keys get a dense index; a fact takes index pmod(hash(id), n).
    """
    unique = dim.select(key).filter(F.col(key).isNotNull()).distinct()
    index = dense_index(unique, key, "_slot", buckets=buckets, bucket=dim_bucket)
    n_keys = unique.agg(F.count(F.lit(1)).alias("n")).scalar()
    chosen = F.xxhash64(as_col(fact_id)) if digest is None else digest
    slot = F.pmod(chosen, F.nullif(n_keys, F.lit(0).cast("bigint")))
    return facts.withColumn("_slot", slot).join(index, "_slot", "left").drop("_slot")
