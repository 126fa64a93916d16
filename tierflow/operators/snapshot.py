"""Next version of a keyed table: changed rows, unchanged rows and newcomers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.operators.keys import dense_index, one_row_per_key


def evolve_snapshot(
    df: DataFrame,
    changed: Column,
    updates: Mapping[str, Column],
    stamps: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Rewrite `updates` and `stamps` on the flagged rows, in one pass over the table."""
    made = {**updates, **(stamps or {})}
    flag = F.coalesce(changed, F.lit(False))
    return df.withColumns({c: F.when(flag, new).otherwise(F.col(c)) for c, new in made.items()})


def grow_snapshot(
    df: DataFrame,
    key: str,
    growth: float,
    overrides: Mapping[str, Column] | None = None,
    buckets: int = 4096,
    bucket: Column | None = None,
) -> DataFrame:
    """round(rows * growth) newcomers modelled on existing rows, keys from max + 1.

    The keys alone are indexed, once: the first of them are the models, and a newcomer's
    key follows from its model's number. Wide rows are joined afterwards.
    """
    facts = df.agg(F.struct(F.count(F.lit(1)).alias("n"), F.max(key).alias("top")).alias("f")).scalar()
    wanted = F.round(facts["n"] * F.lit(growth))
    index = dense_index(df.select(key), key, "_idx", buckets=buckets, bucket=bucket)
    models = index.filter(F.col("_idx") < wanted)
    fresh = df.join(models, key).withColumn(key, facts["top"] + 1 + F.col("_idx"))
    return fresh.withColumns(dict(overrides or {})).select(*df.columns)


def snapshot_drift(old: DataFrame, new: DataFrame, key: str, watched: list[str]) -> DataFrame:
    """One row: kept, changed, added and removed keys, the changed share, and key continuity.

    Keys are unique in each snapshot; a repeated one fails. The comparison is null-safe,
    so a value that became null counts as changed.
    """
    before = one_row_per_key(old, [key], watched, "_old_id", "_old")
    after = one_row_per_key(new, [key], watched, "_new_id", "_new")
    both = before.join(after, F.col("_old_id") == F.col("_new_id"), "full").withColumns(
        {"_old_key": F.col(f"_old_id.{key}"), "_new_key": F.col(f"_new_id.{key}")}
    )
    matched = F.col("_old_id").isNotNull() & F.col("_new_id").isNotNull()
    added = F.col("_old_id").isNull()
    totals = both.agg(
        F.count_if(matched).alias("n_kept"),
        F.count_if(matched & ~F.col("_old").eqNullSafe(F.col("_new"))).alias("n_changed"),
        F.count_if(added).alias("n_added"),
        F.count_if(F.col("_new_id").isNull()).alias("n_removed"),
        F.max("_old_key").alias("max_old_key"),
        F.min(F.when(added, F.col("_new_key"))).alias("min_added_key"),
    )
    share = F.when(F.col("n_kept") > 0, F.col("n_changed") * 100 / F.col("n_kept"))
    follows = F.col("min_added_key") == F.col("max_old_key") + 1
    return totals.withColumns(
        {"changed_pct": F.coalesce(share, F.lit(0.0)), "keys_continue": follows}
    )
