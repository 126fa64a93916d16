"""Row-level change feed between two versions of a keyed table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.operators.keys import one_row_per_key

KINDS = ("insert", "update_preimage", "update_postimage", "delete")


def table_changes(
    old: DataFrame, new: DataFrame, keys: Sequence[str], kind: str = "_change_type"
) -> DataFrame:
    """Inserts, deletes and both images of every update; unchanged rows are left out.

    Keys are unique in each version; a repeated one fails. The row structs are compared
    value by value (nulls equal), and equal rows are filtered out right after the join,
    before anything is expanded.
    """
    names = old.columns
    before = one_row_per_key(old, keys, names, "_old_key", "_old")
    after = one_row_per_key(new, keys, names, "_new_key", "_new")
    pair = before.join(after, F.col("_old_key") == F.col("_new_key"), "full")
    gone, born = F.col("_new_key").isNull(), F.col("_old_key").isNull()
    moved = pair.filter(gone | born | ~F.col("_old").eqNullSafe(F.col("_new")))

    def image(label: str, row: str) -> Column:
        return F.struct(F.lit(label).alias(kind), F.col(row).alias("row"))

    images = (
        F.when(born, F.array(image("insert", "_new")))
        .when(gone, F.array(image("delete", "_old")))
        .otherwise(
            F.array(image("update_preimage", "_old"), image("update_postimage", "_new"))
        )
    )
    return moved.select(F.explode(images).alias("c")).select("c.row.*", f"c.{kind}")


def apply_changes(
    old: DataFrame, changes: DataFrame, keys: Sequence[str], kind: str = "_change_type"
) -> DataFrame:
    """The version that `changes` leads to, starting from `old`."""
    touched = changes.filter(F.col(kind) != "insert").select(F.struct(*keys).alias("_key"))
    kept = (
        old.withColumn("_key", F.struct(*keys))
        .join(touched.distinct(), "_key", "left_anti")
        .select(*old.columns)
    )
    arrived = changes.filter(F.col(kind).isin("insert", "update_postimage"))
    return kept.unionByName(arrived.select(*old.columns))
