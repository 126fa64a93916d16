"""Single-pass conditional aggregation and grouped summaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierflow.functions.scalar import as_col, nz


@dataclass(frozen=True)
class Metric:
    """One conditional metric: `kind` is count, avg or sum.

    With `scale` the amounts are added as decimals of that many places, which makes
    the total independent of the order in which partitions are combined.
    """

    name: str
    kind: str
    when: Column
    value: str | Column | None = None
    scale: int | None = None

    def column(self) -> Column:
        if self.kind == "count":
            return F.count_if(self.when).alias(self.name)
        amount = F.when(self.when, nz(as_col(self.value)))
        if self.scale is None:
            made = F.avg(amount) if self.kind == "avg" else F.sum(amount)
        else:
            made = F.sum(amount.cast(f"decimal(18,{self.scale})")).cast("double")
            if self.kind == "avg":
                made = made / F.count_if(self.when)
                made = F.when(F.count_if(self.when) > 0, made)
        return F.coalesce(made, F.lit(0.0)).alias(self.name)


def conditional_aggs(df: DataFrame, keys: Sequence[str], metrics: Sequence[Metric]) -> DataFrame:
    """All metrics per key in one scan and one shuffle of partial aggregates."""
    return df.groupBy(*keys).agg(*[m.column() for m in metrics])


def group_counts(df: DataFrame, keys: Sequence[str], name: str = "n_rows") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def top_groups(df: DataFrame, keys: Sequence[str], k: int, name: str = "n_rows") -> DataFrame:
    """The k largest groups; equal sizes are ordered by key."""
    return group_counts(df, keys, name).orderBy(F.desc(name), *keys).limit(k)


def range_by_category(df: DataFrame, category: str, value: str) -> DataFrame:
    """Least and greatest value of every category in one aggregate."""
    return df.groupBy(category).agg(
        F.min(value).alias("min_value"),
        F.max(value).alias("max_value"),
        F.count(F.lit(1)).alias("n_rows"),
    )


def band_shares(
    df: DataFrame, kind: str, bands: Mapping[str, Sequence[str]], other: str = "OTHER"
) -> DataFrame:
    """Rows and percentage of all rows per band of category codes.

    The closing window holds one row per band, however large the table is.
    """
    label = None
    for band, codes in bands.items():
        hit = F.col(kind).isin(*codes)
        label = F.when(hit, band) if label is None else label.when(hit, band)
    counted = group_counts(df.withColumn("band", label.otherwise(other)), ["band"])
    all_rows = F.sum("n_rows").over(Window.partitionBy(F.lit(1)))
    return counted.withColumn("share_pct", F.col("n_rows") * 100 / all_rows)


def table_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: row count, and min, max and constancy per column."""
    made = [F.count(F.lit(1)).alias("n_rows")]
    for c in columns:
        made += [
            F.min(c).alias(f"{c}_min"),
            F.max(c).alias(f"{c}_max"),
            (F.min(c) == F.max(c)).alias(f"{c}_constant"),
        ]
    return df.agg(*made)
