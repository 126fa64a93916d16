"""Literal tables that the optimizer knows to be small."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def literal_table(spark: SparkSession, rows: Sequence[Sequence[object]], ddl: str) -> DataFrame:
    """Rows typed in by the caller, as one expanded array of constants.

    Unlike rows shipped from Python, it has a real size estimate, so joins to it are
    broadcast by the ordinary size rule and without a shuffle.
    """
    fields = T.StructType.fromDDL(ddl).fields
    lines = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for f, v in zip(fields, row)])
        for row in rows
    ]
    return spark.sql("SELECT 1 AS one").select(F.inline(F.array(*lines)))
