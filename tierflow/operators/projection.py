"""Column selection, renaming and ordering; every operator is one projection node."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Bookkeeping columns of the ingest layer that later layers discard.
BOOKKEEPING = ("_rescued_data", "año", "anio", "mes", "dia")


def select_except(df: DataFrame, names: Sequence[str] = BOOKKEEPING) -> DataFrame:
    """All columns but the named ones; names that do not exist are ignored."""
    return df.drop(*names)


def rename_select(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Exactly the mapped columns, renamed, in mapping order."""
    return df.selectExpr(*[f"`{old}` AS `{new}`" for old, new in mapping.items()])


def lead_with(df: DataFrame, first: Sequence[str]) -> DataFrame:
    """The named columns first, all others after them in their present order."""
    missing = [name for name in first if name not in df.columns]
    if missing:
        raise ValueError(f"columns not in the table: {', '.join(missing)}")
    rest = [name for name in df.columns if name not in set(first)]
    return df.selectExpr(*[f"`{name}`" for name in [*first, *rest]])


def suffix_columns(df: DataFrame, suffix: str, keep: Sequence[str] = ()) -> DataFrame:
    """Every column but the kept ones gets the suffix."""
    return df.toDF(*[name if name in keep else name + suffix for name in df.columns])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns in its order and types; absent ones become typed nulls."""
    present = dict(df.dtypes)
    made = []
    for field in schema.fields:
        kind = field.dataType.simpleString()
        if present.get(field.name) == kind:
            made.append(f"`{field.name}`")
        else:
            value = f"`{field.name}`" if field.name in present else "NULL"
            made.append(f"CAST({value} AS {kind}) AS `{field.name}`")
    return df.selectExpr(*made)
