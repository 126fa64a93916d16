"""Parquet scans."""

from __future__ import annotations

import calendar
import datetime
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tierflow.operators.projection import BOOKKEEPING, select_except
from tierflow.sources import storage


def scan(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def scan_table(spark: SparkSession, *name_parts: str) -> DataFrame:
    """Catalog table by its one- to three-part name."""
    return spark.read.table(".".join(f"`{p}`" for p in name_parts))


def merged_schema(spark: SparkSession, *paths: str) -> T.StructType:
    """Union of the columns in all file footers."""
    return spark.read.option("mergeSchema", "true").parquet(*paths).schema


def scan_dated(
    spark: SparkSession,
    root: str,
    recursive: bool = False,
    discard: Sequence[str] = BOOKKEEPING,
    name_filter: str | None = None,
) -> DataFrame:
    """All files (or those whose name fits the glob) under year / month / day folders, without the folder columns.

    `recursive` reads any folder naming; otherwise key=value folders are discovered as
    partition columns (so filters on them prune folders) and then discarded.
    """
    reader = spark.read
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if name_filter is not None:
        reader = reader.option("pathGlobFilter", name_filter)
    return select_except(reader.parquet(root), discard)


def _number(name: str) -> int | None:
    """The number of a folder named `08` or `mes=8`."""
    tail = name.rpartition("=")[2]
    return int(tail) if tail.isdigit() else None


def dated_folders(
    spark: SparkSession, root: str, first: datetime.date, last: datetime.date
) -> list[str]:
    """Folders under root / year / month / day that hold the days from `first` to `last`.

    Only folders that reach into the range are listed: a year or month that lies in it whole
    is taken whole, the others are opened.
    """
    found = []
    for year, path in _numbered_folders(spark, root):
        if not first.year <= year <= last.year:
            continue
        if first <= datetime.date(year, 1, 1) and datetime.date(year, 12, 31) <= last:
            found.append(path)
            continue
        for month, below in _numbered_folders(spark, path):
            if not 1 <= month <= 12:
                continue
            length = calendar.monthrange(year, month)[1]
            start, end = datetime.date(year, month, 1), datetime.date(year, month, length)
            if end < first or start > last:
                continue
            if first <= start and end <= last:
                found.append(below)
                continue
            days = _numbered_folders(spark, below)
            found += [p for d, p in days if 1 <= d <= length and first <= datetime.date(year, month, d) <= last]
    return found


def _numbered_folders(spark: SparkSession, folder: str) -> list[tuple[int, str]]:
    names = [(_number(n), f"{folder.rstrip('/')}/{n}") for n in storage.names(spark, folder)]
    return sorted((n, path) for n, path in names if n is not None)


def scan_days(
    spark: SparkSession,
    root: str,
    first: datetime.date,
    last: datetime.date,
    schema: T.StructType | None = None,
) -> DataFrame:
    """The files of the folders of some days, whatever the levels are called (`2001/08/01` or
    `anio=2001/mes=8/dia=1`). Without any folder in the range a schema gives an empty table."""
    folders = dated_folders(spark, root, first, last)
    if not folders:
        if schema is None:
            raise ValueError(f"no folder from {first} to {last} under {root}")
        return spark.createDataFrame([], schema)
    reader = spark.read.option("recursiveFileLookup", "true")
    reader = reader if schema is None else reader.schema(schema)
    return reader.parquet(*folders)
