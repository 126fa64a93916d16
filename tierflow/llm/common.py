"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.session import scratch

#: The white space of the contracts: space and the control characters 0x09 to 0x0D.
SPACES = " \t\n\x0b\x0c\r"


def stored(df: DataFrame, name: str, **options) -> DataFrame:
    """Write to a fresh table in the shared folder and read it back.

    Cuts the lineage so that lost executors cost a reread, and fixes values that depend
    on the partitioning. Tables are never overwritten.
    """
    path = scratch(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def free_name(taken: Iterable[str], wanted: str) -> str:
    """`wanted`, with underscores in front until no column has that name."""
    names = {t.lower() for t in taken}
    while wanted.lower() in names:
        wanted = f"_{wanted}"
    return wanted


def row_digest(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """64-bit digest of a row; equal rows have equal digests. Maps are digested as JSON."""
    kinds = dict(df.dtypes)
    cols = []
    for name in columns or df.columns:
        quoted = F.col(f"`{name}`")
        cols.append(F.to_json(quoted) if "map<" in kinds[name] else quoted)
    return F.xxhash64(*cols)
