"""JDBC tables and key-value configuration."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def jdbc_options(
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    split_on: str | None = None,
    low: object = None,
    high: object = None,
    splits: int | None = None,
    fetch_rows: int = 10_000,
) -> dict[str, str]:
    """Options of a JDBC scan; with `split_on` the table is read in parallel ranges."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_rows), **(properties or {})}
    if split_on is not None:
        if low is None or high is None or not splits:
            raise ValueError("a split scan needs low, high and splits")
        options |= {
            "partitionColumn": split_on,
            "lowerBound": str(low),
            "upperBound": str(high),
            "numPartitions": str(splits),
        }
    return options


def scan_jdbc(spark: SparkSession, url: str, table: str, **kwargs) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **kwargs)).load()


def config_row(
    config: DataFrame, keys: Sequence[str], key: str = "Clave", value: str = "Valor"
) -> DataFrame:
    """The wanted configuration values as the columns of one row."""
    return config.agg(*[F.max(F.when(F.col(key) == k, F.col(value))).alias(k) for k in keys])


def config_values(
    config: DataFrame, keys: Sequence[str], key: str = "Clave", value: str = "Valor"
) -> dict[str, str]:
    """The same as a dict; a missing key raises."""
    found = config_row(config, keys, key, value).first().asDict()
    missing = [k for k, v in found.items() if v is None]
    if missing:
        raise ValueError(f"configuration keys without a value: {', '.join(missing)}")
    return found
