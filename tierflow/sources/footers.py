"""Schemas of many parquet files, read from their footers in one job."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_schema

#: Footer key under which Spark keeps the schema it has written.
SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"
#: Files whose footers one task reads, at least.
FILES_PER_TASK = 32


def file_schema(path: str) -> T.StructType:
    """The schema in one footer, with every column nullable as Spark reads it."""
    if path.startswith("file:"):
        files, place = pyarrow.fs.LocalFileSystem(), re.sub("^file:/*", "/", path)
    elif "://" in path:
        files, place = pyarrow.fs.FileSystem.from_uri(re.sub("^s3a:", "s3:", path))
    else:
        files, place = pyarrow.fs.LocalFileSystem(), path
    with files.open_input_file(place) as source:
        found = pq.read_schema(source)
    own = (found.metadata or {}).get(SPARK_SCHEMA)
    schema = T.StructType.fromJson(json.loads(own)) if own else from_arrow_schema(found)
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


def _footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        schemas, problems = [], []
        for path in batch.column("path").to_pylist():
            try:
                schemas.append(file_schema(path).json())
                problems.append(None)
            except Exception as problem:  # reported per file: the caller decides
                schemas.append(None)
                problems.append(f"{type(problem).__name__}: {problem}")
        yield pa.RecordBatch.from_arrays(
            [batch.column("path"), pa.array(schemas, pa.string()), pa.array(problems, pa.string())],
            names=["path", "schema", "problem"],
        )


def footer_schemas(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """path, schema (JSON; null where the footer cannot be read this way) and problem, read in the executors."""
    listed = spark.createDataFrame([(p,) for p in paths], "path string")
    tasks = max(1, min(len(paths) // FILES_PER_TASK, 10_000))
    return listed.repartition(tasks).mapInArrow(_footers, "path string, schema string, problem string")


def agree(left: T.StructType, right: T.StructType) -> bool:
    """No column has a type in one and another type in the other."""
    types = {f.name: f.dataType for f in left.fields}
    return all(types.get(f.name, f.dataType) == f.dataType for f in right.fields)


def grouped_by_schema(
    spark: SparkSession, paths: Sequence[str]
) -> tuple[list[tuple[list[str], T.StructType]], list[str]]:
    """Paths by schemas that can be read in one scan, and the paths whose footers are not readable here.

    One job reads the footers; equal schemas come back as one row. Schemas that only
    differ in the columns they have are joined.
    """
    found = footer_schemas(spark, paths).groupBy("schema").agg(F.sort_array(F.collect_list("path")).alias("paths"))
    groups: list[tuple[list[str], T.StructType]] = []
    unread: list[str] = []
    for row in sorted(found.collect(), key=lambda r: r["paths"][0]):
        if row["schema"] is None:
            unread += row["paths"]
            continue
        schema = T.StructType.fromJson(json.loads(row["schema"]))
        for k, (held, known) in enumerate(groups):
            if agree(known, schema):
                new = [f for f in schema.fields if f.name not in known.names]
                groups[k] = ([*held, *row["paths"]], T.StructType([*known.fields, *new]))
                break
        else:
            groups.append((list(row["paths"]), schema))
    return groups, unread
