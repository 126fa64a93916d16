"""Restartable file ingest with schema evolution and rescued data.

A binary-file stream discovers the files (only their paths, no content is read), its
checkpoint remembers them, and every micro-batch lands in its own folder

    <table>/flow=<flow>/batch_id=<n>/

A finished folder is never written again and an unfinished one is replaced, so a
replayed batch changes nothing. Several flows may append to one table.
"""

from __future__ import annotations

import datetime
import functools
import json
import re
from collections.abc import Collection, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tierflow.operators.projection import lead_with
from tierflow.operators.sets import union_all_by_name
from tierflow.sources import storage
from tierflow.sources.files import merged_schema
from tierflow.sources.footers import grouped_by_schema

RESCUED = "_rescued_data"
INGESTED = "FechaIngestaDatos"
#: Files of any age are taken; Spark's own default refuses those 7 days older than the newest.
ANY_AGE = "36500d"
DISCOVERY_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"
_ADDED = T.StructType([T.StructField(RESCUED, T.StringType()), T.StructField(INGESTED, T.TimestampType())])


def literal_path(path: str) -> str:
    """The path with its glob characters escaped."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def file_groups(spark: SparkSession, paths: Sequence[str]) -> list[tuple[list[str], T.StructType]]:
    """Split the files into groups that one scan each can read; the paths come back escaped.

    One job reads all footers. Files in a store that only Spark's readers open are split
    by merging footers there.
    """
    groups, unread = grouped_by_schema(spark, paths)
    made = [([literal_path(p) for p in held], schema) for held, schema in groups]
    return made + _merged_groups(spark, [literal_path(p) for p in unread])


def _merged_groups(spark: SparkSession, paths: list[str]) -> list[tuple[list[str], T.StructType]]:
    """Groups of files whose footers Spark can merge; files that conflict are halved."""
    if not paths:
        return []
    try:
        return [(paths, merged_schema(spark, *paths))]
    except (PySparkException, Py4JJavaError) as problem:
        if "CANNOT_MERGE_SCHEMAS" not in str(problem) or len(paths) == 1:
            raise
    middle = len(paths) // 2
    return _merged_groups(spark, paths[:middle]) + _merged_groups(spark, paths[middle:])


def widen(tracked: T.StructType, found: T.StructType) -> T.StructType:
    """Tracked columns, then the columns seen for the first time."""
    known = {f.name for f in tracked.fields}
    new = [T.StructField(f.name, f.dataType, True) for f in found.fields if f.name not in known]
    return T.StructType([*tracked.fields, *new])


def fit_to_schema(df: DataFrame, tracked: T.StructType, file_path: bool = False) -> DataFrame:
    """Rows in the tracked columns plus a JSON column of everything that does not fit.

    A value fits when its cast keeps it: text must parse, other types must survive
    the way back. Misfits become null in their column and, like columns that are not
    tracked, are kept in `_rescued_data`.
    """
    actual = {f.name: f.dataType for f in df.schema.fields}
    kept, rescued = [], []
    for field in tracked.fields:
        c = F.col(f"`{field.name}`")
        if field.name not in actual:
            kept.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        if actual[field.name] == field.dataType:
            kept.append(c)
            continue
        fitted = _try_fit(df, field)
        if isinstance(actual[field.name], T.StringType):
            fits = fitted.isNotNull()
        else:
            fits = fitted.try_cast(actual[field.name]).eqNullSafe(c)
        fits = F.coalesce(fits, F.lit(False))
        kept.append(F.when(fits, fitted).alias(field.name))
        rescued.append(F.when(~fits, c).alias(field.name))
    tracked_names = set(tracked.names)
    rescued += [F.col(f"`{name}`") for name in actual if name not in tracked_names]
    if rescued:
        any_rescued = functools.reduce(lambda a, b: a | b, [r.isNotNull() for r in rescued])
        where = [F.col("_metadata.file_path").alias("_file_path")] if file_path else []
        blob = F.when(any_rescued, F.to_json(F.struct(*rescued, *where)))
    else:
        blob = F.lit(None).cast("string")
    return df.select(*kept, blob.alias(RESCUED))


def _try_fit(df: DataFrame, field: T.StructField):
    fitted = F.col(f"`{field.name}`").try_cast(field.dataType)
    try:
        df.select(fitted)
    except AnalysisException:
        return F.lit(None).cast(field.dataType)
    return fitted


def _schema_root(table: str, flow: str) -> str:
    return f"{table}/_schemas/flow={flow}"


def stored_schema(
    spark: SparkSession, table: str, flow: str, before: int | None = None
) -> T.StructType | None:
    """Newest tracked schema of a flow, or of the batches before the given one."""
    root = _schema_root(table, flow)
    newest = storage.newest_complete(spark, root, "batch_id", before)
    if newest is None:
        return None
    text = spark.read.text(f"{root}/batch_id={newest}", wholetext=True).first().value
    return T.StructType.fromJson(json.loads(text))


def start_ingest(
    spark: SparkSession,
    source: str,
    table: str,
    checkpoint: str,
    lead: Sequence[str] = (INGESTED,),
    flow: str = "main",
    evolve: bool = True,
    max_files: int = 1000,
    ingested_at: datetime.datetime | None = None,
    max_file_age: str = ANY_AGE,
    name_filter: str | None = None,
) -> StreamingQuery:
    """Start appending all files that arrived since the last run.

    The query ends by itself once they are landed. A micro-batch takes at most
    `max_files` files, which bounds the path list that passes through the driver. With
    `evolve=False` unknown columns are rescued instead of added.

    Every file that is new to the checkpoint is taken, whatever its date or name, unless
    `max_file_age` or the glob `name_filter` says otherwise; the checkpoint remembers file
    names for that long. A file that is not parquet fails the batch. Names that begin with
    an underscore or a dot are skipped, as everywhere in Spark.
    """
    flow_root = f"{table}/flow={flow}"
    fresh = not storage.exists(spark, f"{checkpoint}/metadata")
    if fresh and storage.exists(spark, flow_root):
        raise ValueError(f"flow {flow!r} has data but a new checkpoint; use another flow name")

    def land(found: DataFrame, batch_id: int) -> None:
        session = found.sparkSession
        target = f"{flow_root}/batch_id={batch_id}"
        if storage.is_complete(session, target):
            return
        paths = sorted(row.path for row in found.select("path").collect())
        if not paths:
            return
        groups = file_groups(session, paths)
        before = stored_schema(session, table, flow, before=batch_id)
        tracked = before or T.StructType([])
        if evolve or before is None:
            for _, schema in groups:
                tracked = widen(tracked, schema)
        if tracked != before:
            line = session.createDataFrame([(tracked.json(),)], "value string").coalesce(1)
            line.write.mode("overwrite").text(f"{_schema_root(table, flow)}/batch_id={batch_id}")
        parts = [
            fit_to_schema(session.read.schema(schema).parquet(*files), tracked, file_path=True)
            for files, schema in groups
        ]
        stamp = F.current_timestamp() if ingested_at is None else F.lit(ingested_at)
        rows = union_all_by_name(parts).withColumn(INGESTED, stamp)
        lead_with(rows, lead).write.mode("overwrite").parquet(target)

    reader = (
        spark.readStream.format("binaryFile")
        .schema(DISCOVERY_SCHEMA)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", max_files)
        .option("maxFileAge", max_file_age)
    )
    if name_filter is not None:
        reader = reader.option("pathGlobFilter", name_filter)
    return (
        reader.load(source)
        .select("path")
        .writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def ingest_files(
    spark: SparkSession, source: str, table: str, checkpoint: str, **options
) -> None:
    """`start_ingest`, then wait until everything is landed."""
    start_ingest(spark, source, table, checkpoint, **options).awaitTermination()


def committed_batches(spark: SparkSession, table: str, flow: str = "main") -> list[int]:
    """Numbers of the batches that a flow has landed in full."""
    return storage.committed(spark, f"{table}/flow={flow}", "batch_id")


def read_ingested(
    spark: SparkSession,
    table: str,
    flows: Sequence[str] = ("main",),
    lead: Sequence[str] = (INGESTED,),
    batches: Collection[int] | None = None,
) -> DataFrame:
    """The committed history; columns that a batch did not have yet are null in its rows.

    Batches without a commit mark are not read. Each flow is read with its own types; the
    first flow that has a column gives its type, and values of other flows that do not fit
    it are rescued. With `batches` only those are read.
    """
    known = {flow: stored_schema(spark, table, flow) for flow in flows}
    schema = T.StructType([])
    for own in known.values():
        schema = widen(schema, own) if own is not None else schema
    full = T.StructType([*schema.fields, *_ADDED.fields])
    parts = []
    for flow, own in known.items():
        root = f"{table}/flow={flow}"
        landed = committed_batches(spark, table, flow)
        paths = [f"{root}/batch_id={n}" for n in landed if batches is None or n in batches]
        if not paths or own is None:
            continue
        types = {f.name: f.dataType for f in own.fields}
        agree = all(types.get(f.name, f.dataType) == f.dataType for f in schema.fields)
        layout = full if agree else T.StructType([*own.fields, *_ADDED.fields])
        rows = spark.read.schema(layout).parquet(*paths)
        parts.append(rows if agree else _refit(rows, schema))
    rows = union_all_by_name(parts) if parts else spark.createDataFrame([], full)
    return lead_with(rows, [c for c in lead if c in full.names])


def _refit(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows of one flow in the types of another; new misfits join what was rescued before."""
    earlier = T.StructField("_rescued_before", T.StringType())
    wanted = T.StructType([*schema.fields, earlier, _ADDED[INGESTED]])
    fitted = fit_to_schema(rows.withColumnRenamed(RESCUED, earlier.name), wanted)
    before, now = F.col(earlier.name), F.col(RESCUED)
    both = F.when(before.isNotNull() & now.isNotNull(), F.concat(F.lit("["), before, F.lit(","), now, F.lit("]")))
    return fitted.withColumn(RESCUED, F.coalesce(both, now, before)).drop(earlier.name)
