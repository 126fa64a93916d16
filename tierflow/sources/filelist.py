"""A table as a list of files, so that small ones can be packed without touching the others.

    <root>/data/<write>/...    files, never overwritten
    <root>/state/<n>.json      the files that make up the table after change n

A change writes its files first and its state last. Readers take the newest state.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.sources import storage


def first_fit(sizes: Sequence[int], limit: int) -> list[list[int]]:
    """Places of `sizes` in bins of at most `limit`, the largest first; a larger one has its own bin.

    No two bins fit into one, so packing the bins again changes nothing.
    """
    bins: list[tuple[int, list[int]]] = []
    for at in sorted(range(len(sizes)), key=lambda k: (-sizes[k], k)):
        for k, (used, held) in enumerate(bins):
            if used + sizes[at] <= limit:
                bins[k] = (used + sizes[at], [*held, at])
                break
        else:
            bins.append((sizes[at], [at]))
    return [sorted(held) for _, held in bins]


class FileList:
    """One writer at a time; any number of readers."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def _newest(self) -> tuple[int, dict]:
        names = storage.names(self.spark, f"{self.root}/state")
        done = [int(n.removesuffix(".json")) for n in names if n.endswith(".json")]
        if not done:
            return -1, {"schema": None, "files": []}
        return max(done), json.loads(storage.read_text(self.spark, f"{self.root}/state/{max(done)}.json"))

    def files(self) -> list[dict]:
        """Path, name and size of every file; a packed file has the size of what was packed."""
        return self._newest()[1]["files"]

    def read(self) -> DataFrame:
        state = self._newest()[1]
        if state["schema"] is None:
            raise ValueError(f"nothing has been written to {self.root}")
        schema = T.StructType.fromJson(state["schema"])
        if not state["files"]:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{f['path']}" for f in state["files"]])

    def _written(self, folder: str) -> list[dict]:
        listed = storage.data_files(self.spark, f"{self.root}/{folder}")
        return [{"path": f"{folder}/{p}", "name": p.rpartition("/")[2], "bytes": size} for p, size in listed]

    def _commit(self, after: int, schema: T.StructType, files: list[dict]) -> None:
        text = json.dumps({"schema": schema.jsonValue(), "files": files})
        storage.write_text(self.spark, f"{self.root}/state/{after + 1}.json", text)

    def append(self, df: DataFrame) -> None:
        """Add the rows as new files; columns that the table does not have yet are added."""
        after, state = self._newest()
        folder = f"data/{uuid.uuid4().hex}"
        df.write.parquet(f"{self.root}/{folder}")
        known = state["schema"] and T.StructType.fromJson(state["schema"])
        fields = list(known.fields) if known else []
        types = {f.name: f.dataType for f in fields}
        for f in df.schema.fields:
            if types.get(f.name, f.dataType) != f.dataType:
                raise ValueError(f"column {f.name} is {types[f.name].simpleString()} in the table")
            if f.name not in types:
                fields.append(T.StructField(f.name, f.dataType, True))
        self._commit(after, T.StructType(fields), [*state["files"], *self._written(folder)])

    def compact(self, target_bytes: int = 256 << 20, order: Sequence[str] = ()) -> int:
        """Pack files under half the target into files of about the target; returns how many were rewritten.

        Each bin is one task and one file, sorted on `order`: its parts are sorted runs already if
        they were written so. Files that share a bin with no other stay as they are.
        """
        after, state = self._newest()
        small = [f for f in state["files"] if 2 * f["bytes"] < target_bytes]
        bins = [b for b in first_fit([f["bytes"] for f in small], target_bytes) if len(b) > 1]
        if not bins:
            return 0
        packed = {small[k]["name"]: n for n, held in enumerate(bins) for k in held}
        schema = T.StructType.fromJson(state["schema"])
        paths = [f"{self.root}/{f['path']}" for f in small if f["name"] in packed]
        rows = self.spark.read.schema(schema).parquet(*paths)
        # Two short columns per small file.
        table = self.spark.createDataFrame(list(packed.items()), "_name string, _bin int")
        rows = rows.withColumn("_name", F.col("_metadata.file_name")).join(F.broadcast(table), "_name").drop("_name")
        folder = f"data/{uuid.uuid4().hex}"
        dealt = rows.repartition(len(bins), "_bin").sortWithinPartitions("_bin", *order)
        dealt.write.partitionBy("_bin").parquet(f"{self.root}/{folder}")
        made = self._written(folder)
        sums = [sum(small[k]["bytes"] for k in held) for held in bins]
        for f in made:
            f["bytes"] = max(f["bytes"], sums[int(f["path"].split("_bin=")[1].split("/")[0])])
        kept = [f for f in state["files"] if f["name"] not in packed]
        self._commit(after, schema, [*kept, *made])
        return len(packed)

    def vacuum(self, keep_states: int = 8) -> int:
        """Remove older states and the files that no kept state names; returns the files removed.

        For times when nobody reads by a state older than the kept ones.
        """
        names = storage.names(self.spark, f"{self.root}/state")
        done = sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))
        held = set()
        for n in done[-keep_states:]:
            state = json.loads(storage.read_text(self.spark, f"{self.root}/state/{n}.json"))
            held |= {f["path"] for f in state["files"]}
        for n in done[:-keep_states]:
            storage.delete(self.spark, f"{self.root}/state/{n}.json")
        gone = [f["path"] for f in self._written("data") if f["path"] not in held]
        for path in gone:
            storage.delete(self.spark, f"{self.root}/{path}")
        return len(gone)
