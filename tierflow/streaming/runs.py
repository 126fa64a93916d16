"""A keyed table kept as a few runs of rows, for streams that change rows.

Every micro-batch writes one small run. As soon as `fanout` runs of a level stand next to each other
they are merged into one of the next level, so the number of live runs grows with the logarithm of
the number of batches. Which runs are live is said by a state file per batch, written last:
a reader lists one folder and reads one small file, however many batches there were, and a
batch that is run again replaces what it had written without a state file.

    <root>/runs/batch=<n>/        the rows of a batch
    <root>/runs/merged=<n>-<l>/   a merge made while batch n was applied
    <root>/state/<n>.json         the live runs after batch n
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tierflow.operators.sets import union_all_by_name
from tierflow.sources import storage

#: State files that stay for readers that have just listed them.
KEPT_STATES = 8
Merge = Callable[[DataFrame], DataFrame]


@dataclass
class RunLog:
    """The runs under `root`. `merge` brings the rows of several runs down to those of one.

    `layout` are columns by which the files of a run are parted, to read only some of them.
    """

    spark: SparkSession
    root: str
    merge: Merge
    fanout: int = 8
    layout: Sequence[str] = ()

    def _state(self) -> dict:
        files = storage.names(self.spark, f"{self.root}/state")
        done = [int(f.removesuffix(".json")) for f in files if f.endswith(".json")]
        if not done:
            return {"through": None, "runs": []}
        return json.loads(storage.read_text(self.spark, f"{self.root}/state/{max(done)}.json"))

    def through(self) -> int | None:
        """The last batch that has been applied."""
        return self._state()["through"]

    def live(self) -> list[dict]:
        """Path, level and last batch of every live run, oldest first."""
        return self._state()["runs"]

    def rows(self) -> DataFrame | None:
        """All rows of the live runs, unmerged; None before the first batch."""
        return self._read(self.live())

    def _read(self, runs: Sequence[dict]) -> DataFrame | None:
        if not runs:
            return None
        # Runs may differ in the columns they have: a read each, a union by name.
        shapes: dict[str, list[str]] = {}
        for run in runs:
            shapes.setdefault(json.dumps(run["schema"]), []).append(f"{self.root}/{run['path']}")
        parts = []
        for schema, paths in shapes.items():
            reader = self.spark.read.schema(T.StructType.fromJson(json.loads(schema)))
            if self.layout:
                each = [reader.parquet(p) for p in paths]
                parts.append(union_all_by_name(each))
            else:
                parts.append(reader.parquet(*paths))
        return union_all_by_name(parts, fill_missing=True)

    def _write(self, rows: DataFrame, path: str) -> dict:
        if self.layout:
            dealt = rows.hint("rebalance", *self.layout)
            dealt.write.mode("overwrite").partitionBy(*self.layout).parquet(f"{self.root}/{path}")
        else:
            rows.write.mode("overwrite").parquet(f"{self.root}/{path}")
        return rows.schema.jsonValue()

    def apply(self, batch_id: int, rows: DataFrame) -> bool:
        """Add the rows of a batch; False if this batch has been applied before."""
        state = self._state()
        if state["through"] is not None and batch_id <= state["through"]:
            return False
        path = f"runs/batch={batch_id}"
        schema = self._write(rows, path)
        runs = [*state["runs"], {"path": path, "level": 0, "through": batch_id, "schema": schema}]
        level = 0
        while len([r for r in runs if r["level"] == level]) >= self.fanout:
            runs = self._merged(runs, batch_id, level + 1)
            level += 1
        self._commit(batch_id, runs)
        return True

    def _merged(self, runs: list[dict], batch_id: int, level: int) -> list[dict]:
        """All runs below the level as one run of that level."""
        small = [r for r in runs if r["level"] < level]
        path = f"runs/merged={batch_id}-{level}"
        schema = self._write(self.merge(self._read(small)), path)
        return [
            *[r for r in runs if r["level"] >= level],
            {"path": path, "level": level, "through": small[-1]["through"], "schema": schema},
        ]

    def _commit(self, batch_id: int, runs: list[dict]) -> None:
        text = json.dumps({"through": batch_id, "runs": runs})
        storage.write_text(self.spark, f"{self.root}/state/{batch_id}.json", text)
        # Older states are found by number and dropped; their runs stay until `vacuum`.
        files = storage.names(self.spark, f"{self.root}/state")
        done = sorted(int(f.removesuffix(".json")) for f in files if f.endswith(".json"))
        for old in done[:-KEPT_STATES]:
            storage.delete(self.spark, f"{self.root}/state/{old}.json")

    def fold(self) -> None:
        """Merge all live runs into one."""
        state = self._state()
        if len(state["runs"]) > 1:
            level = 1 + max(r["level"] for r in state["runs"])
            name = f"{state['through']}"
            runs = self._merged(state["runs"], state["through"], level)
            storage.write_text(
                self.spark, f"{self.root}/state/{name}.json", json.dumps({"through": state["through"], "runs": runs})
            )

    def vacuum(self) -> list[str]:
        """Remove the runs that no kept state names; returns their paths.

        For times when nobody reads by a state older than the kept ones.
        """
        named = set()
        for file in storage.names(self.spark, f"{self.root}/state"):
            if file.endswith(".json"):
                state = json.loads(storage.read_text(self.spark, f"{self.root}/state/{file}"))
                named |= {r["path"] for r in state["runs"]}
        gone = [f"runs/{n}" for n in storage.names(self.spark, f"{self.root}/runs") if f"runs/{n}" not in named]
        for path in gone:
            storage.delete(self.spark, f"{self.root}/{path}")
        return gone
