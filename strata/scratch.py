"""Intermediate tables of one operator run under ``spark.checkpoint.dir``."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import types as T

from strata.session import checkpoint_dir


class Scratch:
    """Tables that cut the lineage of a run of several steps.

    ``save`` writes a step's result and reads it back, so a lost executor
    costs the running step only, and the plan of the next step starts from a
    table of known size. The step's shuffle files go as soon as its table is
    written. ``drop`` removes tables that no later step reads, ``keep`` all
    but those that one does, and ``close`` removes all of them (for callers that know the result has been written).
    """

    CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.dir = f"{checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
        self.metrics: dict[str, dict] = {}   # by the name of an observation that a saved table was given

    def path(self, name: str) -> str:
        return f"{self.dir}/{name}"

    def save(self, df: DataFrame, name: str, seen: Sequence[Observation] = ()) -> DataFrame:
        """The table of ``df``; ``seen`` are observations of its plan, whose
        values go to ``metrics``."""
        before = self.spark.conf.get(self.CLEAN, "false")
        self.spark.conf.set(self.CLEAN, "true")
        try:
            df.write.option("compression", "zstd").parquet(self.path(name))
        finally:
            self.spark.conf.set(self.CLEAN, before)
        self.metrics.update({o._name: dict(o.get) for o in seen})
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def _delete(self, path: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def drop(self, *names: str) -> None:
        for name in names:
            self._delete(self.path(name))

    def keep(self, *names: str) -> None:
        """Remove every table but these."""
        root = self.spark._jvm.org.apache.hadoop.fs.Path(self.dir)
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        for status in fs.listStatus(root) if fs.exists(root) else []:
            if status.getPath().getName() not in names:
                fs.delete(status.getPath(), True)

    def once(self, name: str, step: Callable[[], dict]) -> dict:
        """The result of ``step``, a small dict."""
        return step()

    def close(self) -> None:
        self._delete(self.dir)


class Ledger(Scratch):
    """``Scratch`` under a run id, whose finished steps outlive a failed run.

    A step is finished when its entry lies beside its table; the entry is written
    after the table and renamed into place. A run that starts again under its id
    reads the tables of finished steps and does the others anew. It must be the
    same run: other ``params`` are refused. Inputs are taken to be unchanged. ``close``
    ends the run and forgets it.
    """

    def __init__(self, spark: SparkSession, label: str, run_id: str, params: dict):
        super().__init__(spark, label)
        self.dir = f"{checkpoint_dir(spark).rstrip('/')}/{label}-run-{run_id}"
        params = json.loads(json.dumps(params))
        known = self._read("run")
        if known is None:
            self._write("run", params)
        elif known != params:
            raise ValueError(f"run {run_id} was begun with other parameters: {json.dumps(known)}")

    def _fs(self, path: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _read(self, name: str) -> dict | None:
        fs, path = self._fs(f"{self.dir}/{name}.json")
        if not fs.exists(path):
            return None
        return json.loads("".join(r[0] for r in self.spark.read.text(path.toString(), wholetext=True).collect()))   # one short entry

    def _write(self, name: str, entry: dict) -> None:
        fs, beside = self._fs(f"{self.dir}/_{name}-{uuid.uuid4().hex}")
        out = fs.create(beside)
        out.write(bytearray(json.dumps(entry).encode()))
        out.close()
        _, path = self._fs(f"{self.dir}/{name}.json")
        if not fs.rename(beside, path):
            raise OSError(f"{path} can't be written")

    def save(self, df: DataFrame, name: str, seen: Sequence[Observation] = ()) -> DataFrame:
        entry, (fs, table) = self._read(name), self._fs(self.path(name))
        if entry is None or not fs.exists(table):
            self._delete(self.path(name))          # what a failed run has left of it
            self._delete(f"{self.dir}/{name}.json")
            out = super().save(df, name, seen)
            self._write(name, {"schema": df.schema.jsonValue(), "metrics": {o._name: dict(o.get) for o in seen}})
            return out
        self.metrics.update(entry["metrics"])
        return self.spark.read.schema(T.StructType.fromJson(entry["schema"])).parquet(self.path(name))

    def once(self, name: str, step: Callable[[], dict]) -> dict:
        entry = self._read(name)
        if entry is None:
            entry = step()
            self._write(name, entry)
        return entry


def run_scratch(spark: SparkSession, label: str, run_id: str | None, params: dict) -> Scratch:
    """The ledger of ``run_id``, or plain scratch tables without one."""
    return Ledger(spark, label, run_id, params) if run_id else Scratch(spark, label)
