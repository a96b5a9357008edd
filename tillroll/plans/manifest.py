"""What a run has finished, so that a failed one can go on.

A run's manifest is a folder of small records, one per finished step, written
after the step's table: its schema and its observed metrics.  Runs are found
by the digest of everything that decides their tables: the inputs' files with
their sizes and times, the plans over them, the rules and the options.  Inputs
without files (rows made in memory) have no lasting identity; a run over these
never goes on with an earlier one.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def input_identity(df: DataFrame) -> list | None:
    """The files that ``df`` reads with their sizes and times, its schema and its plan; None without files.

    Their folders are listed once each, as planning a scan does.
    """
    files = sorted(df.inputFiles())
    if not files:
        return None
    spark, found = df.sparkSession, []
    for folder in sorted({f.rpartition("/")[0] for f in files}):
        _, path, fs = _hadoop(spark, folder)
        for s in fs.listStatus(path):
            found.append([s.getPath().toString(), s.getLen(), s.getModificationTime()])
    wanted = {f.rpartition("/")[2] for f in files}
    kept = sorted(x for x in found if x[0].rpartition("/")[2] in wanted)
    return [kept, df.schema.json(), df.semanticHash()]


def run_digest(bronze: dict[str, DataFrame], *options: object) -> str | None:
    """One digest of all inputs and options; None if an input has no identity."""
    inputs = {name: input_identity(df) for name, df in bronze.items()}
    if not inputs or any(x is None for x in inputs.values()):
        return None
    return hashlib.sha256(json.dumps([inputs, [repr(o) for o in options]], sort_keys=True).encode()).hexdigest()


def register_run(spark: SparkSession, root: str, run_id: str, digest: str | None) -> None:
    """Remember that ``run_id`` builds from these inputs and options."""
    if digest:
        record = json.dumps({"run": run_id, "at": dt.datetime.now(dt.timezone.utc).isoformat()})
        spark.createDataFrame([(record,)], "value string").coalesce(1).write.mode("append").text(f"{root}/_digests/{digest}")


def earlier_run(spark: SparkSession, root: str, digest: str | None) -> str | None:
    """The newest run of this digest whose folder is still there."""
    if not digest:
        return None
    path = f"{root}/_digests/{digest}"
    _, folder, fs = _hadoop(spark, path)
    if not fs.exists(folder):
        return None
    records = [json.loads(r["value"]) for r in spark.read.text(path).collect()]  # one per attempt
    for r in sorted(records, key=lambda r: r["at"], reverse=True):
        _, run, _ = _hadoop(spark, f"{root}/{r['run']}")
        if fs.exists(run):
            return r["run"]
    return None


class Manifest:
    """The finished steps of one run folder."""

    def __init__(self, spark: SparkSession, run_dir: str):
        self.spark, self.folder = spark, f"{run_dir}/_steps"
        _, path, fs = _hadoop(spark, self.folder)
        rows = spark.read.text(self.folder, recursiveFileLookup=True).collect() if fs.exists(path) else []
        self.records = {r["step"]: r for r in (json.loads(x["value"]) for x in rows)}  # one per step

    def done(self, step: str) -> tuple[T.StructType, dict] | None:
        """The schema and metrics of a finished step."""
        r = self.records.get(step)
        return r and (T.StructType.fromJson(r["schema"]), {k: dt.date.fromisoformat(v["date"]) if isinstance(v, dict) else v for k, v in r["metrics"].items()})

    def add(self, step: str, schema: T.StructType, metrics: dict) -> None:
        plain = {k: {"date": v.isoformat()} if isinstance(v, dt.date) else v for k, v in metrics.items()}
        record = json.dumps({"step": step, "schema": schema.jsonValue(), "metrics": plain})
        self.spark.createDataFrame([(record,)], "value string").coalesce(1).write.mode("overwrite").text(f"{self.folder}/{step}-{uuid.uuid4().hex[:8]}")
