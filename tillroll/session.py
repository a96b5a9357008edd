"""Session construction and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import threading
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

# Settings every job relies on.  Cluster-level values (executor sizing,
# shuffle partitions for the target scale) are left to the submitter.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(
    master: str | None = None,
    app_name: str = "tillroll",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with AQE, ANSI and UTC fixed."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    for key, value in settings.items():
        if not key.startswith("spark.driver") and not key.startswith("spark.executor"):
            try:
                spark.conf.set(key, value)
            except AnalysisException as e:  # static setting of an already running session
                if "CANNOT_MODIFY" not in str(e.getCondition()):
                    raise
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    The folder is ``spark.checkpoint.dir`` as configured -- the stable root,
    not the per-application sub folder Spark creates inside it, so that runs
    written by one application can be opened by the next.  Only when nothing
    is configured on a local master -- tests, small runs -- a private folder is
    created and registered; on a cluster that raises, as executors would each
    write to their own disk.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    private = tempfile.mkdtemp(prefix="tillroll-ckpt-")
    sc.setCheckpointDir(private)
    return private


FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_CLEANUP_LOCK = threading.Lock()
_CLEANUP_DEPTH: Counter[str] = Counter()
_CLEANUP_BEFORE: dict[str, str | None] = {}


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Within it, a query's shuffle files go when the query ends, and not when the driver next collects its garbage.

    For work of several steps, each of which is written and read back: its disk
    is that of the largest step, not the sum.  A DataFrame made here and run
    twice shuffles again.  Calls may be nested and overlap in threads; the
    session's own setting is put back after the last.
    """
    app = spark.sparkContext.applicationId
    with _CLEANUP_LOCK:
        if not _CLEANUP_DEPTH[app]:
            _CLEANUP_BEFORE[app] = spark.conf.get(FILE_CLEANUP, None)
            spark.conf.set(FILE_CLEANUP, "true")
        _CLEANUP_DEPTH[app] += 1
    try:
        yield
    finally:
        with _CLEANUP_LOCK:
            _CLEANUP_DEPTH[app] -= 1
            if not _CLEANUP_DEPTH[app]:
                before = _CLEANUP_BEFORE.pop(app)
                spark.conf.unset(FILE_CLEANUP) if before is None else spark.conf.set(FILE_CLEANUP, before)


def scale_conf(input_bytes: int, total_cores: int, partition_bytes: int = 256 * 1024 ** 2) -> dict[str, str]:
    """Settings sized for a run over ``input_bytes`` on ``total_cores`` cores.

    * scan splits and shuffle partitions of about ``partition_bytes`` each,
      so a task's share fits executor memory and spills stay small;
    * at least two waves of tasks per core, so stragglers even out;
    * AQE coalesces small shuffle partitions back to the advisory size and
      splits partitions more than five times the median (hot keys).
    """
    partitions = max(2 * total_cores, -(-input_bytes // partition_bytes))
    size = f"{partition_bytes // (1024 ** 2)}m"
    return {
        "spark.sql.files.maxPartitionBytes": size,
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": size,
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": size,
    }
