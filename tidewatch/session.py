"""Spark session and shared-folder helpers.

Everything that needs durable scratch space (checkpoints, round-trip files,
stream checkpoints) goes below the folder the cluster names in
``spark.checkpoint.dir``. Only when that setting is absent (local tests) do we
create one of our own under /tmp; on any other master its absence is an error.
"""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings that matter for the plans in this package. AQE re-plans joins and
# coalesces small shuffles at run time; skew-join splitting is what protects
# the sort-merge joins against one hot key.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# The JVM compiles no method above 8,000 bytes of bytecode: a feature projection that
# Spark fuses into one such method is interpreted, several times slower. At this limit
# Spark evaluates it by many small methods instead.
HUGE_METHOD = "spark.sql.codegen.hugeMethodLimit"
JVM_METHOD_BYTES = 8000
SPLIT_BYTES = "spark.sql.files.maxPartitionBytes"


def get_session(master: str | None = None, app: str = "tidewatch",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a local one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = spark.conf.get("spark.checkpoint.dir", None) or \
        sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    sc.setCheckpointDir(configured)
    return (sc.getCheckpointDir() or configured).rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return f"{base}/tidewatch/{name}-{uuid.uuid4().hex[:12]}"


class Scope:
    """What ``scratch_scope`` yields: ``save`` writes a table that outlives it."""

    def __init__(self, spark: SparkSession, outer: "Scope | None"):
        self.spark, self.outer, self.paths = spark, outer, []

    def save(self, df: DataFrame, name: str = "table") -> DataFrame:
        path = _written(df, name)
        if self.outer is not None:
            self.outer.paths.append(path)
        return self.spark.read.parquet(path)


class _Scopes(threading.local):
    def __init__(self):
        self.open: list[Scope] = []


_scopes = _Scopes()


@contextmanager
def scratch_scope(spark: SparkSession):
    """Tables that ``cut_lineage`` writes inside are removed at the end: nothing
    that is still to be read may come out but what ``scope.save`` wrote (it
    belongs to the scope around, if there is one). Only folders written here
    are removed."""
    scope = Scope(spark, _scopes.open[-1] if _scopes.open else None)
    _scopes.open.append(scope)
    try:
        yield scope
    finally:
        _scopes.open.remove(scope)
        for path in scope.paths:
            remove_folder(spark, path)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder through Spark's file system (any store)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _written(df: DataFrame, name: str, file_rows: int = 0) -> str:
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").option("maxRecordsPerFile", file_rows).parquet(path)
    return path


def cut_lineage(df: DataFrame, name: str = "table", file_rows: int = 0) -> DataFrame:
    """Write ``df`` as a parquet table in the shared checkpoint folder and read
    it back: lineage ends there (it survives executor loss — never
    localCheckpoint), and later passes get column pruning and filter pushdown
    on the saved table, which an RDD checkpoint would not give. ``file_rows``:
    most rows of a file (0: no limit)."""
    path = _written(df, name, file_rows)
    if _scopes.open:
        _scopes.open[-1].paths.append(path)
    return df.sparkSession.read.parquet(path)


def reads_saved(df: DataFrame) -> bool:
    """Whether ``df`` only projects and filters one table that ``cut_lineage`` wrote, by
    deterministic expressions: to read it twice costs less than to save it again."""
    plan = df._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() in ("Project", "Filter") and plan.deterministic():
        plan = plan.children().head()
    if plan.nodeName() != "LogicalRelation":
        return False
    ours = ensure_checkpoint_dir(df.sparkSession).split(":", 1)[-1].lstrip("/") + "/tidewatch/"
    files = df.inputFiles()
    return bool(files) and all(ours in f for f in files)


def small_methods(spark: SparkSession) -> None:
    """Wide projections of this session are evaluated by methods that the JVM compiles
    (``JVM_METHOD_BYTES``). Set for good: a plan made here may be run much later."""
    if int(spark.conf.get(HUGE_METHOD)) > JVM_METHOD_BYTES:
        spark.conf.set(HUGE_METHOD, str(JVM_METHOD_BYTES))


@contextmanager
def tasks_of_rows(df: DataFrame, rows: int):
    """Yields the number of rows of ``df``, a table saved in files of at most ``rows``
    rows; reads of it that are planned inside take a file a task, not as many small
    files as ``spark.sql.files.maxPartitionBytes`` allows."""
    spark, n = df.sparkSession, df.count()
    if n <= rows:
        yield n
        return
    before = spark.conf.get(SPLIT_BYTES)
    files = df.inputFiles()
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
    size = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(path).getLength()
    spark.conf.set(SPLIT_BYTES, str(max(1 << 20, size * rows // n)))
    try:
        yield n
    finally:
        spark.conf.set(SPLIT_BYTES, before)


def local_path(path: str) -> str:
    return path[len("file:"):] if path.startswith("file:") else path


def exists(path: str) -> bool:
    return os.path.exists(local_path(path))
