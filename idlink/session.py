"""Session settings and the shared working folder."""

from __future__ import annotations

import contextlib
import os
import tempfile
import threading
import uuid
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import SparkSession

# Adaptive execution picks the join strategy, merges small shuffle partitions and splits
# skewed ones from run-time sizes, so no operator in this package hard-codes any of these.
# The forced form may add a shuffle after a join whose partitions it splits; without
# it a skewed join stays whole whenever a later step would have reused its partitioning.
# The JVM never compiles methods of more than 8000 bytes; wide conforming projections
# run faster split up than as one generated method of that size.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session made elsewhere; all of them can change at run time."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def get_spark(app: str = "idlink", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the package's settings. `extra` overrides them, dots written as `__`."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in extra.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_lock = threading.Lock()
_within: Counter[str] = Counter()  # session -> blocks of `shuffles_dropped` being run, as stages are also written by several threads


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the actions within go as soon as each of them is over.

    Otherwise they stay until the driver happens to collect its garbage, so a query that writes several stages holds the
    shuffles of all of them at once. Only for frames that no later action takes up again: it would shuffle anew.
    """
    session = spark._jsparkSession.sessionUUID()
    with _lock:
        _within[session] += 1
        if _within[session] == 1:
            spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        with _lock:
            _within[session] -= 1
            if not _within[session]:
                spark.conf.unset(_CLEANUP)


_local_dirs: dict[str, str] = {}  # application -> fallback folder of a local session


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by `spark.checkpoint.dir`.

    Only a local session may fall back to a temporary folder: on a cluster a
    machine-local path would be lost with its executor.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="idlink-")
    return _local_dirs[app]


def path_exists(spark: SparkSession, *parts: str) -> bool:
    """Whether a file or folder exists, in any file system that Spark reaches."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/".join(parts))
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path in the shared folder."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")
