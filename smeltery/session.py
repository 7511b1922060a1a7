"""Session settings the layers rely on, and where intermediate tables may be written."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Runtime SQL settings. They change results (time zone) or layout (dynamic overwrite), so every
# entry point applies them to the session it is handed.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


# Removes what a write has shuffled when it ends, instead of when the driver next collects its garbage.
_FREEING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_inside, _before, _guard = 0, "false", threading.Lock()


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Inside, shuffle files are removed as soon as the write or collect that made them has ended.

    Without, they stay on disk until the driver happens to collect its garbage, so that a run of several writes
    holds the shuffles of all. Calls may nest and overlap; the setting ends with the last.
    """
    global _inside, _before
    with _guard:
        if not _inside:
            _before = spark.conf.get(_FREEING, "false") or "false"
            spark.conf.set(_FREEING, "true")
        _inside += 1
    try:
        yield
    finally:
        with _guard:
            _inside -= 1
            if not _inside:
                spark.conf.set(_FREEING, _before)


def build_session(app: str = "smeltery", cpus: int | None = None) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster pass your own session instead."""
    cpus = cpus or os.cpu_count() or 1
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder the cluster names in ``spark.checkpoint.dir``.

    A folder set with ``setCheckpointDir`` counts as well. Only a local master may fall back to a
    temporary folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = getattr(spark.sparkContext, "getCheckpointDir", lambda: None)()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="smeltery-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
