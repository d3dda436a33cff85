"""Session helpers: a local session for tests/bench and a shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "emberstat") -> SparkSession:
    """Session used by tests and ``bench.py``; a cluster job builds its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("EMBERSTAT_DRIVER_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        # checkpoint files of frames that are no longer referenced are deleted
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", os.environ.get("EMBERSTAT_CLEAN_CHECKPOINTS", "true"))
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    The folder named by ``spark.checkpoint.dir`` is used as is. A session
    without one gets a fresh temporary folder if its master is local (tests);
    on a cluster that would be one machine's disk, so it is an error there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.split("[")[0] == "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="emberstat-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


#: Scratch folder of each running application.
_SCRATCH: dict[str, str] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder name below the application's scratch folder, which lies in the shared checkpoint
    folder and is deleted when the driver ends."""
    app = spark.sparkContext.applicationId
    if app not in _SCRATCH:
        base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/scratch-{app}-{uuid.uuid4().hex[:12]}"
        path = spark._jvm.org.apache.hadoop.fs.Path(base)
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        fs.mkdirs(path)
        fs.deleteOnExit(path)
        _SCRATCH[app] = base
    path = f"{_SCRATCH[app]}/{name}-{uuid.uuid4().hex[:12]}"
    if _OPEN:
        _OPEN[-1].append(path)
    return path


#: Folders handed out inside each open ``scratch`` block.
_OPEN: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Folders that operators take inside the block are deleted at its end, not only when the driver ends. What is to
    stay must be written inside the block: ``with scratch(spark): deduplicate(docs).write.parquet(out)``."""
    _OPEN.append([])
    try:
        yield
    finally:
        for path in _OPEN.pop():
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
