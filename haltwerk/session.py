"""Session defaults and the shared working folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor, wait
from functools import cache

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession


def local_session(app: str = "haltwerk", cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benches; on a cluster the submitter builds its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        # The JVM does not compile methods above 8000 bytes; wide projections run faster split.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        # No call-site capture per column expression: plans are built faster.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )


@cache
def _local_folder() -> str:
    """One temporary folder for this process, removed when it ends."""
    folder = tempfile.mkdtemp(prefix="haltwerk-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local session, where driver and executors share one machine, may fall
    back to a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return _local_folder()
    raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; never reused, so nothing is overwritten."""
    return f"{shared_dir(spark)}/haltwerk-{label}-{uuid.uuid4().hex}"


def together(spark: SparkSession, *steps: Callable[[], object]) -> list:
    """What independent steps return. Their jobs share the cluster: one fills the cores that the last tasks of another leave idle.

    All have ended when this returns or raises what the first that failed has raised.
    """
    with ThreadPoolExecutor(len(steps)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
        wait(running)
    return [r.result() for r in running]
