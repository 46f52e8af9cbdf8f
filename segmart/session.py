"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
JOBS_AT_ONCE = 8
Result = TypeVar("Result")


def build_session(app_name: str = "segmart", master: str | None = None, **conf: str) -> SparkSession:
    """Create a session with adaptive execution on; `conf` wins over the defaults.

    Endpoints, credentials and cluster sizes are left to spark-submit or to `conf`.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder for checkpoints and intermediate tables, as the session names it.

    A local session without a folder gets a temporary one. On a cluster a missing
    folder is an error: executors could not see a driver-local path.
    """
    context = spark.sparkContext
    folder = context.getCheckpointDir()
    if folder:
        return folder
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="segmart-")
    context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other call uses."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared folder and read it back.

    Used where one input feeds several jobs: each of them then scans only the
    columns it needs, and a lost executor costs a re-read instead of a re-run.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def at_once(spark: SparkSession, steps: Mapping[str, Callable[[], Result]]) -> dict[str, Result]:
    """Run independent steps side by side, each of which starts jobs of its own, and name their results.

    Small jobs do not fill a cluster; one after the other they would mostly wait for the driver.
    """
    with ThreadPoolExecutor(JOBS_AT_ONCE) as pool:
        started = {name: pool.submit(inheritable_thread_target(spark)(step)) for name, step in steps.items()}
        return {name: step.result() for name, step in started.items()}
