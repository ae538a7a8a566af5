"""Session helpers: settings for local runs, shared scratch space, cutting lineage."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  memory: str = "12g") -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    return (SparkSession.builder.master(f"local[{cpus}]").appName("rosterloom")
            .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
            .config("spark.sql.adaptive.enabled", "true")
            .config("spark.sql.session.timeZone", "UTC")
            .config("spark.driver.memory", memory)
            .config("spark.ui.enabled", "false")
            .config("spark.sql.execution.arrow.pyspark.enabled", "true")
            .getOrCreate())


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor reaches, from the session's ``spark.checkpoint.dir``.

    Only where that is unset on a single machine, as in tests, a local folder stands in and is
    set as the context's checkpoint directory too; a cluster without the setting is an error.
    """
    context = spark.sparkContext
    named = context.getConf().get(CHECKPOINT_SETTING) or spark.conf.get(CHECKPOINT_SETTING, None)
    if not named:
        named = context.getCheckpointDir()
    if not named:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError(f"set {CHECKPOINT_SETTING} to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="rosterloom-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex[:12]}")


def cut_lineage(df: DataFrame) -> DataFrame:
    """The rows as a table written to the shared folder: survives the loss of executors.

    Unlike a checkpoint, the table carries none of the plan's inferred constraints along,
    which pile up from round to round in iterative plans, and later reads prune columns.
    """
    path = scratch_path(df.sparkSession, "cut")
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.cut_path = path
    return table


def side_by_side(spark: SparkSession, *steps: Callable[[], None]) -> None:
    """Runs steps that do not need each other at once: small jobs leave most of a cluster idle.

    The first error is raised when all have ended.
    """
    with ThreadPoolExecutor(len(steps)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
    for step in running:
        step.result()


def discard(*tables: DataFrame) -> None:
    """Deletes tables of :func:`cut_lineage` that nothing will read again.

    Loops call it for the round before once the next round's table is written whole.
    """
    for table in tables:
        spark = table.sparkSession
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table.cut_path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
