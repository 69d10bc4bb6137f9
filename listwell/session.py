"""Session settings and lineage cutting shared by every job."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str | int = "*", app: str = "listwell") -> SparkSession:
    """A session for tests and benches; a cluster brings its own."""
    n = os.cpu_count() if cores == "*" else int(cores)
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "12g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(max(n or 8, 2)))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def spread(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt by ``keys`` to two tasks a core, for much work on short rows.

    A table of short rows is read by a task or two however much each row has to go through. By a hash, so a task that
    runs again gets the same rows; and to a number of its own, as the rows' bytes say nothing of the work.
    """
    return rows.repartition(2 * rows.sparkSession.sparkContext.defaultParallelism, *keys)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints.

    A cluster names it in ``spark.checkpoint.dir``. Only a local master, where the
    driver's disk is the executors' disk, gets a folder of its own.
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="listwell-ckpt-")
    sc.setCheckpointDir(named)
    return named


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives the loss of any executor."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
