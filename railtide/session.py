"""Session settings, lineage cuts and the checkpoint folder."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# bytes of a batch of rows that a Python worker holds at a time, with its copies as Python objects
PYTHON_BATCH = "4m"


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the settings results and the memory of Python workers depend on and make reliable checkpoints possible."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", PYTHON_BATCH)
    ensure_checkpoint_dir(spark)
    ship(spark)
    return spark


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, so that it need not be installed on executors.

    It is zipped on the driver and added once per application; Spark hands it to every executor,
    also to one that replaces a lost one.
    """
    context = spark.sparkContext
    folder = Path(__file__).resolve().parent
    if not any(f"/{folder.name}-package.zip" in name for name in context.listFiles):
        archive = shutil.make_archive(f"{tempfile.mkdtemp()}/{folder.name}-package", "zip", folder.parent, folder.name)
        context.addPyFile(archive)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the shared folder named by ``spark.checkpoint.dir``; only a local session may make its own."""
    context = spark.sparkContext
    folder = context.getCheckpointDir()
    if folder:
        return folder
    folder = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="railtide-checkpoint-")
    context.setCheckpointDir(folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder, so that lost executors do not replay what came before."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame) -> DataFrame:
    """Use every core for costly row work on a table scan that has fewer partitions than cores.

    A large table has more partitions than that and is left alone, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
