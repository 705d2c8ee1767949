"""Shared scratch space, lineage cuts and row counts of a running job."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder of the cluster.

    A temporary one stands in for it only where all tasks run in this process.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not runs_in_one_process(spark.sparkContext.master):
            raise RuntimeError(
                "set spark.checkpoint.dir to a folder that all machines of the cluster share"
            )
        root = tempfile.mkdtemp(prefix="carelake-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def runs_in_one_process(master: str) -> bool:
    return master == "local" or master.startswith("local[")


def remove_scratch(spark: SparkSession) -> None:
    """Delete what ``scratch_path`` named; call it when no frame needs it any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint_root(spark).rstrip('/')}/carelake")
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path under the shared folder."""
    return f"{checkpoint_root(spark).rstrip('/')}/carelake/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage with a reliable checkpoint."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """Attach a row count that fills in when the frame is written."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    A job submitted with ``--py-files`` carrying ``carelake.zip`` has it already.
    """
    context = spark.sparkContext
    if any(f.endswith("/carelake.zip") for f in context.listFiles):
        return
    package = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="carelake-")
    archive = shutil.make_archive(
        f"{folder}/carelake", "zip", root_dir=package.parent, base_dir=package.name
    )
    context.addPyFile(archive)
