"""Frames that several jobs read."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def cut_lineage(df: DataFrame) -> DataFrame:
    """Keep the frame for later jobs.

    With a checkpoint folder (``spark.checkpoint.dir``) it is written there, and later jobs do not repeat its computation,
    also after the loss of an executor. Without one Spark's block storage holds it, and lost blocks are computed again.
    """
    context = df.sparkSession.sparkContext
    folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
    if context.getCheckpointDir() is None and folder is not None:
        context.setCheckpointDir(folder)
    return df.checkpoint(eager=True) if context.getCheckpointDir() is not None else df.persist()


def new_folder(spark: SparkSession) -> str:
    """Path of a new folder inside the one that the cluster shares (``spark.checkpoint.dir``).

    A local session without that setting gets a temporary one; a cluster must name it.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if base is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the cluster shares")
        base = tempfile.mkdtemp(prefix="results-")
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"
