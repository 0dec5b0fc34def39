"""Folders for what a query writes and reads again."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import SparkSession


def shared_root(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir. Where none is named, a local session takes one beside
    its warehouse; on a cluster that is an error, as executors share no local folder."""
    root, master = spark.conf.get("spark.checkpoint.dir", ""), spark.sparkContext.master
    if not root and master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return root or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/snapquarry-checkpoints"


def new_folder(spark: SparkSession, name: str) -> str:
    """A path of its own under the shared folder. Lazy results read it, so the cluster clears it, as it does checkpoints."""
    return f"{shared_root(spark).rstrip('/')}/{name}-{uuid4().hex}"
