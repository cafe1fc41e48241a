"""The shared folder, and tables settled there."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder below the cluster's shared checkpoint folder.

    Only a local session without that setting falls back to a temporary folder: on a cluster a
    machine-local folder would be invisible to the executors, so there it is an error.
    """
    root = spark.conf.get(_SETTING, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {_SETTING} to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return f"{root.rstrip('/')}/vaultwatch/{purpose}-{uuid.uuid4().hex}"


def settle(df: DataFrame, purpose: str) -> DataFrame:
    """Write a small intermediate result to the shared folder and read it back.

    It is then computed once, survives the loss of executors, and has an exact size: the planner
    broadcasts it in a join when the files are below ``spark.sql.autoBroadcastJoinThreshold`` and
    shuffles it otherwise.
    """
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
