"""Intermediate results on shared storage.

A staged table cuts the lineage and survives the loss of executors, which neither a cached frame
nor a machine-local folder does. It goes under the folder the cluster names in
``spark.checkpoint.dir``.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


# Application id -> folder, for sessions without a configured one.
_TEMPORARY: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder from ``spark.checkpoint.dir``; a temporary one only where that is unset, in one process."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        application = spark.sparkContext.applicationId
        if application not in _TEMPORARY:
            _TEMPORARY[application] = tempfile.mkdtemp(prefix="tallyhouse-")
        folder = _TEMPORARY[application]
    return folder.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/tallyhouse/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write the frame as a columnar table in the shared folder and read it back."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
