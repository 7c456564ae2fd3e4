"""Intermediate tables in the folder that the cluster shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """A new folder's path below ``spark.checkpoint.dir``; where that is unset, a local master
    gets a temporary folder and a cluster the warehouse."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        local = spark.sparkContext.master.startswith("local[") or spark.sparkContext.master == "local"
        base = f"file://{tempfile.gettempdir()}" if local else spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/quarrylens-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet and reread: its lineage ends at files that outlive executors."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
