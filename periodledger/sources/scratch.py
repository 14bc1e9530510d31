"""Intermediate tables in the folder the cluster shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder. A folder of our own is made only in local mode, where
    every task runs on this machine anyway."""
    folder = spark.conf.get(SETTING, None) or spark.sparkContext.getConf().get(SETTING)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"{SETTING} must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="periodledger-")
        spark.conf.set(SETTING, folder)
    return folder.rstrip("/")


def materialize(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once and read it back: cuts the lineage, survives lost executors, and later
    readers get column pruning and pushdown; with ``partition_by``, folder pruning too."""
    path = f"{shared_folder(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.partitionBy(*(partition_by or [])).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
