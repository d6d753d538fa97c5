"""Intermediate tables on shared storage, for plans that read one result several times."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


def stage_folder(spark: SparkSession) -> str:
    """The shared folder that the cluster names, else one under the warehouse, which all executors reach too."""
    folder = spark.conf.get(_SETTING, None) or spark.sparkContext.getCheckpointDir()
    return folder or f"{spark.conf.get('spark.sql.warehouse.dir')}/_staged"


def staged(df: DataFrame) -> DataFrame:
    """Write the frame once and read it back: later passes prune columns, push filters into the scan and
    do not repeat the work when an executor is lost."""
    spark = df.sparkSession
    path = f"{stage_folder(spark)}/stage-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
