"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from ..session import checkpoint_dir


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet under ``spark.checkpoint.dir`` and opened again: several consumers read
    the rows instead of computing them, with sizes the planner knows, and a lost executor costs nothing."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
