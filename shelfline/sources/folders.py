"""Where jobs leave data that has to survive a lost executor."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the shared one the session names, or that its context was given."""
    root = spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if not root:
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder all executors share")
    return f"{root.rstrip('/')}/shelfline/{purpose}-{uuid4().hex}"


def materialized(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written below the shared folder and read back. For a small result that a plan uses
    many times: it is computed once, the plan stays short, and no executor is needed to keep it."""
    spark = df.sparkSession
    folder = shared_folder(spark, purpose)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)
