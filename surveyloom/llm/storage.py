"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from surveyloom.session import fresh_folder


def stored(frame: DataFrame, purpose: str) -> DataFrame:
    """The rows of a frame, written once and read back: what follows starts from files and not from lost executors."""
    spark: SparkSession = frame.sparkSession
    path = fresh_folder(spark, purpose)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)
