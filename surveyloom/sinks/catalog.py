"""Catalogued Parquet tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.plans.frames import Frames


def qualified(*parts: str) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in parts)


def quoted_text(text: str) -> str:
    """The inside of a string literal."""
    return text.replace("\\", "\\\\").replace("'", "\\'")


def ensure_database(spark: SparkSession, database: str, location: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {qualified(database)} LOCATION '{quoted_text(location)}'")


def use_database(spark: SparkSession, database: str) -> None:
    spark.catalog.setCurrentDatabase(database)


def write_table(
    frame: DataFrame,
    database: str,
    table: str,
    path: str,
    partition_by: Sequence[str] = (),
    rebalance: bool = True,
) -> None:
    """Overwrite an external Parquet table: its files are written, then the table points at them.

    Rebalancing shuffles the output by size: a small aggregate ends in one file, a large
    partition in several, and no single task writes everything. Rows that already come one
    partition per task are written as they are, without a shuffle.
    """
    write_files(frame, path, partition_by, rebalance)
    publish(frame.sparkSession, database, table, path, partition_by)


def write_files(frame: DataFrame, path: str, partition_by: Sequence[str] = (), rebalance: bool = True) -> DataFrame:
    """Write the Parquet files of a table and read them back; nothing in the catalog changes."""
    if rebalance:
        frame = frame.hint("rebalance", *[F.col(c) for c in partition_by])
    frame.write.mode("overwrite").option("compression", "snappy").parquet(path, partitionBy=list(partition_by) or None)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def publish(spark: SparkSession, database: str, table: str, path: str, partition_by: Sequence[str] = ()) -> None:
    """Point an external table at files. The files it pointed at before stay where they are."""
    name = qualified(database, table)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.catalog.createTable(name, path=path, source="parquet")
    if partition_by:
        spark.catalog.recoverPartitions(name)
    spark.catalog.refreshTable(name)


def read_tables(spark: SparkSession, database: str, names: Iterable[str]) -> Frames:
    return Frames({name: partial(spark.table, qualified(database, name)) for name in names})


def inventory(spark: SparkSession, database: str) -> DataFrame:
    """Tables of a database, without the session's temporary views."""
    return spark.sql(f"SHOW TABLES IN {qualified(database)}").filter(~F.col("isTemporary"))
