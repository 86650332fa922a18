"""Audit rows, kept per run."""

from __future__ import annotations

from datetime import datetime
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUN = "id_execucao"
VERSION = "versao"


def _started(at: datetime) -> str:
    return f"{int(at.timestamp() * 1000):015d}"


def new_run_id(at: datetime) -> str:
    """Milliseconds of the start, so that runs sort by it, and a random part."""
    return f"{_started(at)}x{uuid4().hex}"


def append_run(audit: DataFrame, path: str) -> None:
    """Add a run as its own partition; earlier runs stay. Audits have one row per edition."""
    audit.hint("rebalance").write.mode("append").partitionBy(RUN).parquet(path)


def _archive(spark: SparkSession, path: str) -> DataFrame | None:
    """The archive written last, if there is one; a write that failed has left no row."""
    try:
        versions = spark.read.parquet(f"{path}_arquivo")
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    newest = versions.agg(F.max(VERSION)).first()[0]
    return versions.filter(F.col(VERSION) == newest).drop(VERSION)


def read_runs(spark: SparkSession, path: str, since: datetime | None = None) -> DataFrame:
    """All runs, or those that began at `since` or later: the folders of other runs are not opened.

    A run that is in the archive is read from there.
    """
    runs, archive = spark.read.parquet(path), _archive(spark, path)
    runs = runs.withColumn(RUN, F.col(RUN).cast("string"))
    if since is not None:
        runs = runs.filter(F.col(RUN) >= _started(since))
    if archive is None:
        return runs
    if since is not None:
        archive = archive.filter(F.col(RUN) >= _started(since))
    left = runs.join(archive.select(RUN).distinct(), RUN, "left_anti")
    return left.unionByName(archive, allowMissingColumns=True).select(*runs.columns)


def latest_by_edition(runs: DataFrame, key: str = "ano_pesquisa") -> DataFrame:
    """Of each edition the rows' newest: the run that began last decides, whatever its status."""
    others = [name for name in runs.columns if name != key]
    newest = runs.groupBy(key).agg(F.max_by(F.struct(*others), RUN).alias("ultima"))
    return newest.select(key, "ultima.*")


def history(runs: DataFrame, key: str = "ano_pesquisa") -> DataFrame:
    """Per edition: how many runs saw it, how many it passed, when it was last right, and whether its rows have changed."""
    passed = F.col("status") == "OK"
    return runs.groupBy(key).agg(
        F.countDistinct(RUN).alias("execucoes"),
        F.count_if(passed).alias("aprovadas"),
        F.max(F.when(passed, F.col(RUN))).alias("ultima_aprovada"),
        (F.min("registros") < F.max("registros")).alias("registros_mudaram"),
        F.max_by("status", RUN).alias("status"),
    )


def compact_runs(spark: SparkSession, path: str, keep: int) -> None:
    """Put all runs but the last `keep` into one file of the archive.

    A reader finds a run in its folder or in the archive, never twice, so folders that are archived may be removed at any time.
    """
    runs = read_runs(spark, path)
    last = runs.select(RUN).distinct().orderBy(F.desc(RUN)).limit(keep)
    old = runs.join(last, RUN, "left_anti")
    archive = _archive(spark, path)
    version = 1 if archive is None else spark.read.parquet(f"{path}_arquivo").agg(F.max(VERSION)).first()[0] + 1
    # One row for each run and edition; one file, so that a version is there whole or not at all.
    old.coalesce(1).write.parquet(f"{path}_arquivo/{VERSION}={version}")


def preview(frame: DataFrame, *order: str, rows: int = 20) -> None:
    """Print the first rows in order, and how many there are."""
    print(f"{frame.count()} rows, of which at most {rows} are shown")
    frame.orderBy(*[F.asc_nulls_last(name) for name in order]).show(rows, truncate=False)
