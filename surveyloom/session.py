"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def build_session(app_name: str = "surveyloom", master: str | None = None, **settings: str) -> SparkSession:
    """A session in UTC with adaptive execution, so that skewed joins split and small outputs merge."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local session without the setting gets a temporary folder of its own.
    """
    context = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_SETTING, None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError(f"Set {CHECKPOINT_SETTING} to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="surveyloom-"))
    return context.getCheckpointDir()


def fresh_folder(spark: SparkSession, purpose: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/surveyloom/{purpose}-{uuid4().hex[:12]}"
