"""The two batch runs: check the raw editions, and build the conformed and aggregate tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from datetime import datetime, timezone
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from surveyloom.operators.audit import (
    METRICS,
    EmptyTable,
    LostRows,
    compare_profiles,
    conform_audit,
    expected_profiles,
    raise_on_lost_rows,
    raise_on_mismatch,
)
from surveyloom.operators.duplicates import duplicate_profile
from surveyloom.plans.frames import Frames
from surveyloom.plans.gold import GOLD_BUILDERS, YEAR, base_cube, gold_from_cube
from surveyloom.sinks.audit_log import append_run, new_run_id
from surveyloom.sinks.catalog import write_files
from surveyloom.sinks.runs import Part, current_run, parts_of, publish_run, published_parts
from surveyloom.sources.conform import Rule, conform
from surveyloom.sources.raw_csv import check_width, read_raw_csv
from surveyloom.vocabulary import AUDIT_TABLE, SENIORITIES, SILVER_TABLE, Settings


@dataclass(frozen=True)
class Edition:
    """One survey edition: where its raw files are, its expected shape, and how to conform it."""

    year: int
    path: str
    rules: Mapping[str, Rule] = field(default_factory=dict)
    profile: Mapping[str, int] | None = None
    stored: str | None = None
    rows: int | None = None

    @property
    def width(self) -> int | None:
        return self.profile.get("colunas") if self.profile else None

    @property
    def file(self) -> str:
        return self.path.rstrip("/").rsplit("/", 1)[-1]


def read_edition(spark: SparkSession, edition: Edition) -> DataFrame:
    """The raw rows, from Parquet once they are stored; the header width is checked either way."""
    raw = spark.read.parquet(edition.stored) if edition.stored else read_raw_csv(spark, edition.path)
    return check_width(raw, edition.year, edition.width)


def store_raw(spark: SparkSession, editions: Sequence[Edition], location: str) -> list[Edition]:
    """Parse every edition once and keep its raw text as Parquet.

    The write reads whole rows, so that a malformed row fails here and cannot hide behind a
    narrow projection later. It also counts them: `rows` of the editions that are returned.
    """
    stored = []
    for edition in editions:
        path, written = f"{location}/{edition.year}", Observation()
        raw = check_width(read_raw_csv(spark, edition.path), edition.year, edition.width)
        raw.observe(written, F.count("*").alias("registros")).write.mode("overwrite").parquet(path)
        stored.append(replace(edition, stored=path, rows=written.get["registros"]))
    return stored


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def profile_editions(spark: SparkSession, editions: Sequence[Edition]) -> DataFrame:
    """Rows, columns and excess duplicates of every edition, in one job and one pass each."""

    def profile(edition: Edition) -> DataFrame:
        raw = read_edition(spark, edition)
        return duplicate_profile(raw).select(
            F.lit(edition.year).alias("ano_pesquisa"),
            F.lit(edition.file).alias("arquivo_origem"),
            F.lit(edition.path).alias("caminho_bronze"),
            F.lit("bronze").alias("camada_origem"),
            "registros",
            F.lit(len(raw.columns)).cast("long").alias("colunas"),
            "duplicados_excedentes",
        )

    return union_all([profile(edition) for edition in sorted(editions, key=lambda e: e.year)])


def stamp_audit(profile: DataFrame, comparison: DataFrame, run_id: str, at: datetime) -> DataFrame:
    """The profile with its status against the expectation, the run and its time."""
    matched = comparison.groupBy("ano_pesquisa").agg(F.every("confere").alias("confere"))
    return profile.join(matched, "ano_pesquisa", "left").select(
        *profile.columns,
        F.when(F.col("confere"), "OK").when(F.col("confere").isNull(), "SEM_PERFIL").otherwise("DIVERGENTE").alias("status"),
        F.lit(run_id).alias("id_execucao"),
        F.lit(at).alias("data_hora_processamento"),
    )


def validate_editions(
    spark: SparkSession,
    editions: Sequence[Edition],
    audit_path: str,
    expected: DataFrame | None = None,
) -> str:
    """Audit the raw editions into a new run of the audit log; the run's id is returned.

    Raises ProfileMismatch after the audit is stored, so the log also has the failed runs. What is `expected` is stored beside the
    log and read from there by both comparisons: it may be derived from all rows.
    """
    at = datetime.now(timezone.utc)
    run_id = new_run_id(at)
    profile = profile_editions(spark, editions)
    declared = {e.year: e.profile for e in editions if e.profile}
    # An edition without a profile of its own is audited, but has nothing to be compared with.
    compared = F.lit(True) if expected is not None else F.col("ano_pesquisa").isin(*declared)
    if expected is None:
        expected = expected_profiles(spark, declared)
    else:
        expected = write_files(expected, f"{audit_path}_esperado/{run_id}")
    comparison = compare_profiles(profile.filter(compared), expected)
    append_run(stamp_audit(profile, comparison, run_id, at), audit_path)
    stored = spark.read.parquet(audit_path).filter((F.col("id_execucao") == run_id) & compared)
    raise_on_mismatch(compare_profiles(stored.select("ano_pesquisa", *METRICS), expected))
    return run_id


def conform_editions(spark: SparkSession, editions: Sequence[Edition], processed_at: datetime) -> DataFrame:
    """All editions in the conformed columns; no row is dropped or merged."""
    return union_all(
        [
            conform(read_edition(spark, edition), edition.year, edition.rules, processed_at)
            for edition in sorted(editions, key=lambda e: e.year)
        ]
    )


@dataclass(frozen=True)
class Staged:
    """Files of a run that nothing points at yet."""

    folder: str
    parts: tuple[Part, ...] = ()
    tables: Mapping[str, DataFrame] = field(default_factory=dict)

    def with_table(self, name: str, key: str, frame: DataFrame, rebalance: bool = True, **counts: Column) -> tuple[Staged, dict]:
        """One more table, written by edition, and what was counted while it was written.

        The counts stand behind the last shuffle, so a task that runs again counts once.
        """
        path, written = f"{self.folder}/{name}", Observation()
        if rebalance:
            frame = frame.hint("rebalance", F.col(key))
        metrics = {"anos": F.collect_set(key), "sem_ano": F.count_if(F.col(key).isNull()), **counts}
        frame = frame.observe(written, *[metric.alias(label) for label, metric in metrics.items()])
        table = write_files(frame, path, [key], rebalance=False)
        found = written.get
        years = [*sorted(found["anos"]), *[None] * bool(found["sem_ano"])]
        return replace(self, parts=(*self.parts, *parts_of(name, key, frame, path, years)), tables={**self.tables, name: table}), found


def stage_gold(
    silver: DataFrame,
    folder: str,
    settings: Settings = Settings(),
    rebalance: bool = True,
    expected: Mapping[int, int] | None = None,
) -> Staged:
    """Write the conformed rows by edition, their cube, and every aggregate table from the cube; nothing is published.

    The conformed rows are scanned once. The written tables are restart points: a lost executor re-reads Parquet, not the raw text.
    `expected` rows of each edition are compared with those that were written, before anything is built from them.
    """
    wanted = expected or {}
    counts = {f"ano_{year}": F.count_if(F.col(YEAR) == year) for year in wanted}
    staged, written = Staged(folder).with_table(SILVER_TABLE, YEAR, silver, rebalance, **counts)
    lost = sorted(year for year, rows in wanted.items() if written[f"ano_{year}"] != rows)
    if lost:
        raise LostRows(f"Editions with lost rows: {lost}")
    cube = write_files(base_cube(staged.tables[SILVER_TABLE]), f"{folder}/cubo", [YEAR])
    for name, frame in gold_from_cube(cube, settings).items():
        staged, _ = staged.with_table(name, YEAR, frame)
    return staged


def raise_on_empty(parts: Sequence[Part]) -> None:
    """A table without rows has no part."""
    there = {part.table for part in parts}
    empty = [name for name in GOLD_BUILDERS if name not in there]
    if empty:
        raise EmptyTable(f"No rows in: {empty}")


def _run(location: str) -> tuple[str, str]:
    run_id = new_run_id(datetime.now(timezone.utc))
    return run_id, f"{location}/runs/{run_id}"


def store_gold(
    spark: SparkSession,
    silver: DataFrame,
    database: str,
    location: str,
    settings: Settings = Settings(),
    rebalance: bool = True,
) -> Frames:
    """Write and publish the conformed and aggregate tables."""
    run_id, folder = _run(location)
    staged = stage_gold(silver, folder, settings, rebalance)
    raise_on_empty(staged.parts)
    return publish_run(spark, database, location, run_id, staged.parts)


def _stage_editions(
    spark: SparkSession,
    editions: Sequence[Edition],
    folder: str,
    regions: Sequence[str],
    settings: Settings,
) -> Staged:
    """Raw editions to conformed, aggregate and audit tables in a folder; raises where an edition has lost rows."""
    editions = store_raw(spark, editions, f"{folder}/bronze")
    silver = conform_editions(spark, editions, datetime.now(timezone.utc))
    # Every task reads one edition, so the rows are already apart by edition.
    expected = {edition.year: edition.rows for edition in editions}
    staged = stage_gold(silver, folder, settings, rebalance=False, expected=expected)
    audit = conform_audit(profile_editions(spark, editions), staged.tables[SILVER_TABLE], regions, SENIORITIES)
    staged, _ = staged.with_table(AUDIT_TABLE, "ano", audit)
    raise_on_lost_rows(staged.tables[AUDIT_TABLE])
    return staged


def build_lake(
    spark: SparkSession,
    editions: Sequence[Edition],
    database: str,
    location: str,
    regions: Sequence[str],
    settings: Settings = Settings(),
) -> Frames:
    """Raw editions to conformed, aggregate and audit tables.

    Each run writes to a folder of its own. Only when no aggregate is empty and no edition has lost rows is it published, all
    tables at once; a run that fails at any point leaves readers with the whole run before it.
    """
    run_id, folder = _run(location)
    staged = _stage_editions(spark, editions, folder, regions, settings)
    raise_on_empty(staged.parts)
    return publish_run(spark, database, location, run_id, staged.parts)


def add_editions(
    spark: SparkSession,
    editions: Sequence[Edition],
    database: str,
    location: str,
    regions: Sequence[str],
    settings: Settings = Settings(),
) -> Frames:
    """Publish a run that has these editions anew and all others as they are: only these are read and built.

    Every table is kept by edition and no cell spans two, so the result is that of building all editions. A table without rows
    in the new editions alone is no error when it has rows in others.
    """
    base = current_run(spark, location)
    run_id, folder = _run(location)
    staged = _stage_editions(spark, editions, folder, regions, settings)
    years = {edition.year for edition in editions}
    kept = [part for part in published_parts(spark, location, base) if part.year not in years] if base else []
    parts = [*kept, *staged.parts]
    raise_on_empty(parts)
    return publish_run(spark, database, location, run_id, parts, based_on=base)
