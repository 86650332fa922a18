"""Published runs: all tables of a run become visible at once.

The files of a table are kept by edition. A log names, for each publication, the files of every table and edition. A
publication is one file that is added to the log, so readers have the whole run before it or the whole run after it. The catalog holds
one external table for the files of all runs, partitioned by run and edition, and one view on the run published last; both can be
made again from the log.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from surveyloom.plans.frames import Frames
from surveyloom.sinks.catalog import ensure_database, qualified, quoted_text

RUN = "id_execucao"
LOG_SCHEMA = f"ordem bigint, {RUN} string, tabela string, chave string, esquema string, ano int, caminho string"
NO_YEAR = "__HIVE_DEFAULT_PARTITION__"


class UnknownRun(ValueError):
    """A run that was never published."""


class ConcurrentPublication(RuntimeError):
    """Another run was published since this one was based on the current one."""


class ChangedColumn(ValueError):
    """A column has another type than in the runs before."""


@dataclass(frozen=True)
class Part:
    """The files of one edition of one table. key: the column that holds the edition; schema: all columns in order, as JSON."""

    table: str
    key: str
    schema: str
    year: int | None
    path: str

    @property
    def columns(self) -> StructType:
        return StructType.fromJson(json.loads(self.schema))


def parts_of(table: str, key: str, frame: DataFrame, path: str, years: Iterable[int | None]) -> list[Part]:
    """The parts of a table that was written by edition below `path`."""
    schema = frame.schema.json()
    return [Part(table, key, schema, year, f"{path}/{key}={NO_YEAR if year is None else year}") for year in years]


def store_of(database: str) -> str:
    """The database that holds the files of all runs."""
    return f"{database}_execucoes"


def _log(spark: SparkSession, location: str) -> DataFrame:
    return spark.read.schema(LOG_SCHEMA).parquet(f"{location}/publicacoes")


def publications(spark: SparkSession, location: str) -> DataFrame:
    """ordem, id_execucao: every publication, in order. Empty before the first."""
    from pyspark.errors import AnalysisException

    try:
        return _log(spark, location).select("ordem", RUN).distinct().orderBy("ordem")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"ordem bigint, {RUN} string")


def current_run(spark: SparkSession, location: str) -> str | None:
    """The run that readers see."""
    return publications(spark, location).agg(F.max_by(RUN, "ordem")).first()[0]


def published_parts(spark: SparkSession, location: str, run_id: str | None = None) -> list[Part]:
    """What a run consists of (default: the current one): a row for each table and edition."""
    run_id = run_id or current_run(spark, location)
    if run_id is None:
        return []
    rows = _log(spark, location).filter(F.col(RUN) == run_id).drop("ordem").distinct().orderBy("tabela", "ano").collect()
    if not rows:
        raise UnknownRun(run_id)
    return [Part(r.tabela, r.chave, r.esquema, r.ano, r.caminho) for r in rows]


def _fields(schema: StructType, without: str) -> str:
    return ", ".join(f"{qualified(f.name)} {f.dataType.simpleString()}" for f in schema.fields if f.name != without)


def _store_table(spark: SparkSession, database: str, location: str, part: Part) -> None:
    """The external table of all runs; columns that are new in this run are added to it."""
    name, schema = qualified(store_of(database), part.table), part.columns
    kind = schema[part.key].dataType.simpleString()
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({_fields(schema, part.key)}, {RUN} string, {qualified(part.key)} {kind}) USING parquet"
        f" PARTITIONED BY ({RUN}, {qualified(part.key)}) LOCATION '{quoted_text(location)}/execucoes/{part.table}'"
    )
    known = spark.table(name).schema
    old = {f.name: f.dataType for f in known.fields}
    changed = [f.name for f in schema.fields if old.get(f.name, f.dataType) != f.dataType]
    if changed:
        raise ChangedColumn(f"{part.table}: {changed}")
    new = StructType([f for f in schema.fields if f.name not in old])
    if new.fields:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({_fields(new, part.key)})")


def _add_parts(spark: SparkSession, database: str, run_id: str, parts: Sequence[Part]) -> None:
    name = qualified(store_of(database), parts[0].table)
    places = " ".join(
        f"PARTITION ({RUN} = '{run_id}', {qualified(p.key)} = {'null' if p.year is None else p.year}) LOCATION '{quoted_text(p.path)}'"
        for p in parts
    )
    spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {places}")


def _view(spark: SparkSession, database: str, part: Part) -> None:
    name, store = qualified(database, part.table), store_of(database)
    columns = ", ".join(qualified(f.name) for f in part.columns.fields)
    if spark.catalog.tableExists(name) and spark.table(name).columns == part.columns.names:
        return
    spark.sql(
        f"CREATE OR REPLACE VIEW {name} AS SELECT {columns} FROM {qualified(store, part.table)}"
        f" WHERE {RUN} = (SELECT max_by({RUN}, ordem) FROM {qualified(store, 'publicacoes')})"
    )


def _register(spark: SparkSession, database: str, location: str, run_id: str, parts: Sequence[Part]) -> None:
    """Tables, partitions and views of a run; none of it is visible before the log names the run."""
    ensure_database(spark, database, location)
    ensure_database(spark, store_of(database), f"{location}/execucoes")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {qualified(store_of(database), 'publicacoes')} ({LOG_SCHEMA}) USING parquet"
        f" LOCATION '{quoted_text(location)}/publicacoes'"
    )
    for table in dict.fromkeys(part.table for part in parts):
        own = [part for part in parts if part.table == table]
        _store_table(spark, database, location, own[0])
        _add_parts(spark, database, run_id, own)
        _view(spark, database, own[0])


def publish_run(
    spark: SparkSession, database: str, location: str, run_id: str, parts: Sequence[Part], based_on: str | None = None
) -> Frames:
    """Make a run the one that readers see. `based_on`: the run whose parts it takes over, which must still be the current one.

    Everything before the last line can fail without any reader noticing.
    """
    _register(spark, database, location, run_id, parts)
    if based_on is not None and current_run(spark, location) != based_on:
        raise ConcurrentPublication(f"{run_id} is based on {based_on}")
    order = time.time_ns()
    rows = [(order, run_id, p.table, p.key, p.schema, p.year, p.path) for p in parts]
    spark.createDataFrame(rows, LOG_SCHEMA).coalesce(1).write.mode("append").parquet(f"{location}/publicacoes")
    _refresh(spark, database, parts)
    return read_run(spark, database, run_id, dict.fromkeys(part.table for part in parts))


def _refresh(spark: SparkSession, database: str, parts: Sequence[Part]) -> None:
    for table in ("publicacoes", *dict.fromkeys(part.table for part in parts)):
        spark.catalog.refreshTable(qualified(store_of(database), table))


def read_run(spark: SparkSession, database: str, run_id: str, names: Iterable[str]) -> Frames:
    """The tables of one run, whatever is published later."""

    def table(name: str) -> DataFrame:
        columns = spark.table(qualified(database, name)).columns
        return spark.table(qualified(store_of(database), name)).filter(F.col(RUN) == run_id).select(*columns)

    return Frames({name: partial(table, name) for name in names})


def revert(spark: SparkSession, database: str, location: str, run_id: str) -> Frames:
    """Publish an earlier run again; its files are where they were."""
    return publish_run(spark, database, location, run_id, published_parts(spark, location, run_id))


def attach(spark: SparkSession, database: str, location: str) -> Frames:
    """Make the catalog's tables and views again from the log, for a session whose catalog has none."""
    run_id = current_run(spark, location)
    if run_id is None:
        raise UnknownRun(f"nothing is published in {location}")
    parts = published_parts(spark, location, run_id)
    _register(spark, database, location, run_id, parts)
    _refresh(spark, database, parts)
    return read_run(spark, database, run_id, dict.fromkeys(part.table for part in parts))
