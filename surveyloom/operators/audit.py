"""Audits: what an edition should look like, what it looked like, and what conforming kept."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.operators.duplicates import duplicate_profile

PROCESSED_AT = "processado_em"
PROFILE_SCHEMA = "ano_pesquisa int, registros bigint, colunas bigint, duplicados_excedentes bigint"
METRICS = ("registros", "colunas", "duplicados_excedentes")


class ProfileMismatch(ValueError):
    """An edition differs from its expected rows, columns or duplicates."""


class LostRows(ValueError):
    """Conforming lost, added or merged rows of an edition."""


class EmptyTable(ValueError):
    """A table that must have rows has none."""


def expected_profiles(spark: SparkSession, profiles: Mapping[int, Mapping[str, int]]) -> DataFrame:
    """The declared shape of each edition: one row per edition, metadata only. A metric that is not declared is NULL."""
    rows = [(year, *[profiles[year].get(metric) for metric in METRICS]) for year in sorted(profiles)]
    return spark.createDataFrame(rows, PROFILE_SCHEMA)


def compare_profiles(found: DataFrame, expected: DataFrame) -> DataFrame:
    """One row per edition and declared metric. An edition on one side only does not match in any metric."""
    wanted = expected.select(
        "ano_pesquisa", F.lit(True).alias("declarada"), *[F.col(m).alias(f"esperado_{m}") for m in METRICS]
    )
    both = found.select("ano_pesquisa", *METRICS).join(wanted, "ano_pesquisa", "full_outer")
    checks = [
        F.struct(
            F.lit(metric).alias("metrica"),
            F.col(metric).cast("long").alias("obtido"),
            F.col(f"esperado_{metric}").cast("long").alias("esperado"),
        )
        for metric in METRICS
    ]
    rows = both.select("ano_pesquisa", "declarada", F.inline(F.array(*checks)))
    rows = rows.filter(F.col("declarada").isNull() | F.col("esperado").isNotNull()).drop("declarada")
    return rows.withColumn("confere", F.coalesce(F.col("obtido") == F.col("esperado"), F.lit(False)))


def raise_on_mismatch(comparison: DataFrame) -> None:
    """The message names every mismatch; there are at most three for each edition."""
    wrong = comparison.filter(~F.col("confere")).orderBy("ano_pesquisa", "metrica").collect()
    if wrong:
        found = [(r.ano_pesquisa, r.metrica, r.obtido, r.esperado) for r in wrong]
        raise ProfileMismatch(f"(edition, metric, found, expected): {found}")


def _rows_if(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def _outside(column: str, valid: Sequence[str]) -> Column:
    return _rows_if(F.col(column).isNotNull() & ~F.col(column).isin(*valid))


def invalid_values(regions: Sequence[str], seniorities: Sequence[str]) -> dict[str, Column]:
    """What the audit counts on conformed rows: 1 for a row without an id or with an unlisted value."""
    return {
        "ids_nulos": _rows_if(F.col("id_respondente").isNull()),
        "regioes_invalidas": _outside("regiao_moradia", regions),
        "senioridades_invalidas": _outside("senioridade", seniorities),
    }


def conform_audit(
    bronze_profile: DataFrame,
    silver: DataFrame,
    regions: Sequence[str],
    seniorities: Sequence[str],
) -> DataFrame:
    """Rows in, out and lost per edition, with invalid values.

    Duplicates are kept, and counted again on the conformed rows. ERRO: rows were lost or appeared, or fewer duplicates than
    raw ones are left; ALERTA: all rows are there, but some have become equal, have no id or an invalid value.
    """
    measures = invalid_values(regions, seniorities)
    return audit_status(bronze_profile, duplicate_profile(silver.drop(PROCESSED_AT), keys=["ano_pesquisa"], measures=measures))


def audit_status(bronze_profile: DataFrame, silver_profile: DataFrame) -> DataFrame:
    """The audit of both profiles (ano_pesquisa, registros, duplicados_excedentes; of the conformed rows also the invalid values)."""
    zero = F.lit(0).cast("long")
    counts = ["ids_nulos", "regioes_invalidas", "senioridades_invalidas"]
    out = silver_profile.select(
        "ano_pesquisa", F.col("registros").alias("saida"), F.col("duplicados_excedentes").alias("preservadas"), *counts
    )
    invalid = F.col("ids_nulos") + F.col("regioes_invalidas") + F.col("senioridades_invalidas")
    audited = bronze_profile.join(out, "ano_pesquisa", "full_outer").select(
        F.col("ano_pesquisa").alias("ano"),
        F.lit("bronze_para_silver").alias("etapa"),
        F.coalesce("registros", zero).alias("registros_entrada"),
        F.coalesce("saida", zero).alias("registros_saida"),
        F.coalesce("preservadas", zero).alias("duplicidades_excedentes_preservadas"),
        F.coalesce("duplicados_excedentes", zero).alias("esperadas"),
        *[F.coalesce(name, zero).alias(name) for name in counts],
    )
    lost = F.col("registros_entrada") - F.col("registros_saida")
    kept = F.col("duplicidades_excedentes_preservadas") - F.col("esperadas")
    wrong = (F.col("registros_descartados") != 0) | (kept < 0)
    status = F.when(wrong, "ERRO").when((invalid > 0) | (kept > 0), "ALERTA").otherwise("OK")
    return audited.withColumn("registros_descartados", lost).withColumn("status", status).drop("esperadas")


def raise_on_lost_rows(audited: DataFrame) -> None:
    """One row per edition goes to the driver."""
    wrong = [r.ano for r in audited.filter("status = 'ERRO'").select("ano").orderBy("ano").collect()]
    if wrong:
        raise LostRows(f"Editions with lost rows: {wrong}")


def assert_not_empty(tables: Mapping[str, DataFrame], names: Iterable[str]) -> None:
    empty = [name for name in names if tables[name].isEmpty()]
    if empty:
        raise EmptyTable(f"No rows in: {empty}")
