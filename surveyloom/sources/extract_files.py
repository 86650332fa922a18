"""Dashboard extracts kept as CSV files, with declared types."""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession

from surveyloom.functions import quoted, to_number, whole_number
from surveyloom.plans.frames import Frames

# File and columns of each extract.
EXTRACT_FILES = {
    "kpis": (
        "kpis_anuais.csv",
        "ano_pesquisa int, total_respondentes bigint, percentual_remoto double, "
        "percentual_mulheres double, percentual_ia double",
    ),
    "diversidade": ("diversidade_genero.csv", "ano_pesquisa int, genero string, respondentes bigint"),
    "mercado": ("mercado_cargos.csv", "ano_pesquisa int, cargo_padronizado string, respondentes bigint"),
    "remuneracao_cargo": (
        "remuneracao_cargo_2024.csv",
        "ano_pesquisa int, cargo_padronizado string, respondentes_ponto_medio bigint, "
        "salario_medio_aproximado double",
    ),
    "remuneracao_senioridade": (
        "remuneracao_senioridade.csv",
        "ano_pesquisa int, senioridade string, salario_medio_aproximado double",
    ),
    "tecnologias": ("tecnologias_geral.csv", "ano_pesquisa int, tecnologia string, percentual_adocao double"),
    "ia_geral": (
        "ia_geral.csv",
        "ano_pesquisa int, respondentes_validos bigint, percentual_adocao_ia double, uso_gratuito bigint, "
        "uso_pago_proprio bigint, uso_pago_empresa bigint, uso_copilot bigint",
    ),
    "trabalho": (
        "modelos_trabalho.csv",
        "ano_pesquisa int, modelo_trabalho_padronizado string, respondentes bigint",
    ),
}


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All columns of the file: those the charts read in their types, the others as text.

    A whole number may be written with decimals (`123.0`), as a column with gaps often is.
    """
    raw = spark.read.options(header="true", inferSchema="false", enforceSchema="false", quote='"', escape='"').csv(path)
    kinds = dict(field.strip().split(" ") for field in schema.split(","))

    def typed(name: str) -> Column:
        kind, text = kinds.get(name, "string"), quoted(name)
        if kind == "string":
            return text
        number = to_number(text) if kind == "double" else whole_number(text)
        return number.try_cast(kind).alias(name)

    declared = [name for name in kinds if name in raw.columns]
    return raw.select(*[typed(name) for name in [*declared, *[n for n in raw.columns if n not in kinds]]])


def read_extract_files(spark: SparkSession, folder: str) -> Frames:
    """The extracts of one folder, by extract name."""
    return Frames(
        {name: partial(_read, spark, f"{folder}/{file}", schema) for name, (file, schema) in EXTRACT_FILES.items()}
    )
