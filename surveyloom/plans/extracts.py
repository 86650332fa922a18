"""The dashboard extracts: inputs of the chart datasets, from the aggregate tables.

Populations are those of the table an extract reads. Gender counts respondents with a title;
the work-model counts need a region.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveyloom.functions import weighted_mean
from surveyloom.operators.selection import ascending, descending, known
from surveyloom.plans.frames import Frames, one_segment
from surveyloom.plans.kpi_queries import Tables
from surveyloom.vocabulary import EVERYONE, Settings


def _overall(tables: Tables, name: str) -> DataFrame:
    return one_segment(tables, name, "geral").filter(F.col("segmento_valor") == EVERYONE)


def _rollup(cells: DataFrame, *keys: str) -> DataFrame:
    return cells.groupBy(*keys).agg(F.sum("respondentes").alias("respondentes"))


def kpis(tables: Tables, settings: Settings = Settings()) -> DataFrame:
    return tables["gold_kpis_anuais"]


def gender(tables: Tables, settings: Settings = Settings()) -> DataFrame:
    return _rollup(tables["gold_diversidade"], "ano_pesquisa", "genero")


def market(tables: Tables, settings: Settings = Settings()) -> DataFrame:
    return _rollup(tables["gold_mercado_profissionais"], "ano_pesquisa", "cargo_padronizado")


def pay_by_title(tables: Tables, settings: Settings = Settings()) -> DataFrame:
    cells = one_segment(tables, "gold_remuneracao", "cargo", "dimensao_tipo")
    return cells.filter(F.col("ano_pesquisa") == settings.focus_year).select(
        "ano_pesquisa",
        F.col("dimensao_valor").alias("cargo_padronizado"),
        "respondentes_ponto_medio",
        "salario_medio_aproximado",
    )


def pay_by_seniority(tables: Tables, settings: Settings = Settings()) -> DataFrame:
    return one_segment(tables, "gold_remuneracao", "senioridade", "dimensao_tipo").select(
        "ano_pesquisa",
        F.col("dimensao_valor").alias("senioridade"),
        "respondentes_faixa_valida",
        "respondentes_ponto_medio",
        "salario_medio_aproximado",
        "faixa_mediana_ordem",
    )


def technologies(tables: Tables, settings: Settings = Settings()) -> DataFrame:
    return _overall(tables, "gold_tecnologias").select(
        "ano_pesquisa", "tecnologia", "respondentes_elegiveis", "adotantes", "percentual_adocao"
    )


def ai_overall(tables: Tables, settings: Settings = Settings()) -> DataFrame:
    return _overall(tables, "gold_inteligencia_artificial").drop("segmento_tipo", "segmento_valor")


def ai_by_seniority(tables: Tables, settings: Settings = Settings()) -> DataFrame:
    return one_segment(tables, "gold_inteligencia_artificial", "senioridade").select(
        "ano_pesquisa",
        F.col("segmento_valor").alias("senioridade"),
        "respondentes_validos",
        "percentual_adocao_ia",
    )


def work_models(tables: Tables, settings: Settings = Settings()) -> DataFrame:
    model = "modelo_trabalho_padronizado"
    return _rollup(known(tables["gold_regiao_trabalho"], model), "ano_pesquisa", model)


def region_work(tables: Tables, settings: Settings = Settings()) -> DataFrame:
    """Pay by region and work model in the focus year, weighting the rounded cell means."""
    keys = ["regiao_moradia", "modelo_trabalho_padronizado"]
    cells = known(tables["gold_regiao_trabalho"], *keys)
    return (
        cells.filter(F.col("ano_pesquisa") == settings.focus_year)
        .groupBy(*keys)
        .agg(
            F.sum("respondentes_ponto_medio").alias("respondentes_ponto_medio"),
            weighted_mean("salario_medio_aproximado", "respondentes_ponto_medio").alias(
                "salario_medio_aproximado"
            ),
        )
    )


@dataclass(frozen=True)
class Extract:
    build: Callable[[Tables, Settings], DataFrame]
    order: tuple[Column, ...]


def _extracts() -> dict[str, Extract]:
    year = ascending("ano_pesquisa")
    model = ascending("modelo_trabalho_padronizado")
    # Extract names.
    return {
        "kpis": Extract(kpis, (year,)),
        "diversidade": Extract(gender, (year, ascending("genero"))),
        "mercado": Extract(market, (year, descending("respondentes"))),
        "remuneracao_cargo": Extract(pay_by_title, (descending("salario_medio_aproximado"),)),
        "remuneracao_senioridade": Extract(pay_by_seniority, (year, ascending("senioridade"))),
        "tecnologias": Extract(technologies, (year, ascending("tecnologia"))),
        "ia_geral": Extract(ai_overall, (year,)),
        "ia_senioridade": Extract(ai_by_seniority, (year, ascending("senioridade"))),
        "trabalho": Extract(work_models, (year, model)),
        "regiao_trabalho": Extract(region_work, (ascending("regiao_moradia"), model)),
    }


def build_extracts(tables: Tables, settings: Settings = Settings(), ordered: bool = True) -> Frames:
    """All extracts. Chart datasets sort for themselves and take them unordered."""

    def declare(extract: Extract) -> DataFrame:
        frame = extract.build(tables, settings)
        return frame.orderBy(*extract.order) if ordered else frame

    return Frames({name: partial(declare, extract) for name, extract in _extracts().items()})
