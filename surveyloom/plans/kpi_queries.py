"""The named KPI queries over the aggregate tables.

Each takes the tables by name and the analysis parameters. Ordering puts NULLs last. The names of the columns that a query
returns are fixed values.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyloom.operators.selection import ascending, descending, suppress_small
from surveyloom.plans.frames import one_segment
from surveyloom.vocabulary import AUDIT_TABLE, Settings

Tables = Mapping[str, DataFrame]


def annual_summary(tables: Tables, settings: Settings = Settings()) -> DataFrame:
    return (
        tables["gold_kpis_anuais"]
        .select(
            "ano_pesquisa",
            "total_respondentes",
            "percentual_mulheres",
            "percentual_seniores",
            "percentual_remoto",
            "percentual_sql",
            "percentual_python",
            "percentual_ia",
            "ia_elegiveis_validos",
            "ia_respostas_contraditorias",
        )
        .orderBy(ascending("ano_pesquisa"))
    )


def market_by_title(tables: Tables, settings: Settings = Settings()) -> DataFrame:
    cells = suppress_small(tables["gold_mercado_profissionais"], "respondentes", settings.min_cell)
    return cells.select(
        "ano_pesquisa",
        "cargo_padronizado",
        "senioridade",
        "respondentes",
        "denominador_ano",
        "percentual_ano",
    ).orderBy(ascending("ano_pesquisa"), descending("respondentes"))


def pay_by_seniority(tables: Tables, settings: Settings = Settings()) -> DataFrame:
    cells = one_segment(tables, "gold_remuneracao", "senioridade", "dimensao_tipo")
    return (
        suppress_small(cells, "respondentes_ponto_medio", settings.min_cell)
        .select(
            "ano_pesquisa",
            F.col("dimensao_valor").alias("senioridade"),
            F.col("respondentes_ponto_medio").alias("n"),
            "salario_medio_aproximado",
            "faixa_mediana_ordem",
        )
        .orderBy(ascending("ano_pesquisa"), descending("salario_medio_aproximado"))
    )


def pay_by_title(tables: Tables, settings: Settings = Settings()) -> DataFrame:
    """Pay by title in the focus year."""
    cells = one_segment(tables, "gold_remuneracao", "cargo", "dimensao_tipo")
    in_focus = cells.filter(F.col("ano_pesquisa") == settings.focus_year)
    return (
        suppress_small(in_focus, "respondentes_ponto_medio", settings.min_cell)
        .select(
            F.col("dimensao_valor").alias("cargo"),
            F.col("respondentes_ponto_medio").alias("n"),
            "salario_medio_aproximado",
            "faixa_mediana_ordem",
        )
        .orderBy(descending("salario_medio_aproximado"))
    )


def diversity(tables: Tables, settings: Settings = Settings()) -> DataFrame:
    cells = suppress_small(tables["gold_diversidade"], "respondentes", settings.min_cell)
    return cells.select(
        "ano_pesquisa",
        "genero",
        "cargo_padronizado",
        "senioridade",
        "respondentes",
        "denominador_segmento",
        "percentual_segmento",
        "gestores",
        "respondentes_com_salario",
        "salario_medio_aproximado",
    ).orderBy(
        ascending("ano_pesquisa"),
        ascending("cargo_padronizado"),
        ascending("senioridade"),
        descending("respondentes"),
    )


def technology_overall(tables: Tables, settings: Settings = Settings()) -> DataFrame:
    """Every technology of every edition; one that an edition did not ask about has nobody eligible and a NULL share."""
    return (
        one_segment(tables, "gold_tecnologias", "geral")
        .select(
            "ano_pesquisa",
            "tecnologia",
            F.col("respondentes_elegiveis").alias("n"),
            "adotantes",
            "percentual_adocao",
        )
        .orderBy(ascending("tecnologia"), ascending("ano_pesquisa"))
    )


def technology_by_title(tables: Tables, settings: Settings = Settings()) -> DataFrame:
    """Technology adoption by title in the focus year."""
    cells = one_segment(tables, "gold_tecnologias", "cargo")
    in_focus = cells.filter(F.col("ano_pesquisa") == settings.focus_year)
    return (
        suppress_small(in_focus, "respondentes_elegiveis", settings.min_cell)
        .select(
            "tecnologia",
            F.col("segmento_valor").alias("cargo"),
            F.col("respondentes_elegiveis").alias("n"),
            "adotantes",
            "percentual_adocao",
        )
        .orderBy(ascending("tecnologia"), descending("percentual_adocao"))
    )


def ai_overall(tables: Tables, settings: Settings = Settings()) -> DataFrame:
    return (
        one_segment(tables, "gold_inteligencia_artificial", "geral")
        .select(
            "ano_pesquisa",
            F.col("respondentes_validos").alias("n"),
            "adotantes_ia",
            "percentual_adocao_ia",
            "uso_gratuito",
            "uso_pago_proprio",
            "uso_pago_empresa",
            "uso_copilot",
        )
        .orderBy(ascending("ano_pesquisa"))
    )


def ai_by_seniority(tables: Tables, settings: Settings = Settings()) -> DataFrame:
    cells = one_segment(tables, "gold_inteligencia_artificial", "senioridade")
    return (
        suppress_small(cells, "respondentes_validos", settings.min_cell)
        .select(
            "ano_pesquisa",
            F.col("segmento_valor").alias("senioridade"),
            F.col("respondentes_validos").alias("n"),
            "percentual_adocao_ia",
        )
        .orderBy(ascending("ano_pesquisa"), descending("percentual_adocao_ia"))
    )


def region_work_model(tables: Tables, settings: Settings = Settings()) -> DataFrame:
    cells = suppress_small(tables["gold_regiao_trabalho"], "respondentes", settings.min_cell)
    return cells.select(
        "ano_pesquisa",
        "regiao_moradia",
        "modelo_trabalho_padronizado",
        "senioridade",
        "respondentes",
        F.col("respondentes_ponto_medio").alias("n_salario"),
        "salario_medio_aproximado",
        F.col("respondentes_validos_ia").alias("n_ia"),
        "percentual_adocao_ia",
    ).orderBy(ascending("ano_pesquisa"), ascending("regiao_moradia"), descending("respondentes"))


def conform_audit(tables: Tables, settings: Settings = Settings()) -> DataFrame:
    """What each edition lost, kept and could not read on its way to the conformed table."""
    return (
        tables[AUDIT_TABLE]
        .select(
            "ano",
            "etapa",
            "registros_entrada",
            "registros_saida",
            "registros_descartados",
            "duplicidades_excedentes_preservadas",
            "ids_nulos",
            "regioes_invalidas",
            "senioridades_invalidas",
            "status",
        )
        .orderBy(ascending("ano"))
    )


KPI_QUERIES = {
    "annual_summary": annual_summary,
    "market_by_title": market_by_title,
    "pay_by_seniority": pay_by_seniority,
    "pay_by_title": pay_by_title,
    "diversity": diversity,
    "technology_overall": technology_overall,
    "technology_by_title": technology_by_title,
    "ai_overall": ai_overall,
    "ai_by_seniority": ai_by_seniority,
    "region_work_model": region_work_model,
    "conform_audit": conform_audit,
}
