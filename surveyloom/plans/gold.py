"""The seven aggregate tables, from the conformed row-level table.

Every builder is one scan with a map-side combine: what is shuffled are aggregate cells, whose
number depends on the categories and not on the rows. A hot category is therefore harmless.
All seven tables can also be rolled up from one cube of their finest cells (`BASE`), so that a run scans its rows once.

The names of the columns of a table are fixed values, as published.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveyloom.functions import percent
from surveyloom.functions.states import ROWS, Cells, Rows
from surveyloom.operators.median import aggregate_with_median
from surveyloom.operators.segments import segment_aggregate
from surveyloom.operators.selection import known
from surveyloom.operators.totals import join_total, window_total, with_share
from surveyloom.plans.frames import Frames
from surveyloom.vocabulary import (
    AI_ACCESS_COUNTS,
    AI_SEGMENTS,
    PAY_SEGMENTS,
    TECHNOLOGIES,
    TECHNOLOGY_SEGMENTS,
    Settings,
)

YEAR = "ano_pesquisa"
TITLE = "cargo_padronizado"
LEVEL = "senioridade"
GENDER = "genero"
REGION = "regiao_moradia"
MODEL = "modelo_trabalho_padronizado"
BAND = "salario_ordem"
MIDPOINT = "salario_ponto_medio"
AI = "usa_ia_generativa"


@dataclass(frozen=True)
class Rate:
    """A share of the annual KPIs: hits among those who answered ``column``."""

    column: str
    hit: str | int
    answered: str
    hits: str
    percent: str

    def counts(self, measure: Rows = ROWS) -> list[Column]:
        return [
            measure.answered(self.column).alias(self.answered),
            measure.hits(self.column, self.hit).alias(self.hits),
        ]


# The published names of the annual shares.
ANNUAL_RATES = (
    Rate(GENDER, "Feminino", "genero_respondentes", "mulheres", "percentual_mulheres"),
    Rate(LEVEL, "Sênior", "senioridade_respondentes", "profissionais_seniores", "percentual_seniores"),
    Rate(MODEL, "Remoto", "modelo_trabalho_respondentes", "remotos", "percentual_remoto"),
    Rate("usa_sql", 1, "sql_elegiveis", "sql_adotantes", "percentual_sql"),
    Rate("usa_python", 1, "python_elegiveis", "python_adotantes", "percentual_python"),
    Rate(AI, 1, "ia_elegiveis_validos", "ia_adotantes", "percentual_ia"),
)


CONTRADICTED, GAPS = "flag_ia_contraditoria", "quantidade_flags_qualidade"

#: The finest cells from which every table below can be rolled up. Access types are counted among those who answered on AI.
BASE = Cells(
    dimensions=(YEAR, TITLE, LEVEL, GENDER, REGION, MODEL, "tempo_experiencia_historica", "faixa_salarial_original", BAND),
    flags={"eh_gestor": None, **dict.fromkeys(TECHNOLOGIES.values()), AI: None, **dict.fromkeys(AI_ACCESS_COUNTS, AI)},
    amounts=(MIDPOINT, CONTRADICTED, GAPS),
)


def base_cube(silver: DataFrame) -> DataFrame:
    """Mergeable counts and sums of the finest cells: one scan, and a cell with a third of all rows is one row per task."""
    return BASE.build(silver)


def annual_kpis(silver: DataFrame, measure: Rows = ROWS) -> DataFrame:
    """One row per edition: totals, eligible answers, hits and shares."""
    counts = [count for rate in ANNUAL_RATES for count in rate.counts(measure)]
    yearly = silver.groupBy(YEAR).agg(
        measure.size().alias("total_respondentes"),
        *counts,
        measure.total(CONTRADICTED).alias("ia_respostas_contraditorias"),
        measure.total(GAPS).alias("flags_qualidade"),
    )
    return yearly.withColumns({r.percent: percent(r.hits, r.answered) for r in ANNUAL_RATES})


def market_cells(silver: DataFrame, measure: Rows = ROWS) -> DataFrame:
    """Respondents per title and seniority; a row without an edition has no total to share."""
    return known(silver, TITLE, YEAR).groupBy(YEAR, TITLE, LEVEL).agg(measure.size().alias("respondentes"))


def market_structure(silver: DataFrame, measure: Rows = ROWS) -> DataFrame:
    """Titled respondents by title and seniority, and their share of the edition.

    The edition total is a window over the cells. A query that does not read it drops the
    window, where a join would have to stay.
    """
    cells = market_cells(silver, measure)
    totalled = cells.withColumn("denominador_ano", window_total("respondentes", [YEAR]))
    return with_share(totalled, "respondentes", "denominador_ano", "percentual_ano")


def market_structure_joined(silver: DataFrame, measure: Rows = ROWS) -> DataFrame:
    """The same table with the edition totals joined on: no task gets all cells of an edition, however many titles there are."""
    totalled = join_total(market_cells(silver, measure), [YEAR], "respondentes", "denominador_ano")
    return with_share(totalled, "respondentes", "denominador_ano", "percentual_ano")


def pay_by_dimension(
    silver: DataFrame, segments: Mapping[str, str] = PAY_SEGMENTS, measure: Rows = ROWS
) -> DataFrame:
    """Mean midpoint and median band for each value of each dimension."""
    keys = [YEAR, "dimensao_tipo", "dimensao_valor"]
    histogram = segment_aggregate(
        silver,
        segments,
        keys=[YEAR],
        inputs=measure.inputs(BAND, MIDPOINT),
        measures=[
            measure.size().alias("linhas"),
            measure.answered(BAND).alias("com_faixa"),
            measure.answered(MIDPOINT).alias("com_ponto_medio"),
            measure.total(MIDPOINT).alias("soma_pontos"),
        ],
        type_name="dimensao_tipo",
        value_name="dimensao_valor",
        extra_keys=[BAND],
    )
    midpoints = F.nullif(F.sum("com_ponto_medio"), F.lit(0))
    return aggregate_with_median(
        histogram,
        keys,
        ordinal=BAND,
        size="linhas",
        measures=[
            F.sum("com_faixa").alias("respondentes_faixa_valida"),
            F.sum("com_ponto_medio").alias("respondentes_ponto_medio"),
            F.round(F.sum("soma_pontos") / midpoints, 2).alias("salario_medio_aproximado"),
        ],
        name="faixa_mediana_ordem",
    )


def diversity_cells(silver: DataFrame, measure: Rows = ROWS) -> DataFrame:
    """Gender within title and seniority, among those with a gender and a title."""
    cells = (
        known(silver, GENDER, TITLE)
        .groupBy(YEAR, GENDER, TITLE, LEVEL)
        .agg(
            measure.size().alias("respondentes"),
            measure.answered(BAND).alias("respondentes_com_salario"),
            measure.mean(MIDPOINT).alias("salario_medio_aproximado"),
            measure.hits("eh_gestor").alias("gestores"),
        )
    )
    total = window_total("respondentes", [YEAR, TITLE, LEVEL])
    totalled = cells.withColumn("denominador_segmento", total)
    return with_share(totalled, "respondentes", "denominador_segmento", "percentual_segmento")


def technology_adoption(
    silver: DataFrame,
    technologies: Mapping[str, str] = TECHNOLOGIES,
    segments: Mapping[str, str | None] = TECHNOLOGY_SEGMENTS,
    measure: Rows = ROWS,
) -> DataFrame:
    """Adoption of each technology overall and by segment.

    The flags are counted side by side and the small result is unpivoted, so a row is expanded
    once per segment and not once per segment and technology. A technology that nobody was
    asked about keeps its cell, with 0 eligible and a NULL share.
    """
    flags = list(technologies.values())
    counted = [measure.answered(f).alias(f"n_{f}") for f in flags] + [measure.mentions(f).alias(f"hits_{f}") for f in flags]
    cells = segment_aggregate(silver, segments, keys=[YEAR], inputs=measure.inputs(*flags), measures=counted)
    pairs = [
        F.struct(
            F.lit(label).alias("tecnologia"),
            F.col(f"n_{flag}").alias("respondentes_elegiveis"),
            F.col(f"hits_{flag}").alias("adotantes"),
        )
        for label, flag in technologies.items()
    ]
    key = [YEAR, "segmento_tipo", "segmento_valor"]
    long = cells.select(*key, F.inline(F.array(*pairs)))
    return with_share(long, "adotantes", "respondentes_elegiveis", "percentual_adocao").select(
        YEAR,
        "tecnologia",
        "segmento_tipo",
        "segmento_valor",
        "respondentes_elegiveis",
        "adotantes",
        "percentual_adocao",
    )


def ai_adoption(
    silver: DataFrame,
    settings: Settings = Settings(),
    segments: Mapping[str, str | None] = AI_SEGMENTS,
    measure: Rows = ROWS,
) -> DataFrame:
    """Generative-AI adoption and access types, in the editions that asked about it."""
    asked = measure.answering(silver, AI).filter(F.col(YEAR) >= settings.ai_since)
    cells = segment_aggregate(
        asked,
        segments,
        keys=[YEAR],
        inputs=measure.inputs(AI, *AI_ACCESS_COUNTS),
        measures=[
            measure.answered(AI).alias("respondentes_validos"),
            measure.total(AI).cast("long").alias("adotantes_ia"),
            *[measure.mentions(flag, AI).alias(name) for flag, name in AI_ACCESS_COUNTS.items()],
        ],
    )
    return with_share(cells, "adotantes_ia", "respondentes_validos", "percentual_adocao_ia").select(
        YEAR,
        "segmento_tipo",
        "segmento_valor",
        "respondentes_validos",
        "adotantes_ia",
        "percentual_adocao_ia",
        *AI_ACCESS_COUNTS.values(),
    )


def region_work(silver: DataFrame, measure: Rows = ROWS) -> DataFrame:
    """Region by work model and seniority: size, pay and AI adoption."""
    cells = (
        known(silver, REGION)
        .groupBy(YEAR, REGION, MODEL, LEVEL)
        .agg(
            measure.size().alias("respondentes"),
            measure.answered(MIDPOINT).alias("respondentes_ponto_medio"),
            measure.mean(MIDPOINT).alias("salario_medio_aproximado"),
            measure.hits(AI).alias("adotantes_ia"),
            measure.answered(AI).alias("respondentes_validos_ia"),
        )
    )
    return with_share(cells, "adotantes_ia", "respondentes_validos_ia", "percentual_adocao_ia")


# Table names in the catalog.
GOLD_BUILDERS = {
    "gold_kpis_anuais": lambda silver, settings, measure=ROWS: annual_kpis(silver, measure),
    "gold_mercado_profissionais": lambda silver, settings, measure=ROWS: market_structure(silver, measure),
    "gold_remuneracao": lambda silver, settings, measure=ROWS: pay_by_dimension(silver, measure=measure),
    "gold_diversidade": lambda silver, settings, measure=ROWS: diversity_cells(silver, measure),
    "gold_tecnologias": lambda silver, settings, measure=ROWS: technology_adoption(silver, measure=measure),
    "gold_inteligencia_artificial": lambda silver, settings, measure=ROWS: ai_adoption(silver, settings, measure=measure),
    "gold_regiao_trabalho": lambda silver, settings, measure=ROWS: region_work(silver, measure),
}


# Tables of several segmentations, built for one of them: the others would be expanded and thrown away.
GOLD_SEGMENTS = {
    "gold_remuneracao": lambda silver, settings, label: pay_by_dimension(silver, {label: PAY_SEGMENTS[label]}),
    "gold_tecnologias": lambda silver, settings, label: technology_adoption(
        silver, segments={label: TECHNOLOGY_SEGMENTS[label]}
    ),
    "gold_inteligencia_artificial": lambda silver, settings, label: ai_adoption(
        silver, settings, {label: AI_SEGMENTS[label]}
    ),
}


def exact_pay(cube: DataFrame, keys: list[str], settings: Settings = Settings()) -> DataFrame:
    """Mean pay of the focus year by `keys`: the sum of all known midpoints by their number, rounded once to six places."""
    cells = known(cube, *keys).filter(F.col(YEAR) == settings.focus_year).groupBy(*keys)
    sums = cells.agg(BASE.answered(MIDPOINT).alias("respondentes_ponto_medio"), BASE.total(MIDPOINT).alias("_soma"))
    mean = F.round(F.col("_soma") / F.nullif(F.col("respondentes_ponto_medio"), F.lit(0)), 6)
    return sums.select(*keys, "respondentes_ponto_medio", mean.alias("salario_medio_exato"))


def gold_from_cube(cube: DataFrame, settings: Settings = Settings()) -> Frames:
    """The seven tables, rolled up from the cells of `base_cube`. Edition totals are joined on, so any number of cells is spread."""
    builders = {**GOLD_BUILDERS, "gold_mercado_profissionais": lambda cells, _, measure: market_structure_joined(cells, measure)}
    return Frames({name: partial(build, cube, settings, BASE) for name, build in builders.items()})


def build_gold(silver: DataFrame, settings: Settings = Settings()) -> Frames:
    return Frames(
        {name: partial(build, silver, settings) for name, build in GOLD_BUILDERS.items()},
        {name: partial(build, silver, settings) for name, build in GOLD_SEGMENTS.items()},
    )
