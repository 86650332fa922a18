"""Chart datasets: the table behind each figure, with positions and label text."""

from __future__ import annotations

from collections.abc import Mapping
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveyloom.functions import coerce_numbers, money_label, percent_label, pt_count
from surveyloom.operators.matrix import above_median, pivot_mean, row_share, total_before
from surveyloom.operators.ranking import latest_cells, latest_row, top_k
from surveyloom.operators.selection import display_rank, has_columns, keep_ordered, known, suppress_small
from surveyloom.operators.totals import window_total
from surveyloom.plans.frames import Frames
from surveyloom.vocabulary import (
    AI_ACCESS_LABELS,
    GENDERS,
    SENIORITIES,
    TREND_TECHNOLOGIES,
    WORK_MODELS,
    Settings,
)

Extracts = Mapping[str, DataFrame]
YEAR = "ano_pesquisa"


def _year() -> Column:
    return F.col(YEAR).cast("int").alias(YEAR)


def scorecard_latest(data: Extracts, settings: Settings = Settings()) -> DataFrame:
    """Four headline indicators of the latest edition."""
    shares = ["percentual_remoto", "percentual_mulheres", "percentual_ia"]
    frame = coerce_numbers(data["kpis"], [YEAR, "total_respondentes", *shares])
    row = latest_row(frame.select(YEAR, "total_respondentes", *shares))
    # Indicator labels.
    indicators = {
        "Respondentes": pt_count(F.col("total_respondentes")),
        "Trabalho remoto": percent_label(F.col("percentual_remoto")),
        "Mulheres na amostra": percent_label(F.col("percentual_mulheres")),
        "Uso profissional de IA": percent_label(F.col("percentual_ia")),
    }
    cards = [
        F.struct(F.lit(i).alias("ordem"), F.lit(label).alias("indicador"), text.alias("valor"))
        for i, (label, text) in enumerate(indicators.items(), start=1)
    ]
    return row.select(_year(), F.inline(F.array(*cards)))


def _share_stack(frame: DataFrame, category: str, order: tuple[str, ...], label_from: float, others: bool) -> DataFrame:
    """Bars stacked to 100 %: share, start of the segment, and a label where it fits.

    Shares refer to all categories, also to those that are not drawn. The start is taken from
    the counts below, which are exact, and not from a running sum of rounded shares.
    """
    counts = (
        known(coerce_numbers(frame, [YEAR, "respondentes"]), YEAR, category)
        .groupBy(YEAR, category)
        .agg(F.sum("respondentes").alias("respondentes"))
        .withColumns(
            {
                "percentual": row_share("respondentes", YEAR),
                "total_ano": window_total("respondentes", [YEAR]),
                "ordem": display_rank(category, order),
            }
        )
    )
    drawn = counts if others else counts.filter(F.col(category).isin(*order))
    below = total_before("respondentes", YEAR, ["ordem", category])
    return (
        drawn.withColumn("base", below / F.nullif(F.col("total_ano"), F.lit(0)) * 100)
        .select(
            _year(),
            category,
            "ordem",
            "respondentes",
            "percentual",
            "base",
            F.when(F.col("percentual") >= label_from, percent_label(F.col("percentual"))).alias("rotulo"),
        )
        .orderBy(YEAR, "ordem", category)
    )


def gender_share_stack(data: Extracts, settings: Settings = Settings()) -> DataFrame:
    """Genders among respondents with a title; unlisted genders follow the listed ones."""
    return _share_stack(data["diversidade"], "genero", GENDERS, label_from=4, others=True)


def work_model_share(data: Extracts, settings: Settings = Settings()) -> DataFrame:
    """Work models among respondents with a region; unlisted models count but are not drawn."""
    return _share_stack(
        data["trabalho"], "modelo_trabalho_padronizado", WORK_MODELS, label_from=7, others=False
    )


def market_top(data: Extracts, settings: Settings = Settings()) -> DataFrame:
    """Largest titles of the latest edition, with their share of all its respondents; a NULL title counts, but is not drawn."""
    frame = coerce_numbers(data["mercado"], [YEAR, "respondentes"])
    titles = frame.groupBy(YEAR, "cargo_padronizado").agg(F.sum("respondentes").alias("respondentes"))
    newest = latest_cells(titles, "respondentes").withColumn("total_ano", window_total("respondentes", [YEAR]))
    share = F.col("respondentes") / F.nullif(F.col("total_ano"), F.lit(0)) * 100
    labelled = known(newest, "cargo_padronizado").select(
        _year(),
        "cargo_padronizado",
        "respondentes",
        share.alias("percentual"),
        F.concat(pt_count(F.col("respondentes")), F.lit("  |  "), percent_label(share)).alias("rotulo"),
    )
    return top_k(labelled, "respondentes", "cargo_padronizado", settings.top)


def pay_top(data: Extracts, settings: Settings = Settings()) -> DataFrame:
    """Best-paid titles among those with enough known midpoints."""
    n, pay = "respondentes_ponto_medio", "salario_medio_aproximado"
    frame = coerce_numbers(data["remuneracao_cargo"], [YEAR, n, pay])
    shown = suppress_small(frame, n, settings.min_pay_cell).select(
        "cargo_padronizado",
        n,
        pay,
        F.concat(
            money_label(F.col(pay)), F.lit("  (n="), F.col(n).cast("long").cast("string"), F.lit(")")
        ).alias("rotulo"),
    )
    return top_k(known(shown, pay), pay, "cargo_padronizado", settings.top)


def _trend(frame: DataFrame, series: str, order: tuple[str, ...], measure: str, label: Column) -> DataFrame:
    points = keep_ordered(coerce_numbers(frame, [YEAR, measure]), series, order)
    return points.select(_year(), series, "ordem", measure, label.alias("rotulo")).orderBy("ordem", YEAR)


def pay_progression(data: Extracts, settings: Settings = Settings()) -> DataFrame:
    """Mean pay per edition, one line per seniority."""
    pay = "salario_medio_aproximado"
    return _trend(data["remuneracao_senioridade"], "senioridade", SENIORITIES, pay, money_label(F.col(pay)))


def technology_trend(data: Extracts, settings: Settings = Settings()) -> DataFrame:
    """Adoption per edition, one line per tracked technology."""
    share = "percentual_adocao"
    return _trend(data["tecnologias"], "tecnologia", TREND_TECHNOLOGIES, share, percent_label(F.col(share)))


def ai_yearly(data: Extracts, settings: Settings = Settings()) -> DataFrame:
    """AI adoption per edition, labelled with its number of valid answers."""
    share, n = "percentual_adocao_ia", "respondentes_validos"
    frame = coerce_numbers(data["ia_geral"], [YEAR, share, n])
    label = F.concat(percent_label(F.col(share)), F.lit("\nn="), pt_count(F.col(n)))
    return frame.select(_year(), share, n, label.alias("rotulo")).orderBy(YEAR)


def region_model_matrix(data: Extracts, settings: Settings = Settings()) -> DataFrame:
    """Pay by region and work model; cells above the median of the matrix are marked."""
    pay, keys = "salario_medio_aproximado", ["regiao_moradia", "modelo_trabalho_padronizado"]
    cells = known(coerce_numbers(data["regiao_trabalho"], [pay]), *keys).groupBy(*keys).agg(F.avg(pay).alias(pay))
    return cells.select(
        *keys,
        pay,
        money_label(F.col(pay)).alias("rotulo"),
        above_median(cells, pay).alias("acima_mediana"),
    ).orderBy(*keys)


def ai_access_mentions(data: Extracts, settings: Settings = Settings()) -> DataFrame:
    """Access types stacked per edition. Several answers were allowed: these are not shares."""
    counts = list(AI_ACCESS_LABELS)
    frame = coerce_numbers(data["ia_geral"], [YEAR, *counts])
    labels = list(AI_ACCESS_LABELS.values())
    labelled = frame.select(YEAR, *[F.col(c).alias(AI_ACCESS_LABELS[c]) for c in counts]).na.fill(0, labels)
    long = labelled.unpivot([YEAR], labels, "tipo_acesso", "mencoes")
    ranked = long.withColumn("ordem", display_rank("tipo_acesso", labels))
    return ranked.select(
        _year(), "tipo_acesso", "ordem", "mencoes", total_before("mencoes", YEAR, ["ordem"]).alias("base")
    ).orderBy(YEAR, "ordem")


def ai_seniority_matrix(data: Extracts, settings: Settings = Settings()) -> DataFrame:
    """AI adoption per edition and seniority, as a cross table with a label per bar."""
    share = "percentual_adocao_ia"
    frame = coerce_numbers(data["ia_senioridade"], [YEAR, share])
    table = pivot_mean(frame, YEAR, "senioridade", SENIORITIES, share)
    # These labels keep the decimal point.
    labels = [F.concat(F.format_number(s, 1), F.lit("%")).alias(f"rotulo_{s}") for s in SENIORITIES]
    return table.select(_year(), *SENIORITIES, *labels).orderBy(YEAR)


CHARTS = {
    "scorecard_latest": scorecard_latest,
    "gender_share_stack": gender_share_stack,
    "market_top8": market_top,
    "pay_top8_min50": pay_top,
    "pay_progression": pay_progression,
    "technology_trend": technology_trend,
    "ai_yearly": ai_yearly,
    "work_model_share": work_model_share,
    "region_model_matrix": region_model_matrix,
    "ai_access_mentions": ai_access_mentions,
    "ai_seniority_matrix": ai_seniority_matrix,
}

# Charts that an input set may lack: extract and columns without which they are left out.
OPTIONAL_CHARTS = {
    "region_model_matrix": (
        "regiao_trabalho",
        ("regiao_moradia", "modelo_trabalho_padronizado", "salario_medio_aproximado"),
    ),
    "ai_access_mentions": ("ia_geral", tuple(AI_ACCESS_LABELS)),
    "ai_seniority_matrix": ("ia_senioridade", (YEAR, "senioridade", "percentual_adocao_ia")),
}


def build_charts(data: Extracts, settings: Settings = Settings()) -> Frames:
    """Every chart dataset that the given extracts allow."""
    missing = {
        chart
        for chart, (extract, columns) in OPTIONAL_CHARTS.items()
        if not has_columns(data.get(extract), columns)
    }
    return Frames({name: partial(build, data, settings) for name, build in CHARTS.items() if name not in missing})
