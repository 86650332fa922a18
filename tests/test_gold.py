"""Invariants of the aggregate tables, NULL and empty handling, and chart rules."""

import pytest
from pyspark.sql import functions as F

from surveyloom.fixtures.respondents import FIXTURE_SETTINGS
from surveyloom.functions import money_label
from surveyloom.plans import gold
from surveyloom.plans.charts import CHARTS, build_charts, gender_share_stack, market_top, pay_top, work_model_share
from surveyloom.plans.extracts import build_extracts
from surveyloom.plans.kpi_queries import KPI_QUERIES, technology_overall
from surveyloom.vocabulary import SILVER_TYPES, Settings

COLUMNS = ", ".join(f"{name} {kind}" for name, kind in SILVER_TYPES.items())


@pytest.fixture(scope="module")
def tables(silver):
    return gold.build_gold(silver, FIXTURE_SETTINGS)


@pytest.mark.parametrize("name", list(gold.GOLD_BUILDERS))
def test_builders_on_no_rows(spark, name):
    empty = spark.createDataFrame([], COLUMNS)
    assert gold.build_gold(empty)[name].count() == 0


@pytest.mark.parametrize("name", sorted(CHARTS))
def test_charts_on_no_rows(spark, name):
    empty = spark.createDataFrame([], COLUMNS)
    assert build_charts(build_extracts(gold.build_gold(empty), ordered=False))[name].count() == 0


def test_market_counts_every_titled_row_and_shares_add_up(silver, tables):
    cells = tables["gold_mercado_profissionais"]
    titled = silver.filter("cargo_padronizado IS NOT NULL").count()
    assert cells.agg(F.sum("respondentes")).first()[0] == titled
    sums = cells.groupBy("ano_pesquisa").agg(F.sum("percentual_ano").alias("s"), F.count("*").alias("n"))
    assert sums.filter(F.abs(F.col("s") - 100) > F.col("n") * 0.005).count() == 0


def test_market_forms_agree(silver, rows):
    window, join = gold.market_structure(silver), gold.market_structure_joined(silver)
    assert rows(window) == rows(join, *window.columns)


def test_a_row_without_edition_has_no_market_share(spark, silver, rows):
    lost = silver.limit(5).withColumn("ano_pesquisa", F.lit(None).cast("int"))
    both = silver.unionByName(lost)
    assert rows(gold.market_structure(both)) == rows(gold.market_structure(silver))


def test_adopters_never_exceed_eligible(tables):
    assert tables["gold_tecnologias"].filter("adotantes > respondentes_elegiveis").count() == 0
    assert tables["gold_inteligencia_artificial"].filter("adotantes_ia > respondentes_validos").count() == 0
    assert tables["gold_regiao_trabalho"].filter("adotantes_ia > respondentes_validos_ia").count() == 0


def test_diversity_shares_within_segment(tables):
    key = ["ano_pesquisa", "cargo_padronizado", "senioridade"]
    sums = tables["gold_diversidade"].groupBy(*key).agg(
        F.sum("respondentes").alias("n"), F.max("denominador_segmento").alias("total")
    )
    assert sums.filter("n <> total").count() == 0
    assert sums.filter("senioridade IS NULL").count() > 0


def test_technology_nobody_was_asked_about_keeps_its_cell(tables):
    cells = tables["gold_tecnologias"].filter("ano_pesquisa = 1997 AND tecnologia = 'AWS' AND segmento_tipo = 'geral'")
    row = cells.first()
    assert (row.respondentes_elegiveis, row.adotantes, row.percentual_adocao) == (0, 0, None)
    shown = technology_overall(tables).filter("ano_pesquisa = 1997 AND tecnologia = 'AWS'").first()
    assert (shown.n, shown.percentual_adocao) == (0, None)


def test_ai_starts_with_the_given_edition(tables, silver):
    years = [r[0] for r in tables["gold_inteligencia_artificial"].select("ano_pesquisa").distinct().collect()]
    assert min(years) == 1996
    assert gold.ai_adoption(silver).count() == 0


def test_kpi_queries_put_nulls_last(tables):
    frame = KPI_QUERIES["diversity"](tables, Settings(focus_year=2001, min_cell=1))
    seen = {}
    for row in frame.collect():
        seen.setdefault((row.ano_pesquisa, row.cargo_padronizado), []).append(row.senioridade)
    for levels in seen.values():
        assert levels[-1] is None
        known = [level for level in levels if level is not None]
        assert known == sorted(known)


def _counts(spark, column, data):
    return spark.createDataFrame(data, f"ano_pesquisa int, {column} string, respondentes bigint")


def test_genders_keep_unlisted_after_listed(spark):
    data = _counts(spark, "genero", [(1, "Zeta", 3), (1, "Masculino", 60), (1, "Feminino", 37), (1, None, 50)])
    result = [(r.genero, r.percentual, r.base, r.rotulo) for r in gender_share_stack({"diversidade": data}).collect()]
    assert result == [
        ("Feminino", 37.0, 0.0, "37,0%"),
        ("Masculino", 60.0, 37.0, "60,0%"),
        ("Zeta", 3.0, 97.0, None),
    ]


def test_undrawn_work_models_stay_in_the_denominator(spark):
    data = _counts(spark, "modelo_trabalho_padronizado", [(1, "Remoto", 50), (1, "Outro", 25), (1, "Presencial", 25)])
    drawn = work_model_share({"trabalho": data}).collect()
    result = [(r.modelo_trabalho_padronizado, r.percentual, r.base) for r in drawn]
    assert result == [("Remoto", 50.0, 0.0), ("Presencial", 25.0, 50.0)]


def test_market_top_is_of_the_latest_edition(spark):
    titles = [(2, f"t{i:02d}", 100 + i) for i in range(12)] + [(1, "old", 9999), (2, "t11", 1000), (2, None, 5)]
    result = market_top({"mercado": _counts(spark, "cargo_padronizado", titles)}).collect()
    assert [r.cargo_padronizado for r in result] == ["t04", "t05", "t06", "t07", "t08", "t09", "t10", "t11"]
    assert result[-1].percentual == 1111 / 2271 * 100
    assert result[-1].rotulo == "1.111  |  48,9%"
    assert result[0].rotulo == "104  |  4,6%"


def test_market_top_of_an_edition_without_counts(spark):
    data = _counts(spark, "cargo_padronizado", [(1, "old", 9), (2, "a", None), (2, None, 5), (2, "b", 0)])
    shown = [(r.cargo_padronizado, r.percentual) for r in market_top({"mercado": data}).collect()]
    assert sorted(shown) == [("a", None), ("b", 0.0)]


def test_a_year_without_counts_has_no_shares(spark):
    data = _counts(spark, "genero", [(1, "Feminino", 0), (2, "Feminino", 1)])
    assert [(r.percentual, r.base) for r in gender_share_stack({"diversidade": data}).collect()] == [(None, None), (100.0, 0.0)]
    assert market_top({"mercado": _counts(spark, "cargo_padronizado", [(1, "a", 0)])}).first().percentual is None


def test_pay_top_needs_fifty_midpoints(spark):
    data = spark.createDataFrame(
        [(2024, "a", 49, 9000.0), (2024, "b", 50, 8000.0), (2024, "c", 51, 12345.0)],
        "ano_pesquisa int, cargo_padronizado string, respondentes_ponto_medio bigint, salario_medio_aproximado double",
    )
    result = [(r.cargo_padronizado, r.rotulo) for r in pay_top({"remuneracao_cargo": data}).collect()]
    assert result == [("b", "R$ 8,0 mil  (n=50)"), ("c", "R$ 12,3 mil  (n=51)")]


def test_charts_without_their_extract_are_left_out(spark, tables):
    extracts = dict(build_extracts(tables, FIXTURE_SETTINGS, ordered=False))
    del extracts["regiao_trabalho"], extracts["ia_senioridade"]
    assert set(CHARTS) - set(build_charts(extracts)) == {"region_model_matrix", "ai_seniority_matrix"}
    extracts["ia_geral"] = extracts["ia_geral"].drop("uso_copilot")
    assert "ai_access_mentions" not in build_charts(extracts)


def test_charts_accept_text_measures(spark):
    data = spark.createDataFrame(
        [("2023", "1234", "45.5", "x", "7")],
        "ano_pesquisa string, total_respondentes string, percentual_remoto string, "
        "percentual_mulheres string, percentual_ia string",
    )
    cards = {r.indicador: r.valor for r in CHARTS["scorecard_latest"]({"kpis": data}).collect()}
    assert cards == {
        "Respondentes": "1.234",
        "Trabalho remoto": "45,5%",
        "Mulheres na amostra": None,
        "Uso profissional de IA": "7,0%",
    }


def test_money_label_is_in_thousands(spark):
    assert spark.range(1).select(money_label(F.lit(1234567.0))).first()[0] == "R$ 1.234,6 mil"
