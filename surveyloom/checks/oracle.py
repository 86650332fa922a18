"""The registered queries in plain SQL, written independently of the DataFrame code.

Segment tables are one UNION ALL branch per segment, medians are discrete quantiles, and every
statement starts from the respondent table derived from the base tables.
"""

from __future__ import annotations

from surveyloom.fixtures.respondents import RARE_SENIORITIES, VARIATIONS

FOCUS = 2001
AI_SINCE = 1996

LINE_FLAGS = """
li AS (
  SELECT l_orderkey,
    MAX(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS sql_,
    MAX(CASE WHEN l_discount >= CAST(0.05 AS DOUBLE) THEN 1 ELSE 0 END) AS python_,
    MAX(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) AS aws_,
    MAX(CASE WHEN l_quantity >= 40 THEN 1 ELSE 0 END) AS azure_,
    MAX(CASE WHEN l_tax >= CAST(0.06 AS DOUBLE) THEN 1 ELSE 0 END) AS gcp_,
    MAX(CASE WHEN l_linenumber >= 5 THEN 1 ELSE 0 END) AS databricks_,
    MAX(CASE WHEN l_discount = 0 THEN 1 ELSE 0 END) AS power_bi_,
    MAX(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END) AS tableau_,
    MAX(CASE WHEN l_quantity >= 25 THEN 1 ELSE 0 END) AS ia_,
    MAX(CASE WHEN l_tax = 0 THEN 1 ELSE 0 END) AS gratuita_,
    MAX(CASE WHEN l_tax >= CAST(0.05 AS DOUBLE) THEN 1 ELSE 0 END) AS propria_,
    MAX(CASE WHEN l_discount >= CAST(0.08 AS DOUBLE) THEN 1 ELSE 0 END) AS empresa_,
    MAX(CASE WHEN l_quantity < 5 THEN 1 ELSE 0 END) AS copilot_
  FROM lineitem GROUP BY l_orderkey
)"""

RESPONDENTS = LINE_FLAGS + """,
base AS (
  SELECT o_orderkey AS id_respondente,
    CAST(year(o_orderdate) AS INT) AS ano_pesquisa,
    CASE WHEN c_custkey % 20 <> 0 THEN c_mktsegment END AS cargo_padronizado,
    CASE o_orderpriority WHEN '5-LOW' THEN 'Júnior' WHEN '3-MEDIUM' THEN 'Pleno'
      WHEN '2-HIGH' THEN 'Sênior' WHEN '1-URGENT' THEN 'Sênior' END AS senioridade,
    CASE WHEN c_custkey % 50 = 0 THEN NULL
      WHEN o_orderstatus = 'F' THEN 'Feminino' WHEN o_orderstatus = 'O' THEN 'Masculino'
      WHEN o_orderstatus = 'P' THEN 'Outro' END AS genero,
    CASE WHEN n_nationkey <> 7 THEN r_name END AS regiao_moradia,
    CASE o_orderkey % 5 WHEN 0 THEN 'Remoto' WHEN 1 THEN 'Híbrido flexível'
      WHEN 2 THEN 'Híbrido fixo' WHEN 3 THEN 'Presencial' END AS modelo_trabalho_padronizado,
    CASE c_custkey % 4 WHEN 0 THEN '0-2' WHEN 1 THEN '3-5' WHEN 2 THEN '6+' END
      AS tempo_experiencia_historica,
    CASE WHEN o_totalprice < 100000 THEN 'A' WHEN o_totalprice < 200000 THEN 'B'
      WHEN o_totalprice < 300000 THEN 'C' WHEN o_totalprice < 400000 THEN 'D' ELSE 'E' END
      AS faixa_salarial_original,
    CAST(CASE WHEN o_totalprice < 100000 THEN 1 WHEN o_totalprice < 200000 THEN 2
      WHEN o_totalprice < 300000 THEN 3 WHEN o_totalprice < 400000 THEN 4 ELSE 5 END AS INT)
      AS salario_ordem,
    CAST(CASE WHEN o_totalprice < 100000 THEN 50000 WHEN o_totalprice < 200000 THEN 150000
      WHEN o_totalprice < 300000 THEN 250000 WHEN o_totalprice < 400000 THEN 350000 END AS DOUBLE)
      AS salario_ponto_medio,
    CASE WHEN c_acctbal >= 5000 THEN 1 ELSE 0 END AS eh_gestor,
    sql_ AS usa_sql, python_ AS usa_python,
    CASE WHEN year(o_orderdate) <> 1997 THEN aws_ END AS usa_aws,
    CASE WHEN year(o_orderdate) <> 1997 THEN azure_ END AS usa_azure,
    CASE WHEN year(o_orderdate) <> 1997 THEN gcp_ END AS usa_gcp,
    databricks_ AS usa_databricks, power_bi_ AS usa_power_bi, tableau_ AS usa_tableau,
    CASE WHEN year(o_orderdate) >= 1996 THEN ia_ END AS usa_ia_generativa,
    CASE WHEN year(o_orderdate) >= 1996 THEN gratuita_ END AS ia_gratuita,
    CASE WHEN year(o_orderdate) >= 1996 THEN propria_ END AS ia_paga_propria,
    CASE WHEN year(o_orderdate) >= 1996 THEN empresa_ END AS ia_paga_empresa,
    CASE WHEN year(o_orderdate) >= 1996 THEN copilot_ END AS ia_copilot
  FROM orders
    JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey
    LEFT JOIN li ON o_orderkey = l_orderkey
),
r AS (
  SELECT *,
    CAST(CASE WHEN usa_ia_generativa = 0 AND (ia_gratuita = 1 OR ia_paga_propria = 1
      OR ia_paga_empresa = 1 OR ia_copilot = 1) THEN 1 ELSE 0 END AS INT) AS flag_ia_contraditoria,
    CAST((CASE WHEN senioridade IS NULL THEN 1 ELSE 0 END)
      + (CASE WHEN regiao_moradia IS NULL THEN 1 ELSE 0 END)
      + (CASE WHEN salario_ponto_medio IS NULL THEN 1 ELSE 0 END) AS INT) AS quantidade_flags_qualidade
  FROM base
)"""


def ratio(part: str, whole: str) -> str:
    return f"CASE WHEN {whole} > 0 THEN round(CAST({part} AS DOUBLE) / {whole} * 100, 2) END"


def pt(value: str, decimals: int = 1) -> str:
    return f"translate(format('{{:,.{decimals}f}}', CAST({value} AS DOUBLE)), ',.', '.,')"


def money(value: str) -> str:
    return f"'R$ ' || {pt(f'({value}) / 1000')} || ' mil'"


def _hits(test: str) -> str:
    return f"CAST(SUM(CASE WHEN {test} THEN 1 ELSE 0 END) AS BIGINT)"


def _flag_sum(flag: str) -> str:
    return f"CAST(SUM(COALESCE({flag}, 0)) AS BIGINT)"


# --- aggregate tables ------------------------------------------------------------------------

ANNUAL = f"""
annual_counts AS (
  SELECT ano_pesquisa,
    COUNT(*) AS total_respondentes,
    COUNT(genero) AS genero_respondentes, {_hits("genero = 'Feminino'")} AS mulheres,
    COUNT(senioridade) AS senioridade_respondentes,
    {_hits("senioridade = 'Sênior'")} AS profissionais_seniores,
    COUNT(modelo_trabalho_padronizado) AS modelo_trabalho_respondentes,
    {_hits("modelo_trabalho_padronizado = 'Remoto'")} AS remotos,
    COUNT(usa_sql) AS sql_elegiveis, {_flag_sum("usa_sql")} AS sql_adotantes,
    COUNT(usa_python) AS python_elegiveis, {_flag_sum("usa_python")} AS python_adotantes,
    COUNT(usa_ia_generativa) AS ia_elegiveis_validos,
    {_flag_sum("usa_ia_generativa")} AS ia_adotantes,
    CAST(SUM(flag_ia_contraditoria) AS BIGINT) AS ia_respostas_contraditorias,
    CAST(SUM(quantidade_flags_qualidade) AS BIGINT) AS flags_qualidade
  FROM r GROUP BY ano_pesquisa
),
annual AS (
  SELECT *,
    {ratio("mulheres", "genero_respondentes")} AS percentual_mulheres,
    {ratio("profissionais_seniores", "senioridade_respondentes")} AS percentual_seniores,
    {ratio("remotos", "modelo_trabalho_respondentes")} AS percentual_remoto,
    {ratio("sql_adotantes", "sql_elegiveis")} AS percentual_sql,
    {ratio("python_adotantes", "python_elegiveis")} AS percentual_python,
    {ratio("ia_adotantes", "ia_elegiveis_validos")} AS percentual_ia
  FROM annual_counts
)"""

MARKET = f"""
titled AS (SELECT * FROM r WHERE cargo_padronizado IS NOT NULL),
market AS (
  SELECT ano_pesquisa, cargo_padronizado, senioridade, respondentes, denominador_ano,
    {ratio("respondentes", "denominador_ano")} AS percentual_ano
  FROM (SELECT ano_pesquisa, cargo_padronizado, senioridade, COUNT(*) AS respondentes
        FROM titled GROUP BY ALL)
    JOIN (SELECT ano_pesquisa, COUNT(*) AS denominador_ano FROM titled GROUP BY ALL)
    USING (ano_pesquisa)
)"""

_PAY_DIMENSIONS = {
    "cargo": "cargo_padronizado",
    "senioridade": "senioridade",
    "regiao": "regiao_moradia",
    "modelo_trabalho": "modelo_trabalho_padronizado",
    "genero": "genero",
    "experiencia": "tempo_experiencia_historica",
}
PAY = "\npay AS (" + "\n  UNION ALL".join(
    f"""
  SELECT ano_pesquisa, '{label}' AS dimensao_tipo, {column} AS dimensao_valor,
    COUNT(salario_ordem) AS respondentes_faixa_valida,
    COUNT(salario_ponto_medio) AS respondentes_ponto_medio,
    round(AVG(salario_ponto_medio), 2) AS salario_medio_aproximado,
    CAST(quantile_disc(salario_ordem, 0.5) AS INT) AS faixa_mediana_ordem
  FROM r WHERE {column} IS NOT NULL GROUP BY ano_pesquisa, {column}"""
    for label, column in _PAY_DIMENSIONS.items()
) + "\n)"

DIVERSITY = f"""
diversity AS (
  SELECT *, {ratio("respondentes", "denominador_segmento")} AS percentual_segmento
  FROM (
    SELECT *, CAST(SUM(respondentes) OVER (PARTITION BY ano_pesquisa, cargo_padronizado, senioridade)
      AS BIGINT) AS denominador_segmento
    FROM (
      SELECT ano_pesquisa, genero, cargo_padronizado, senioridade,
        COUNT(*) AS respondentes, COUNT(salario_ordem) AS respondentes_com_salario,
        round(AVG(salario_ponto_medio), 2) AS salario_medio_aproximado,
        {_hits("eh_gestor = 1")} AS gestores
      FROM r WHERE genero IS NOT NULL AND cargo_padronizado IS NOT NULL GROUP BY 1, 2, 3, 4))
)"""

_TECH_NAMES = {
    "usa_sql": "SQL",
    "usa_python": "Python",
    "usa_aws": "AWS",
    "usa_azure": "Azure",
    "usa_gcp": "GCP",
    "usa_databricks": "Databricks",
    "usa_power_bi": "Power BI",
    "usa_tableau": "Tableau",
}
TECH_LONG = (
    "\ntech_long AS (SELECT ano_pesquisa, cargo_padronizado, senioridade, tecnologia, adotou FROM r\n"
    "  UNPIVOT INCLUDE NULLS (adotou FOR tecnologia IN ("
    + ", ".join(f"{flag} AS '{name}'" for flag, name in _TECH_NAMES.items())
    + ")))"
)
# Materialized: on little data DuckDB otherwise stops with an internal error in one statement.
TECH = (
    TECH_LONG
    + ",\ntech AS MATERIALIZED ("
    + "\n  UNION ALL".join(
        f"""
  SELECT ano_pesquisa, tecnologia, '{label}' AS segmento_tipo, {column} AS segmento_valor,
    COUNT(adotou) AS respondentes_elegiveis, {_flag_sum("adotou")} AS adotantes,
    {ratio("SUM(COALESCE(adotou, 0))", "COUNT(adotou)")} AS percentual_adocao
  FROM tech_long WHERE {column} IS NOT NULL GROUP BY ano_pesquisa, tecnologia, {column}"""
        for label, column in {
            "geral": "'Todos'",
            "cargo": "cargo_padronizado",
            "senioridade": "senioridade",
        }.items()
    )
    + "\n)"
)

AI = "\nai AS (" + "\n  UNION ALL".join(
    f"""
  SELECT ano_pesquisa, '{label}' AS segmento_tipo, {column} AS segmento_valor,
    COUNT(usa_ia_generativa) AS respondentes_validos,
    CAST(SUM(usa_ia_generativa) AS BIGINT) AS adotantes_ia,
    {ratio("SUM(usa_ia_generativa)", "COUNT(usa_ia_generativa)")} AS percentual_adocao_ia,
    {_flag_sum("ia_gratuita")} AS uso_gratuito, {_flag_sum("ia_paga_propria")} AS uso_pago_proprio,
    {_flag_sum("ia_paga_empresa")} AS uso_pago_empresa, {_flag_sum("ia_copilot")} AS uso_copilot
  FROM r WHERE ano_pesquisa >= {AI_SINCE} AND usa_ia_generativa IS NOT NULL AND {column} IS NOT NULL
  GROUP BY ano_pesquisa, {column}"""
    for label, column in {
        "geral": "'Todos'",
        "cargo": "cargo_padronizado",
        "senioridade": "senioridade",
        "regiao": "regiao_moradia",
        "modelo_trabalho": "modelo_trabalho_padronizado",
        "faixa_salarial": "faixa_salarial_original",
    }.items()
) + "\n)"

REGION = f"""
region_cells AS (
  SELECT *, {ratio("adotantes_ia", "respondentes_validos_ia")} AS percentual_adocao_ia
  FROM (
    SELECT ano_pesquisa, regiao_moradia, modelo_trabalho_padronizado, senioridade,
      COUNT(*) AS respondentes, COUNT(salario_ponto_medio) AS respondentes_ponto_medio,
      round(AVG(salario_ponto_medio), 2) AS salario_medio_aproximado,
      {_hits("usa_ia_generativa = 1")} AS adotantes_ia,
      COUNT(usa_ia_generativa) AS respondentes_validos_ia
    FROM r WHERE regiao_moradia IS NOT NULL GROUP BY 1, 2, 3, 4)
)"""

_COPIES = """
raw AS (SELECT * FROM r UNION ALL SELECT * FROM r WHERE id_respondente % 97 = 0)"""


def using(*ctes: str, select: str) -> str:
    return "WITH " + ",".join((RESPONDENTS, *ctes)) + "\n" + select


_REGION_EXTRACT = f"""
region_pay AS (
  SELECT regiao_moradia, modelo_trabalho_padronizado,
    CAST(SUM(respondentes_ponto_medio) AS BIGINT) AS respondentes_ponto_medio,
    SUM(salario_medio_aproximado * respondentes_ponto_medio)
      / NULLIF(SUM(respondentes_ponto_medio), 0) AS salario_medio_aproximado
  FROM region_cells
  WHERE ano_pesquisa = {FOCUS} AND regiao_moradia IS NOT NULL
    AND modelo_trabalho_padronizado IS NOT NULL
  GROUP BY 1, 2
)"""

_GENDER_COUNTS = """
gender_counts AS (
  SELECT ano_pesquisa, genero, CAST(SUM(respondentes) AS BIGINT) AS respondentes
  FROM diversity GROUP BY 1, 2
)"""

_MODEL_COUNTS = """
model_counts AS (
  SELECT ano_pesquisa, modelo_trabalho_padronizado, CAST(SUM(respondentes) AS BIGINT) AS respondentes
  FROM region_cells WHERE modelo_trabalho_padronizado IS NOT NULL GROUP BY 1, 2
)"""


def _stack(counts: str, category: str, order: tuple[str, ...], label_from: int, others: bool) -> str:
    rank = " ".join(f"WHEN '{name}' THEN {i}" for i, name in enumerate(order, start=1))
    shown = "" if others else f"WHERE ordem <= {len(order)}"
    return f"""
SELECT ano_pesquisa, {category}, ordem, respondentes, percentual,
  CAST(COALESCE(SUM(respondentes) OVER (PARTITION BY ano_pesquisa ORDER BY ordem, {category}
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) / total * 100 AS base,
  CASE WHEN percentual >= {label_from} THEN {pt("percentual")} || '%' END AS rotulo
FROM (
  SELECT *, CAST(respondentes AS DOUBLE) / total * 100 AS percentual,
    CAST(CASE {category} {rank} ELSE {len(order) + 1} END AS INT) AS ordem
  FROM (SELECT *, CAST(SUM(respondentes) OVER (PARTITION BY ano_pesquisa) AS BIGINT) AS total
        FROM {counts})
) {shown}"""


_PAY_SENIORITY = "FROM pay WHERE dimensao_tipo = 'senioridade'"
_GENDERS = ("Feminino", "Masculino", "Outro", "Prefiro não informar")
_MODELS = ("Remoto", "Híbrido flexível", "Híbrido fixo", "Presencial")
_LEVEL_RANK = "CAST(CASE senioridade WHEN 'Júnior' THEN 1 WHEN 'Pleno' THEN 2 WHEN 'Sênior' THEN 3 END AS INT)"

GOLD_SQL = {
    "respondents": using(select="SELECT * FROM r"),
    "annual_kpis": using(ANNUAL, select="SELECT * FROM annual"),
    "market_structure": using(MARKET, select="SELECT * FROM market"),
    "pay_by_dimension": using(PAY, select="SELECT * FROM pay"),
    "diversity_cells": using(DIVERSITY, select="SELECT * FROM diversity"),
    "technology_adoption": using(TECH, select="SELECT * FROM tech"),
    "ai_adoption": using(AI, select="SELECT * FROM ai"),
    "region_work": using(REGION, select="SELECT * FROM region_cells"),
}

KPI_SQL = {
    "kpi_annual_summary": using(
        ANNUAL,
        select="""SELECT ano_pesquisa, total_respondentes, percentual_mulheres, percentual_seniores,
  percentual_remoto, percentual_sql, percentual_python, percentual_ia, ia_elegiveis_validos,
  ia_respostas_contraditorias FROM annual""",
    ),
    "kpi_market_by_title_min30": using(MARKET, select="SELECT * FROM market WHERE respondentes >= 30"),
    "kpi_pay_by_seniority_min30": using(
        PAY,
        select=f"""SELECT ano_pesquisa, dimensao_valor AS senioridade, respondentes_ponto_medio AS n,
  salario_medio_aproximado, faixa_mediana_ordem {_PAY_SENIORITY} AND respondentes_ponto_medio >= 30""",
    ),
    "kpi_pay_by_title_year_min30": using(
        PAY,
        select=f"""SELECT dimensao_valor AS cargo, respondentes_ponto_medio AS n,
  salario_medio_aproximado, faixa_mediana_ordem FROM pay
WHERE dimensao_tipo = 'cargo' AND ano_pesquisa = {FOCUS} AND respondentes_ponto_medio >= 30""",
    ),
    "kpi_diversity_min30": using(DIVERSITY, select="SELECT * FROM diversity WHERE respondentes >= 30"),
    "kpi_technology_overall": using(
        TECH,
        select="""SELECT ano_pesquisa, tecnologia, respondentes_elegiveis AS n, adotantes, percentual_adocao
FROM tech WHERE segmento_tipo = 'geral'""",
    ),
    "kpi_technology_by_title_year_min30": using(
        TECH,
        select=f"""SELECT tecnologia, segmento_valor AS cargo, respondentes_elegiveis AS n, adotantes,
  percentual_adocao FROM tech
WHERE segmento_tipo = 'cargo' AND ano_pesquisa = {FOCUS} AND respondentes_elegiveis >= 30""",
    ),
    "kpi_ai_overall": using(
        AI,
        select="""SELECT ano_pesquisa, respondentes_validos AS n, adotantes_ia, percentual_adocao_ia,
  uso_gratuito, uso_pago_proprio, uso_pago_empresa, uso_copilot FROM ai WHERE segmento_tipo = 'geral'""",
    ),
    "kpi_ai_by_seniority_min30": using(
        AI,
        select="""SELECT ano_pesquisa, segmento_valor AS senioridade, respondentes_validos AS n,
  percentual_adocao_ia FROM ai WHERE segmento_tipo = 'senioridade' AND respondentes_validos >= 30""",
    ),
    "kpi_region_work_min30": using(
        REGION,
        select="""SELECT ano_pesquisa, regiao_moradia, modelo_trabalho_padronizado, senioridade, respondentes,
  respondentes_ponto_medio AS n_salario, salario_medio_aproximado, respondentes_validos_ia AS n_ia,
  percentual_adocao_ia FROM region_cells WHERE respondentes >= 30""",
    ),
}

EXTRACT_SQL = {
    "extract_kpis": using(ANNUAL, select="SELECT * FROM annual"),
    "extract_gender_rollup": using(DIVERSITY, _GENDER_COUNTS, select="SELECT * FROM gender_counts"),
    "extract_title_rollup": using(
        MARKET,
        select="""SELECT ano_pesquisa, cargo_padronizado, CAST(SUM(respondentes) AS BIGINT) AS respondentes
FROM market GROUP BY 1, 2""",
    ),
    "extract_pay_by_title_year": using(
        PAY,
        select=f"""SELECT ano_pesquisa, dimensao_valor AS cargo_padronizado, respondentes_ponto_medio,
  salario_medio_aproximado FROM pay WHERE dimensao_tipo = 'cargo' AND ano_pesquisa = {FOCUS}""",
    ),
    "extract_pay_by_seniority": using(
        PAY,
        select=f"""SELECT ano_pesquisa, dimensao_valor AS senioridade, respondentes_faixa_valida,
  respondentes_ponto_medio, salario_medio_aproximado, faixa_mediana_ordem {_PAY_SENIORITY}""",
    ),
    "extract_technologies": using(
        TECH,
        select="""SELECT ano_pesquisa, tecnologia, respondentes_elegiveis, adotantes, percentual_adocao
FROM tech WHERE segmento_tipo = 'geral' AND segmento_valor = 'Todos'""",
    ),
    "extract_ai_overall": using(
        AI,
        select="""SELECT ano_pesquisa, respondentes_validos, adotantes_ia, percentual_adocao_ia,
  uso_gratuito, uso_pago_proprio, uso_pago_empresa, uso_copilot FROM ai
WHERE segmento_tipo = 'geral' AND segmento_valor = 'Todos'""",
    ),
    "extract_ai_by_seniority": using(
        AI,
        select="""SELECT ano_pesquisa, segmento_valor AS senioridade, respondentes_validos,
  percentual_adocao_ia FROM ai WHERE segmento_tipo = 'senioridade'""",
    ),
    "extract_work_model_rollup": using(REGION, _MODEL_COUNTS, select="SELECT * FROM model_counts"),
    "extract_region_model_weighted_pay": using(
        REGION,
        _REGION_EXTRACT,
        select="""SELECT regiao_moradia, modelo_trabalho_padronizado, respondentes_ponto_medio,
  round(salario_medio_aproximado, 6) AS salario_medio_aproximado FROM region_pay""",
    ),
}

CHART_SQL = {
    "scorecard_latest": using(
        ANNUAL,
        select=f"""SELECT ano_pesquisa, CAST(ordem AS INT) AS ordem, indicador, valor
FROM (
  SELECT ano_pesquisa, 1 AS ordem, 'Respondentes' AS indicador, {pt("total_respondentes", 0)} AS valor
  FROM annual
  UNION ALL SELECT ano_pesquisa, 2, 'Trabalho remoto', {pt("percentual_remoto")} || '%' FROM annual
  UNION ALL SELECT ano_pesquisa, 3, 'Mulheres na amostra', {pt("percentual_mulheres")} || '%' FROM annual
  UNION ALL SELECT ano_pesquisa, 4, 'Uso profissional de IA', {pt("percentual_ia")} || '%' FROM annual
) WHERE ano_pesquisa = (SELECT MAX(ano_pesquisa) FROM annual)""",
    ),
    "gender_share_stack": using(
        DIVERSITY, _GENDER_COUNTS, select=_stack("gender_counts", "genero", _GENDERS, 4, True)
    ),
    "market_top8": using(
        MARKET,
        select=f"""SELECT ano_pesquisa, cargo_padronizado, respondentes,
  CAST(respondentes AS DOUBLE) / total * 100 AS percentual,
  {pt("respondentes", 0)} || '  |  ' || {pt("CAST(respondentes AS DOUBLE) / total * 100")} || '%' AS rotulo
FROM (
  SELECT *, SUM(respondentes) OVER () AS total
  FROM (SELECT ano_pesquisa, cargo_padronizado, CAST(SUM(respondentes) AS BIGINT) AS respondentes
        FROM market WHERE ano_pesquisa = (SELECT MAX(ano_pesquisa) FROM market) GROUP BY 1, 2))
ORDER BY respondentes DESC, cargo_padronizado LIMIT 8""",
    ),
    "pay_top8_min50": using(
        PAY,
        select=f"""SELECT dimensao_valor AS cargo_padronizado, respondentes_ponto_medio,
  salario_medio_aproximado,
  {money("salario_medio_aproximado")} || '  (n=' || CAST(respondentes_ponto_medio AS VARCHAR) || ')' AS rotulo
FROM pay WHERE dimensao_tipo = 'cargo' AND ano_pesquisa = {FOCUS} AND respondentes_ponto_medio >= 50
ORDER BY salario_medio_aproximado DESC, dimensao_valor LIMIT 8""",
    ),
    "pay_progression": using(
        PAY,
        select=f"""SELECT ano_pesquisa, senioridade, {_LEVEL_RANK} AS ordem, salario_medio_aproximado,
  {money("salario_medio_aproximado")} AS rotulo
FROM (SELECT ano_pesquisa, dimensao_valor AS senioridade, salario_medio_aproximado {_PAY_SENIORITY})
WHERE senioridade IN ('Júnior', 'Pleno', 'Sênior')""",
    ),
    "technology_trend": using(
        TECH,
        select=f"""SELECT ano_pesquisa, tecnologia,
  CAST(CASE tecnologia WHEN 'SQL' THEN 1 WHEN 'Python' THEN 2 ELSE 3 END AS INT) AS ordem,
  percentual_adocao, {pt("percentual_adocao")} || '%' AS rotulo
FROM tech WHERE segmento_tipo = 'geral' AND tecnologia IN ('SQL', 'Python', 'Databricks')""",
    ),
    "ai_yearly": using(
        AI,
        select=f"""SELECT ano_pesquisa, percentual_adocao_ia, respondentes_validos,
  {pt("percentual_adocao_ia")} || '%' || chr(10) || 'n=' || {pt("respondentes_validos", 0)} AS rotulo
FROM ai WHERE segmento_tipo = 'geral'""",
    ),
    "work_model_share": using(
        REGION,
        _MODEL_COUNTS,
        select=_stack("model_counts", "modelo_trabalho_padronizado", _MODELS, 7, False),
    ),
    "region_model_matrix": using(
        REGION,
        _REGION_EXTRACT,
        select=f"""SELECT regiao_moradia, modelo_trabalho_padronizado,
  round(salario_medio_aproximado, 6) AS salario_medio_aproximado,
  {money("salario_medio_aproximado")} AS rotulo,
  salario_medio_aproximado > (SELECT median(salario_medio_aproximado) FROM region_pay) AS acima_mediana
FROM region_pay""",
    ),
    "ai_access_mentions": using(
        AI,
        select="""SELECT ano_pesquisa, tipo_acesso, ordem, mencoes,
  CAST(COALESCE(SUM(mencoes) OVER (PARTITION BY ano_pesquisa ORDER BY ordem
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS base
FROM (
  SELECT ano_pesquisa, 'Gratuito' AS tipo_acesso, CAST(1 AS INT) AS ordem, uso_gratuito AS mencoes
  FROM ai WHERE segmento_tipo = 'geral'
  UNION ALL SELECT ano_pesquisa, 'Pago pelo profissional', 2, uso_pago_proprio FROM ai WHERE segmento_tipo = 'geral'
  UNION ALL SELECT ano_pesquisa, 'Pago pela empresa', 3, uso_pago_empresa FROM ai WHERE segmento_tipo = 'geral'
  UNION ALL SELECT ano_pesquisa, 'Copilot', 4, uso_copilot FROM ai WHERE segmento_tipo = 'geral')""",
    ),
    "ai_seniority_matrix": using(
        AI,
        select="""SELECT ano_pesquisa, "Júnior", "Pleno", "Sênior",
  format('{:.1f}%', "Júnior") AS "rotulo_Júnior", format('{:.1f}%', "Pleno") AS "rotulo_Pleno",
  format('{:.1f}%', "Sênior") AS "rotulo_Sênior"
FROM (SELECT ano_pesquisa,
    AVG(percentual_adocao_ia) FILTER (segmento_valor = 'Júnior') AS "Júnior",
    AVG(percentual_adocao_ia) FILTER (segmento_valor = 'Pleno') AS "Pleno",
    AVG(percentual_adocao_ia) FILTER (segmento_valor = 'Sênior') AS "Sênior"
  FROM ai WHERE segmento_tipo = 'senioridade' GROUP BY ano_pesquisa)""",
    ),
}

_IDENTITY = "l_suppkey, l_quantity, l_discount, l_returnflag"
_ANSWERS = "* EXCLUDE (id_respondente)"


def _pivot(index: str, column: str, values: tuple[str, ...], cell: str, source: str) -> str:
    cells = ", ".join(cell.format(test=f"{column} = '{v}'") + f' AS "{v}"' for v in values)
    return f"SELECT {index}, {cells} FROM {source} GROUP BY {index}"


_SUM_CELL = "CAST(COALESCE(SUM(respondentes) FILTER ({test}), 0) AS BIGINT)"
_MEAN_CELL = "round(AVG(salario_medio_aproximado) FILTER ({test}), 6)"

OPERATOR_SQL = {
    "market_structure_joined": GOLD_SQL["market_structure"],
    "technology_long_counts": using(
        TECH_LONG,
        select="""SELECT ano_pesquisa, tecnologia, COUNT(*) AS linhas, COUNT(adotou) AS respostas,
  COUNT(*) - COUNT(adotou) AS nulos FROM tech_long GROUP BY 1, 2""",
    ),
    "ordinal_median_by_region": using(
        select="""SELECT ano_pesquisa, regiao_moradia, COUNT(*) AS respondentes,
  CAST(quantile_disc(salario_ordem, 0.5) AS INT) AS mediana FROM r GROUP BY 1, 2""",
    ),
    "gender_pivot": using(
        DIVERSITY,
        _GENDER_COUNTS,
        select=_pivot("ano_pesquisa", "genero", _GENDERS, _SUM_CELL, "gender_counts"),
    ),
    "work_model_pivot": using(
        REGION,
        _MODEL_COUNTS,
        select=_pivot("ano_pesquisa", "modelo_trabalho_padronizado", _MODELS, _SUM_CELL, "model_counts"),
    ),
    "region_model_pivot": using(
        REGION,
        _REGION_EXTRACT,
        select=_pivot("regiao_moradia", "modelo_trabalho_padronizado", _MODELS, _MEAN_CELL, "region_pay"),
    ),
    "survey_years": using(select="SELECT DISTINCT ano_pesquisa FROM r WHERE ano_pesquisa IS NOT NULL"),
    "excess_duplicates": f"""SELECT COUNT(*) AS registros,
  COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT {_IDENTITY} FROM lineitem)) AS duplicados_excedentes
FROM lineitem""",
    "excess_duplicates_all_columns": """SELECT l_returnflag, COUNT(*) AS registros,
  COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM lineitem) d WHERE d.l_returnflag = a.l_returnflag)
    AS duplicados_excedentes
FROM (SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_orderkey % 89 = 0) a GROUP BY l_returnflag""",
    "excess_duplicates_by_year": using(
        select=f"""SELECT ano_pesquisa, registros, registros - distintos AS duplicados_excedentes
FROM (SELECT ano_pesquisa, COUNT(*) AS registros FROM r GROUP BY 1)
  JOIN (SELECT ano_pesquisa, COUNT(*) AS distintos
        FROM (SELECT DISTINCT {_ANSWERS} FROM r) GROUP BY 1) USING (ano_pesquisa)""",
    ),
    "repeated_lines": f"SELECT {_IDENTITY}, COUNT(*) AS copies FROM lineitem GROUP BY ALL HAVING COUNT(*) > 1",
    "quality_audit": using(
        select="""SELECT ano_pesquisa AS ano, 'bronze_para_silver' AS etapa, n AS registros_entrada,
  n AS registros_saida, CAST(0 AS BIGINT) AS registros_descartados,
  n - distintos AS duplicidades_excedentes_preservadas, CAST(0 AS BIGINT) AS ids_nulos,
  regioes_invalidas, CAST(0 AS BIGINT) AS senioridades_invalidas,
  CASE WHEN regioes_invalidas > 0 THEN 'ALERTA' ELSE 'OK' END AS status
FROM (SELECT ano_pesquisa, COUNT(*) AS n, COUNT(DISTINCT id_respondente) AS distintos,
        COUNT(*) FILTER (regiao_moradia = 'MIDDLE EAST') AS regioes_invalidas
      FROM (SELECT * FROM r UNION ALL SELECT * FROM r WHERE id_respondente % 89 = 0) GROUP BY 1)""",
    ),
    "coerce_numeric": """SELECT o_orderpriority, COUNT(limpo) AS n_limpo, COUNT(espacos) AS n_espacos,
  COUNT(virgula) AS n_virgula, COUNT(prioridade) AS n_prioridade, COUNT(expoente) AS n_expoente,
  COUNT(vazio) AS n_vazio, round(SUM(expoente), 2) AS soma_expoente, MAX(espacos) AS maior
FROM (
  SELECT o_orderpriority,
    TRY_CAST(CAST(o_totalprice AS VARCHAR) AS DOUBLE) AS limpo,
    TRY_CAST('  ' || CAST(o_totalprice AS VARCHAR) || ' ' AS DOUBLE) AS espacos,
    TRY_CAST(replace(CAST(o_totalprice AS VARCHAR), '.', ',') AS DOUBLE) AS virgula,
    TRY_CAST(o_orderpriority AS DOUBLE) AS prioridade,
    TRY_CAST(CAST(o_orderkey % 10 AS VARCHAR) || 'e2' AS DOUBLE) AS expoente,
    TRY_CAST('' AS DOUBLE) AS vazio
  FROM orders)
GROUP BY o_orderpriority""",
    "number_labels": f"""SELECT c_custkey, {pt("c_acctbal")} AS decimal_1, {pt("c_acctbal", 2)} AS decimal_2,
  {pt("c_custkey * 1000", 0)} AS contagem, {pt("c_acctbal / 100")} || '%' AS percentual,
  {money("c_acctbal")} AS dinheiro
FROM customer""",
}

# --- files, catalog and audit log ------------------------------------------------------------

# Columns of the raw files.
_WIDTH = 24
_EDITIONS = """
copies AS (SELECT ano_pesquisa, COUNT(*) AS registros,
    COUNT(*) - COUNT(DISTINCT id_respondente) AS duplicados FROM raw GROUP BY 1)"""

_TABLES = {
    "silver_profissionais": "r",
    "gold_kpis_anuais": "annual",
    "gold_mercado_profissionais": "market",
    "gold_remuneracao": "pay",
    "gold_diversidade": "diversity",
    "gold_tecnologias": "tech",
    "gold_inteligencia_artificial": "ai",
    "gold_regiao_trabalho": "region_cells",
}

STORAGE_SQL = {
    "edition_profile_check": using(
        _COPIES,
        _EDITIONS,
        select="\nUNION ALL ".join(
            f"""SELECT ano_pesquisa, '{metric}' AS metrica, CAST({value} AS BIGINT) AS obtido,
  CAST({value} AS BIGINT) AS esperado, TRUE AS confere FROM copies"""
            for metric, value in {
                "registros": "registros",
                "colunas": _WIDTH,
                "duplicados_excedentes": "duplicados",
            }.items()
        ),
    ),
    "edition_audit_log": using(
        _COPIES,
        _EDITIONS,
        select=f"""SELECT ano_pesquisa, 'bronze' AS camada_origem, registros, CAST({_WIDTH} AS BIGINT) AS colunas,
  duplicados AS duplicados_excedentes, 'OK' AS status FROM copies""",
    ),
    "conformed_editions": using(_COPIES, select="SELECT * FROM raw"),
    "kpi_conform_audit": using(
        _COPIES,
        _EDITIONS,
        select="""SELECT ano_pesquisa AS ano, 'bronze_para_silver' AS etapa, registros AS registros_entrada,
  registros AS registros_saida, CAST(0 AS BIGINT) AS registros_descartados,
  duplicados AS duplicidades_excedentes_preservadas, CAST(0 AS BIGINT) AS ids_nulos,
  CAST(0 AS BIGINT) AS regioes_invalidas, CAST(0 AS BIGINT) AS senioridades_invalidas, 'OK' AS status
FROM copies""",
    ),
    "catalog_tables": using(
        ANNUAL,
        MARKET,
        PAY,
        DIVERSITY,
        TECH,
        AI,
        REGION,
        select="\nUNION ALL ".join(
            f"SELECT '{name}' AS tabela, COUNT(*) AS linhas FROM {cte}" for name, cte in _TABLES.items()
        ),
    ),
    "extract_file_gender_share": CHART_SQL["gender_share_stack"],
    **{
        f"extract_file_{extract}": EXTRACT_SQL[query]
        for extract, query in {
            "kpis": "extract_kpis",
            "diversidade": "extract_gender_rollup",
            "mercado": "extract_title_rollup",
            "remuneracao_cargo": "extract_pay_by_title_year",
            "remuneracao_senioridade": "extract_pay_by_seniority",
            "tecnologias": "extract_technologies",
            "ia_geral": "extract_ai_overall",
            "trabalho": "extract_work_model_rollup",
        }.items()
    },
}
STORAGE_SQL["lake_audit"] = STORAGE_SQL["kpi_conform_audit"]

# The raw files of a whole run hold some respondents twice.
_ONCE = RESPONDENTS.replace("r AS (", "once AS (", 1)
_TWICE = f"""{_ONCE},
r AS (SELECT * FROM once UNION ALL SELECT * FROM once WHERE id_respondente % 97 = 0)"""
STORED_SQL = {f"stored_{name}": sql.replace(RESPONDENTS, _TWICE, 1) for name, sql in {**KPI_SQL, **EXTRACT_SQL}.items()}


# The respondents with the answers of the varied fixture.
_REPLACED = ", ".join(f"{sql} AS {name}" for name, sql in VARIATIONS.items())
_VARIED = f"""{_ONCE},
r AS (SELECT * REPLACE ({_REPLACED}) FROM once)"""
VARIED_SQL = {
    f"varied_{name}": {**KPI_SQL, **CHART_SQL}[name].replace(RESPONDENTS, _VARIED, 1)
    for name in (
        "kpi_market_by_title_min30",
        "kpi_pay_by_title_year_min30",
        "kpi_diversity_min30",
        "kpi_technology_by_title_year_min30",
        "gender_share_stack",
        "market_top8",
        "pay_top8_min50",
        "work_model_share",
    )
}

VARIED_SQL["varied_kpi_diversity_min10"] = VARIED_SQL["varied_kpi_diversity_min30"].replace(">= 30", ">= 10")
_RARE = f"""{_ONCE},
r AS (SELECT * REPLACE ({RARE_SENIORITIES} AS senioridade) FROM once)"""
VARIED_SQL.update(
    (f"varied_{name}", KPI_SQL[name].replace(RESPONDENTS, _RARE, 1))
    for name in ("kpi_pay_by_seniority_min30", "kpi_ai_by_seniority_min30")
)

# --- cube, added editions, audit over runs, spellings ----------------------------------------

_CUBE_KEYS = (
    "ano_pesquisa, cargo_padronizado, senioridade, genero, regiao_moradia, modelo_trabalho_padronizado,"
    " tempo_experiencia_historica, faixa_salarial_original, salario_ordem"
)
_CUBE_FLAGS = ("eh_gestor", *_TECH_NAMES, "usa_ia_generativa")
_CUBE_ACCESS = ("ia_gratuita", "ia_paga_propria", "ia_paga_empresa", "ia_copilot")
_CUBE_STATES = [
    "COUNT(*) AS n",
    *[f"COUNT({flag}) AS n_{flag}, {_flag_sum(flag)} AS hits_{flag}" for flag in _CUBE_FLAGS],
    *[
        f"COUNT({flag}) AS n_{flag}, "
        f"CAST(COALESCE(SUM({flag}) FILTER (usa_ia_generativa IS NOT NULL), 0) AS BIGINT) AS hits_{flag}"
        for flag in _CUBE_ACCESS
    ],
    "COUNT(salario_ponto_medio) AS n_salario_ponto_medio, SUM(salario_ponto_medio) AS sum_salario_ponto_medio",
    *[
        f"COUNT({name}) AS n_{name}, CAST(SUM({name}) AS BIGINT) AS sum_{name}"
        for name in ("flag_ia_contraditoria", "quantidade_flags_qualidade")
    ],
]
CUBE_SQL = {
    "base_cube": using(select=f"SELECT {_CUBE_KEYS}, {', '.join(_CUBE_STATES)} FROM r GROUP BY {_CUBE_KEYS}"),
    **{f"cube_{name}": sql for name, sql in GOLD_SQL.items() if name != "respondents"},
    "exact_region_model_pay": using(
        select=f"""SELECT regiao_moradia, modelo_trabalho_padronizado, COUNT(salario_ponto_medio) AS respondentes_ponto_medio,
  round(AVG(salario_ponto_medio), 6) AS salario_medio_exato
FROM r WHERE ano_pesquisa = {FOCUS} AND regiao_moradia IS NOT NULL AND modelo_trabalho_padronizado IS NOT NULL
GROUP BY 1, 2"""
    ),
}
GROWN_SQL = {
    **{f"grown_{name}": sql.replace(RESPONDENTS, _TWICE, 1) for name, sql in GOLD_SQL.items() if name != "respondents"},
    "grown_lake_audit": STORAGE_SQL["lake_audit"],
}
STORAGE_SQL["edition_audit_latest"] = STORAGE_SQL["edition_audit_log"]
STORAGE_SQL["edition_audit_history"] = using(
    _COPIES,
    select="""SELECT ano_pesquisa, CAST(CASE WHEN ano_pesquisa = 2001 THEN 2 ELSE 3 END AS BIGINT) AS execucoes,
  CAST((CASE WHEN ano_pesquisa = 2001 THEN 2 ELSE 3 END) - ano_pesquisa % 2 AS BIGINT) AS aprovadas,
  ano_pesquisa % 2 = 1 AS registros_mudaram, 'OK' AS status
FROM raw GROUP BY ano_pesquisa""",
)
STORAGE_SQL["conformed_spellings"] = """SELECT CASE WHEN c_custkey % 10 <> 0 THEN c_mktsegment ELSE '(sem grafia)' END AS cargo,
  COUNT(*) AS respondentes, COUNT(DISTINCT o_orderkey) AS ids
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1"""

ORACLE = {**CUBE_SQL, **GROWN_SQL, **GOLD_SQL, **KPI_SQL, **EXTRACT_SQL, **CHART_SQL, **OPERATOR_SQL, **STORAGE_SQL, **STORED_SQL, **VARIED_SQL}
