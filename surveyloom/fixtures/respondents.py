"""A survey-shaped table derived from the order tables: one respondent per order.

The row-level answers come from the order and its customer, the technology and AI flags from
the order's lines. Orders without lines have NULL flags ("not asked").
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.vocabulary import SILVER_TYPES, Settings

# The published analysis parameters, mapped onto the editions 1995-2001 of the derived table.
FIXTURE_SETTINGS = Settings(focus_year=2001, ai_since=1996)
CLOUD_GAP = 1997

# Declared, so that planning a query opens no file.
TABLE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
        "l_linestatus string, l_shipdate timestamp_ntz"
    ),
}

# Flag of an order -> condition that one of its lines must meet.
LINE_FLAGS = {
    "usa_sql": "l_returnflag = 'R'",
    "usa_python": "l_discount >= 0.05D",
    "usa_aws": "l_linestatus = 'F'",
    "usa_azure": "l_quantity >= 40",
    "usa_gcp": "l_tax >= 0.06D",
    "usa_databricks": "l_linenumber >= 5",
    "usa_power_bi": "l_discount = 0",
    "usa_tableau": "l_returnflag = 'A'",
    "usa_ia_generativa": "l_quantity >= 25",
    "ia_gratuita": "l_tax = 0",
    "ia_paga_propria": "l_tax >= 0.05D",
    "ia_paga_empresa": "l_discount >= 0.08D",
    "ia_copilot": "l_quantity < 5",
}
CLOUD_FLAGS = ("usa_aws", "usa_azure", "usa_gcp")
ACCESS_FLAGS = ("ia_gratuita", "ia_paga_propria", "ia_paga_empresa", "ia_copilot")


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.schema(TABLE_SCHEMAS[table]).parquet(f"{sf_dir}/{table}.parquet")


def line_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order with lines: "any line meets the condition", for each flag.

    The flags that read one line column travel through the shuffle as the bits of one int. Lines of one order combine before
    the shuffle, and a line column none of whose flags is asked for is neither read nor shuffled.
    """
    sources: dict[str, list[str]] = {}
    for flag, test in LINE_FLAGS.items():
        sources.setdefault(test.split()[0], []).append(flag)
    packed = [
        "bit_or(" + " | ".join(f"if({LINE_FLAGS[flag]}, {1 << bit}, 0)" for bit, flag in enumerate(flags)) + f") AS {column}"
        for column, flags in sources.items()
    ]
    places = {flag: (column, bit) for column, flags in sources.items() for bit, flag in enumerate(flags)}
    rows = load(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(*[F.expr(bits) for bits in packed])
    return rows.selectExpr(
        "l_orderkey", *[f"({places[flag][0]} >> {places[flag][1]}) & 1 AS {flag}" for flag in LINE_FLAGS]
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers that depend on the customer. Spark broadcasts the two place tables by their size."""
    nation, region = load(spark, sf_dir, "nation"), load(spark, sf_dir, "region")
    places = nation.join(region, nation.n_regionkey == region.r_regionkey)
    people = load(spark, sf_dir, "customer")
    return people.join(places, people.c_nationkey == nation.n_nationkey).selectExpr(
        "c_custkey",
        "if(c_custkey % 20 <> 0, c_mktsegment, NULL) AS cargo_padronizado",
        "c_custkey % 50 <> 0 AS tem_genero",
        "if(n_nationkey <> 7, r_name, NULL) AS regiao_moradia",
        "CASE c_custkey % 4 WHEN 0 THEN '0-2' WHEN 1 THEN '3-5' WHEN 2 THEN '6+' END"
        " AS tempo_experiencia_historica",
        "if(c_acctbal >= 5000, 1, 0) AS eh_gestor",
    )


# Column -> SQL of both engines: thirty titles of very unequal size, an unlisted gender, an unlisted and a rare work model.
VARIATIONS = {
    "cargo_padronizado": (
        "cargo_padronizado || ' ' || CAST(CAST(FLOOR(SQRT(id_respondente % 36)) AS INT) AS VARCHAR(9))"
    ),
    "genero": "CASE WHEN id_respondente % 40 = 0 THEN 'Não binário' ELSE genero END",
    "modelo_trabalho_padronizado": (
        "CASE WHEN id_respondente % 30 = 0 THEN 'Nômade' WHEN id_respondente % 5 = 2 AND id_respondente % 4 <> 0"
        " THEN 'Presencial' ELSE modelo_trabalho_padronizado END"
    ),
}


def varied_respondents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The respondents with answers that thresholds, preferred orders and top-k selections have to sort out."""
    return respondents(spark, sf_dir).withColumns({name: F.expr(sql) for name, sql in VARIATIONS.items()})


# Two further seniorities, with about thirty and about ten answers for each edition of the middle test size.
RARE_SENIORITIES = (
    "CASE WHEN id_respondente % 50 = 0 THEN 'Especialista' WHEN id_respondente % 150 = 1 THEN 'Estágio' ELSE senioridade END"
)


def varied_seniorities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The respondents with seniorities whose cells lie around the thresholds."""
    return respondents(spark, sf_dir).withColumn("senioridade", F.expr(RARE_SENIORITIES))


def respondents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conformed row-level table.

    The customer join comes first, on narrow rows. A query that reads no flag drops the join
    with the order lines altogether, because the lines are grouped by the join key.
    """
    orders, people = load(spark, sf_dir, "orders"), customers(spark, sf_dir)
    flags = line_flags(spark, sf_dir)
    answers = orders.join(people, orders.o_custkey == people.c_custkey).selectExpr(
        "o_orderkey AS id_respondente",
        "year(o_orderdate) AS ano_pesquisa",
        "cargo_padronizado",
        "CASE o_orderpriority WHEN '5-LOW' THEN 'Júnior' WHEN '3-MEDIUM' THEN 'Pleno'"
        " WHEN '2-HIGH' THEN 'Sênior' WHEN '1-URGENT' THEN 'Sênior' END AS senioridade",
        "if(tem_genero, CASE o_orderstatus WHEN 'F' THEN 'Feminino' WHEN 'O' THEN 'Masculino'"
        " WHEN 'P' THEN 'Outro' END, NULL) AS genero",
        "regiao_moradia",
        "CASE o_orderkey % 5 WHEN 0 THEN 'Remoto' WHEN 1 THEN 'Híbrido flexível'"
        " WHEN 2 THEN 'Híbrido fixo' WHEN 3 THEN 'Presencial' END AS modelo_trabalho_padronizado",
        "tempo_experiencia_historica",
        "CASE WHEN o_totalprice < 100000 THEN 1 WHEN o_totalprice < 200000 THEN 2"
        " WHEN o_totalprice < 300000 THEN 3 WHEN o_totalprice < 400000 THEN 4 ELSE 5 END AS salario_ordem",
        "eh_gestor",
    )
    questions = {
        **{flag: flag for flag in LINE_FLAGS},
        **{flag: f"if(ano_pesquisa <> {CLOUD_GAP}, {flag}, NULL)" for flag in CLOUD_FLAGS},
        **{
            flag: f"if(ano_pesquisa >= {FIXTURE_SETTINGS.ai_since}, {flag}, NULL)"
            for flag in ("usa_ia_generativa", *ACCESS_FLAGS)
        },
    }
    asked = answers.join(flags, answers.id_respondente == flags.l_orderkey, "left").selectExpr(
        *answers.columns,
        "CASE salario_ordem WHEN 1 THEN 'A' WHEN 2 THEN 'B' WHEN 3 THEN 'C' WHEN 4 THEN 'D' ELSE 'E' END"
        " AS faixa_salarial_original",
        "if(salario_ordem < 5, double(salario_ordem * 100000 - 50000), NULL) AS salario_ponto_medio",
        *[f"{question} AS {flag}" for flag, question in questions.items()],
    )
    derived = {
        "flag_ia_contraditoria": f"if(usa_ia_generativa = 0 AND greatest({', '.join(ACCESS_FLAGS)}) = 1, 1, 0)",
        "quantidade_flags_qualidade": (
            "int(senioridade IS NULL) + int(regiao_moradia IS NULL) + int(salario_ponto_medio IS NULL)"
        ),
    }
    return asked.selectExpr(*[f"{derived[c]} AS {c}" if c in derived else c for c in SILVER_TYPES])
