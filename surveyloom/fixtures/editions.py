"""Raw edition files derived from the respondents: wide, coded, all text.

Headers have dots, spaces and backticks, answers have quotes and line breaks, some respondents
answered twice, and the coding of an edition depends on its year.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.fixtures.respondents import respondents
from surveyloom.plans.lifecycle import Edition
from surveyloom.session import fresh_folder
from surveyloom.sources.conform import Answer, Code, Flag, Number, Rule

YEARS = tuple(range(1995, 2002))
REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
REPEATED = 97

GENDER_CODES = {"1": "Feminino", "2": "Masculino", "3": "Outro"}
BANDS = {"A": (1, 50_000.0), "B": (2, 150_000.0), "C": (3, 250_000.0), "D": (4, 350_000.0), "E": (5, None)}
FLAGS = (
    "eh_gestor",
    "usa_sql",
    "usa_python",
    "usa_aws",
    "usa_azure",
    "usa_gcp",
    "usa_databricks",
    "usa_power_bi",
    "usa_tableau",
    "usa_ia_generativa",
    "ia_gratuita",
    "ia_paga_propria",
    "ia_paga_empresa",
    "ia_copilot",
)
ID, GENDER_TEXT, GENDER_CODE = "P0 id", "P1.b genero", "P1.a `codigo`"
TEXTS = {
    "cargo_padronizado": "P2 cargo",
    "senioridade": "P2.g nivel",
    "regiao_moradia": "P1.i regiao",
    "modelo_trabalho_padronizado": "P2.r modelo",
    "tempo_experiencia_historica": "P2.i experiencia",
    "faixa_salarial_original": "P2.h faixa",
}
COMMENT = "P9 comentario"
WIDTH = 4 + len(TEXTS) + len(FLAGS)


def raw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows of all editions, with the year in ``edicao``."""
    odd = F.col("ano_pesquisa") % 2 == 1
    code = F.expr("CASE genero WHEN 'Feminino' THEN '1' WHEN 'Masculino' THEN '2' WHEN 'Outro' THEN '3' END")
    answers = respondents(spark, sf_dir).select(
        F.col("ano_pesquisa").alias("edicao"),
        F.col("id_respondente").cast("string").alias(ID),
        F.when(~odd, F.col("genero")).alias(GENDER_TEXT),
        F.when(odd, code).alias(GENDER_CODE),
        *[F.col(name).alias(header) for name, header in TEXTS.items()],
        *[F.col(flag).cast("string").alias(f"P4.{flag}") for flag in FLAGS],
        F.expr("concat('nota ', id_respondente, ':\n\"', faixa_salarial_original, '\", fim')").alias(COMMENT),
    )
    times = F.expr(f"array_repeat(0, if(`{ID}` % {REPEATED} = 0, 2, 1))")
    return answers.withColumn("_copy", F.explode(times)).drop("_copy")


def edition_rules(year: int) -> dict[str, Rule]:
    band = TEXTS["faixa_salarial_original"]
    gender = Answer(GENDER_CODE, GENDER_CODES) if year % 2 else Answer(GENDER_TEXT)
    return {
        "id_respondente": Number(ID),
        "genero": gender,
        **{name: Answer(header) for name, header in TEXTS.items()},
        "salario_ordem": Code(band, {text: order for text, (order, _) in BANDS.items()}),
        "salario_ponto_medio": Code(band, {text: mid for text, (_, mid) in BANDS.items() if mid}),
        **{flag: Flag(f"P4.{flag}") for flag in FLAGS},
    }


def write_editions(spark: SparkSession, sf_dir: str) -> list[Edition]:
    """The raw files as CSV in the shared folder: one folder per edition, files of bounded size."""
    path = fresh_folder(spark, "editions")
    (
        raw_rows(spark, sf_dir)
        .hint("rebalance", F.col("edicao"))
        .write.partitionBy("edicao")
        .options(header="true", quote='"', escape='"', maxRecordsPerFile="250000")
        .csv(path)
    )
    return [
        Edition(year, f"{path}/edicao={year}", edition_rules(year), {"colunas": WIDTH}) for year in YEARS
    ]
