"""The registered queries: every operator and named query on the given tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime, timedelta, timezone
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.fixtures.editions import REGIONS, WIDTH, raw_rows, write_editions
from surveyloom.fixtures.respondents import (
    FIXTURE_SETTINGS,
    load,
    respondents,
    varied_respondents,
    varied_seniorities,
)
from surveyloom.functions import money_label, percent_label, pt_count, pt_number, to_number
from surveyloom.operators import audit
from surveyloom.operators.duplicates import duplicate_profile, repeated_rows
from surveyloom.operators.matrix import pivot_mean, pivot_sum
from surveyloom.operators.median import aggregate_with_median
from surveyloom.operators.segments import unpivot_flags
from surveyloom.operators.selection import distinct_years
from surveyloom.plans import gold, lifecycle
from surveyloom.plans.charts import CHARTS, gender_share_stack
from surveyloom.plans.extracts import build_extracts
from surveyloom.plans.frames import Frames
from surveyloom.plans.kpi_queries import KPI_QUERIES
from surveyloom.session import fresh_folder
from surveyloom.sinks.audit_log import append_run, compact_runs, history, latest_by_edition, new_run_id, read_runs
from surveyloom.sinks.catalog import inventory, read_tables
from surveyloom.sources.conform import Answer, Number, conform
from surveyloom.sources.extract_files import EXTRACT_FILES, read_extract_files
from surveyloom.vocabulary import AUDIT_TABLE, GENDERS, SENIORITIES, TECHNOLOGIES, WORK_MODELS, Settings

Query = Callable[[SparkSession, str], DataFrame]


def _tables(spark: SparkSession, sf_dir: str) -> Frames:
    return gold.build_gold(respondents(spark, sf_dir), FIXTURE_SETTINGS)


def _gold(table: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return gold.GOLD_BUILDERS[table](respondents(spark, sf_dir), FIXTURE_SETTINGS)

    return run


def _kpi(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return KPI_QUERIES[name](_tables(spark, sf_dir), FIXTURE_SETTINGS)

    return run


def _extract(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build_extracts(_tables(spark, sf_dir), FIXTURE_SETTINGS)[name]

    return run


def _chart(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        data = build_extracts(_tables(spark, sf_dir), FIXTURE_SETTINGS, ordered=False)
        return CHARTS[name](data, FIXTURE_SETTINGS)

    return run


def _rounded(query: Query, column: str) -> Query:
    """Six places: a sum of products depends on the order of addition beyond that."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(spark, sf_dir).withColumn(column, F.round(column, 6))

    return run


GOLD_QUERIES = {
    "respondents": respondents,
    "annual_kpis": _gold("gold_kpis_anuais"),
    "market_structure": _gold("gold_mercado_profissionais"),
    "pay_by_dimension": _gold("gold_remuneracao"),
    "diversity_cells": _gold("gold_diversidade"),
    "technology_adoption": _gold("gold_tecnologias"),
    "ai_adoption": _gold("gold_inteligencia_artificial"),
    "region_work": _gold("gold_regiao_trabalho"),
}

# Registered name -> KPI query, and registered name -> extract.
KPI_NAMES = {
    "kpi_annual_summary": "annual_summary",
    "kpi_market_by_title_min30": "market_by_title",
    "kpi_pay_by_seniority_min30": "pay_by_seniority",
    "kpi_pay_by_title_year_min30": "pay_by_title",
    "kpi_diversity_min30": "diversity",
    "kpi_technology_overall": "technology_overall",
    "kpi_technology_by_title_year_min30": "technology_by_title",
    "kpi_ai_overall": "ai_overall",
    "kpi_ai_by_seniority_min30": "ai_by_seniority",
    "kpi_region_work_min30": "region_work_model",
}
EXTRACT_NAMES = {
    "extract_kpis": "kpis",
    "extract_gender_rollup": "diversidade",
    "extract_title_rollup": "mercado",
    "extract_pay_by_title_year": "remuneracao_cargo",
    "extract_pay_by_seniority": "remuneracao_senioridade",
    "extract_technologies": "tecnologias",
    "extract_ai_overall": "ia_geral",
    "extract_ai_by_seniority": "ia_senioridade",
    "extract_work_model_rollup": "trabalho",
    "extract_region_model_weighted_pay": "regiao_trabalho",
}
WEIGHTED = "extract_region_model_weighted_pay"

NAMED_QUERIES = {registered: _kpi(name) for registered, name in KPI_NAMES.items()}

EXTRACT_QUERIES = {
    **{registered: _extract(name) for registered, name in EXTRACT_NAMES.items()},
    WEIGHTED: _rounded(_extract("regiao_trabalho"), "salario_medio_aproximado"),
}

CHART_QUERIES = {
    **{name: _chart(name) for name in CHARTS},
    "region_model_matrix": _rounded(_chart("region_model_matrix"), "salario_medio_aproximado"),
}

# --- single operators ------------------------------------------------------------------------

PLANTED = 89
IDENTITY = ["l_suppkey", "l_quantity", "l_discount", "l_returnflag"]


def base_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mergeable cells behind all aggregate tables."""
    return gold.base_cube(respondents(spark, sf_dir))


def _from_cube(table: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return gold.gold_from_cube(base_cube(spark, sf_dir), FIXTURE_SETTINGS)[table]

    return run


def exact_region_model_pay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean pay by region and work model in the focus year, from sums and not from rounded means of cells."""
    return gold.exact_pay(base_cube(spark, sf_dir), ["regiao_moradia", "modelo_trabalho_padronizado"], FIXTURE_SETTINGS)


def market_structure_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.market_structure_joined(respondents(spark, sf_dir))


def technology_long_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, answers and NULL answers of the unpivoted flags: no NULL row is lost."""
    long = unpivot_flags(respondents(spark, sf_dir), TECHNOLOGIES, ["ano_pesquisa"], "tecnologia", "adotou")
    return long.groupBy("ano_pesquisa", "tecnologia").agg(
        F.count("*").alias("linhas"),
        F.count("adotou").alias("respostas"),
        F.count_if(F.col("adotou").isNull()).alias("nulos"),
    )


def ordinal_median_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["ano_pesquisa", "regiao_moradia"]
    histogram = (
        respondents(spark, sf_dir).groupBy(*keys, "salario_ordem").agg(F.count("*").alias("linhas"))
    )
    return aggregate_with_median(
        histogram, keys, "salario_ordem", "linhas", [F.sum("linhas").alias("respondentes")], "mediana"
    )


def gender_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = _extract("diversidade")(spark, sf_dir)
    return pivot_sum(cells, "ano_pesquisa", "genero", GENDERS, "respondentes")


def work_model_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = _extract("trabalho")(spark, sf_dir)
    return pivot_sum(cells, "ano_pesquisa", "modelo_trabalho_padronizado", WORK_MODELS, "respondentes")


def region_model_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = _extract("regiao_trabalho")(spark, sf_dir)
    pay, model = "salario_medio_aproximado", "modelo_trabalho_padronizado"
    table = pivot_mean(cells, "regiao_moradia", model, WORK_MODELS, pay)
    return table.select("regiao_moradia", *[F.round(F.col(m), 6).alias(m) for m in WORK_MODELS])


def survey_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_years(respondents(spark, sf_dir))


def excess_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A narrow identity, grouped as columns."""
    return duplicate_profile(load(spark, sf_dir, "lineitem"), IDENTITY)


def excess_duplicates_all_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole lines, of which some were planted twice."""
    lines = load(spark, sf_dir, "lineitem")
    return duplicate_profile(lines.unionByName(lines.filter(f"l_orderkey % {PLANTED} = 0")), keys=["l_returnflag"])


def excess_duplicates_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A wide identity: all answers."""
    answers = respondents(spark, sf_dir).drop("id_respondente")
    return duplicate_profile(answers, keys=["ano_pesquisa"])


def repeated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_rows(load(spark, sf_dir, "lineitem"), IDENTITY)


def quality_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conforming audit with one region declared invalid, of respondents some of whom answered twice."""
    once = respondents(spark, sf_dir)
    silver = once.unionByName(once.filter(f"id_respondente % {PLANTED} = 0"))
    profile = duplicate_profile(silver.select("ano_pesquisa", "id_respondente"), keys=["ano_pesquisa"])
    return audit.conform_audit(profile, silver, REGIONS[:4], SENIORITIES)


def coerce_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readable and unreadable number text, per order priority."""
    price = F.col("o_totalprice").cast("string")
    texts = {
        "limpo": price,
        "espacos": F.concat(F.lit("  "), price, F.lit(" ")),
        "virgula": F.translate(price, ".", ","),
        "prioridade": F.col("o_orderpriority"),
        "expoente": F.concat((F.col("o_orderkey") % 10).cast("string"), F.lit("e2")),
        "vazio": F.lit(""),
    }
    numbers = load(spark, sf_dir, "orders").select(
        "o_orderpriority", *[to_number(text).alias(name) for name, text in texts.items()]
    )
    return numbers.groupBy("o_orderpriority").agg(
        *[F.count(name).alias(f"n_{name}") for name in texts],
        F.round(F.sum("expoente"), 2).alias("soma_expoente"),
        F.max("espacos").alias("maior"),
    )


def number_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label text for the amounts of every customer."""
    amount = F.col("c_acctbal")
    return load(spark, sf_dir, "customer").select(
        "c_custkey",
        pt_number(amount).alias("decimal_1"),
        pt_number(amount, 2).alias("decimal_2"),
        pt_count(F.col("c_custkey") * 1000).alias("contagem"),
        percent_label(amount / 100).alias("percentual"),
        money_label(amount).alias("dinheiro"),
    )


# --- files, catalog and audit log ------------------------------------------------------------


def conformed_spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers in as many spellings as there are customers, looked up in a table; a tenth of the spellings is unknown to it."""
    customer = F.concat(F.lit(" "), "c_name", F.lit(" "))
    known = load(spark, sf_dir, "customer").filter("c_custkey % 10 <> 0").select(customer.alias("grafia"), F.col("c_mktsegment").alias("valor"))
    answers = load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("id"), F.format_string("Customer#%09d", "o_custkey").alias("nome")
    )
    rows = conform(answers, 2001, {"id_respondente": Number("id"), "cargo_padronizado": Answer("nome", known)}, datetime.now(timezone.utc))
    title = F.when(F.col("cargo_padronizado").startswith("Customer#"), "(sem grafia)").otherwise(F.col("cargo_padronizado"))
    return rows.groupBy(title.alias("cargo")).agg(
        F.count("*").alias("respondentes"), F.countDistinct("id_respondente").alias("ids")
    )


def _expected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the raw files must hold, from the rows they were written from."""
    counts = duplicate_profile(raw_rows(spark, sf_dir), keys=["edicao"])
    return counts.withColumn("colunas", F.lit(WIDTH).cast("long")).withColumnRenamed("edicao", "ano_pesquisa")


def edition_profile_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw files, written and strictly read back, against the rows they were written from."""
    profile = lifecycle.profile_editions(spark, write_editions(spark, sf_dir))
    return audit.compare_profiles(profile, _expected(spark, sf_dir))


def edition_audit_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored audit of one validation run."""
    path = fresh_folder(spark, "audit-log")
    editions = write_editions(spark, sf_dir)
    lifecycle.validate_editions(spark, editions, path, _expected(spark, sf_dir))
    return read_runs(spark, path).select(
        "ano_pesquisa", "camada_origem", "registros", "colunas", "duplicados_excedentes", "status"
    )


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log of three runs, the oldest archived: one found a row too few in odd editions, one missed edition 2001, one is whole."""
    path = fresh_folder(spark, "audit-log")
    editions = write_editions(spark, sf_dir)
    lifecycle.validate_editions(spark, editions, path, _expected(spark, sf_dir))
    stored = read_runs(spark, path)
    wrong, start = F.col("ano_pesquisa") % 2 == 1, datetime(2020, 1, 1, tzinfo=timezone.utc)
    first = stored.withColumns(
        {"registros": F.col("registros") - wrong.cast("int"), "status": F.when(wrong, "DIVERGENTE").otherwise("OK")}
    )
    for i, run in enumerate((first, stored.filter("ano_pesquisa <> 2001"))):
        at = start + timedelta(days=i)
        stamped = run.withColumns({"id_execucao": F.lit(new_run_id(at)), "data_hora_processamento": F.lit(at)})
        append_run(stamped, path)
    compact_runs(spark, path, keep=2)
    return read_runs(spark, path)


def edition_audit_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the newest run that saw an edition found."""
    return latest_by_edition(_runs(spark, sf_dir)).select(
        "ano_pesquisa", "camada_origem", "registros", "colunas", "duplicados_excedentes", "status"
    )


def edition_audit_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each edition was audited and passed."""
    return history(_runs(spark, sf_dir)).drop("ultima_aprovada")


def conformed_editions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw files of seven editions, stored, conformed by their own rules and unioned by name."""
    editions = lifecycle.store_raw(spark, write_editions(spark, sf_dir), fresh_folder(spark, "bronze"))
    return lifecycle.conform_editions(spark, editions, datetime.now(timezone.utc)).drop("processado_em")


def kpi_conform_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    editions = lifecycle.store_raw(spark, write_editions(spark, sf_dir), fresh_folder(spark, "bronze"))
    silver = lifecycle.conform_editions(spark, editions, datetime.now(timezone.utc))
    rows = audit.conform_audit(lifecycle.profile_editions(spark, editions), silver, REGIONS, SENIORITIES)
    return KPI_QUERIES["conform_audit"]({AUDIT_TABLE: rows})


def catalog_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conformed and aggregate tables, stored in the catalog and listed with their stored rows."""
    database = f"surveyloom_{uuid4().hex[:12]}"
    tables = lifecycle.store_gold(
        spark, respondents(spark, sf_dir), database, fresh_folder(spark, "lake"), FIXTURE_SETTINGS
    )
    counts = [tables[name].select(F.lit(name).alias("tabela")) for name in tables]
    rows = lifecycle.union_all(counts).groupBy("tabela").agg(F.count("*").alias("linhas"))
    return inventory(spark, database).select(F.col("tableName").alias("tabela")).join(rows, "tabela")


_LAKES: dict[tuple[str, str], Frames] = {}


def _lake(spark: SparkSession, sf_dir: str) -> Frames:
    """The published tables of one whole run from raw files, built once for each session and input."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LAKES:
        database, location = f"surveyloom_{uuid4().hex[:12]}", fresh_folder(spark, "lake")
        editions = write_editions(spark, sf_dir)
        _LAKES[key] = lifecycle.build_lake(spark, editions, database, location, REGIONS, FIXTURE_SETTINGS)
    return _LAKES[key]


_GROWN: dict[tuple[str, str], Frames] = {}


def _grown_lake(spark: SparkSession, sf_dir: str) -> Frames:
    """The published tables after the last edition was added to those of a run over the others."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _GROWN:
        database, location = f"surveyloom_{uuid4().hex[:12]}", fresh_folder(spark, "lake")
        *editions, newest = write_editions(spark, sf_dir)
        lifecycle.build_lake(spark, editions, database, location, REGIONS, FIXTURE_SETTINGS)
        lifecycle.add_editions(spark, [newest], database, location, REGIONS, FIXTURE_SETTINGS)
        _GROWN[key] = read_tables(spark, database, [*gold.GOLD_BUILDERS, AUDIT_TABLE])
    return _GROWN[key]


def _grown(table: str) -> Query:
    """A table as any reader of the catalog finds it."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _grown_lake(spark, sf_dir)[table]

    return run


def _stored_kpi(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return KPI_QUERIES[name](_lake(spark, sf_dir), FIXTURE_SETTINGS)

    return run


def _stored_extract(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build_extracts(_lake(spark, sf_dir), FIXTURE_SETTINGS)[name]

    return run


def _extract_file(name: str) -> Query:
    """An extract kept as a CSV file and read back with all its columns."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = fresh_folder(spark, "extracts")
        extract = build_extracts(_tables(spark, sf_dir), FIXTURE_SETTINGS, ordered=False)[name]
        extract.hint("rebalance").write.option("header", "true").csv(f"{folder}/{EXTRACT_FILES[name][0]}")
        return read_extract_files(spark, folder)[name].select(
            *[F.col(c).try_cast(kind).alias(c) for c, kind in extract.dtypes]
        )

    return run


def extract_file_gender_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A chart dataset from an extract that was kept as a CSV file."""
    folder = fresh_folder(spark, "extracts")
    file, _ = EXTRACT_FILES["diversidade"]
    extract = build_extracts(_tables(spark, sf_dir), FIXTURE_SETTINGS, ordered=False)["diversidade"]
    extract.hint("rebalance").write.option("header", "true").csv(f"{folder}/{file}")
    return gender_share_stack(read_extract_files(spark, folder))


def _varied_tables(spark: SparkSession, sf_dir: str) -> Frames:
    return gold.build_gold(varied_respondents(spark, sf_dir), FIXTURE_SETTINGS)


def _varied_kpi(
    name: str,
    rows: Callable[[SparkSession, str], DataFrame] = varied_respondents,
    settings: Settings = FIXTURE_SETTINGS,
) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return KPI_QUERIES[name](gold.build_gold(rows(spark, sf_dir), settings), settings)

    return run


def _varied_chart(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        data = build_extracts(_varied_tables(spark, sf_dir), FIXTURE_SETTINGS, ordered=False)
        return CHARTS[name](data, FIXTURE_SETTINGS)

    return run


# Queries whose thresholds, orders or selections leave something out on the varied respondents.
VARIED_KPIS = (
    "kpi_market_by_title_min30",
    "kpi_pay_by_title_year_min30",
    "kpi_diversity_min30",
    "kpi_technology_by_title_year_min30",
)
# On further seniorities, of which some are rare; and one with a lower threshold.
SENIORITY_KPIS = ("kpi_pay_by_seniority_min30", "kpi_ai_by_seniority_min30")
VARIED_CHARTS = ("gender_share_stack", "market_top8", "pay_top8_min50", "work_model_share")
VARIED_QUERIES = {
    **{f"varied_{registered}": _varied_kpi(KPI_NAMES[registered]) for registered in VARIED_KPIS},
    **{f"varied_{name}": _varied_chart(name) for name in VARIED_CHARTS},
    **{f"varied_{registered}": _varied_kpi(KPI_NAMES[registered], varied_seniorities) for registered in SENIORITY_KPIS},
    "varied_kpi_diversity_min10": _varied_kpi("diversity", settings=replace(FIXTURE_SETTINGS, min_cell=10)),
}

CUBE_QUERIES = {
    "base_cube": base_cube,
    **{
        f"cube_{registered}": _from_cube(table)
        for registered, table in zip([name for name in GOLD_QUERIES if name != "respondents"], gold.GOLD_BUILDERS)
    },
    "exact_region_model_pay": exact_region_model_pay,
}

OPERATOR_QUERIES = {
    "market_structure_joined": market_structure_joined,
    "technology_long_counts": technology_long_counts,
    "ordinal_median_by_region": ordinal_median_by_region,
    "gender_pivot": gender_pivot,
    "work_model_pivot": work_model_pivot,
    "region_model_pivot": region_model_pivot,
    "survey_years": survey_years,
    "excess_duplicates": excess_duplicates,
    "excess_duplicates_all_columns": excess_duplicates_all_columns,
    "excess_duplicates_by_year": excess_duplicates_by_year,
    "repeated_lines": repeated_lines,
    "quality_audit": quality_audit,
    "coerce_numeric": coerce_numeric,
    "number_labels": number_labels,
}

STORAGE_QUERIES = {
    "edition_profile_check": edition_profile_check,
    "edition_audit_log": edition_audit_log,
    "edition_audit_latest": edition_audit_latest,
    "edition_audit_history": edition_audit_history,
    "conformed_spellings": conformed_spellings,
    "conformed_editions": conformed_editions,
    "kpi_conform_audit": kpi_conform_audit,
    "catalog_tables": catalog_tables,
    "extract_file_gender_share": extract_file_gender_share,
    **{f"extract_file_{name}": _extract_file(name) for name in EXTRACT_FILES},
    "lake_audit": _stored_kpi("conform_audit"),
}

# Named queries on the published tables of a whole run. Its raw files hold some respondents twice, so the rows differ from those
# of the queries on the respondents.
STORED_QUERIES = {
    **{f"stored_{registered}": _stored_kpi(name) for registered, name in KPI_NAMES.items()},
    **{f"stored_{registered}": _stored_extract(name) for registered, name in EXTRACT_NAMES.items()},
    f"stored_{WEIGHTED}": _rounded(_stored_extract("regiao_trabalho"), "salario_medio_aproximado"),
}

# Tables of the catalog after an edition was added to a published run.
GROWN_QUERIES = {
    **{
        f"grown_{registered}": _grown(table)
        for registered, table in zip([name for name in GOLD_QUERIES if name != "respondents"], gold.GOLD_BUILDERS)
    },
    "grown_lake_audit": lambda spark, sf_dir: KPI_QUERIES["conform_audit"](_grown_lake(spark, sf_dir)),
}

QUERIES: dict[str, Query] = {
    **GOLD_QUERIES,
    **NAMED_QUERIES,
    **EXTRACT_QUERIES,
    **CHART_QUERIES,
    **OPERATOR_QUERIES,
    **STORAGE_QUERIES,
    **STORED_QUERIES,
    **VARIED_QUERIES,
    **CUBE_QUERIES,
    **GROWN_QUERIES,
}
