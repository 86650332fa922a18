"""Every registered query against an independent SQL engine."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from surveyloom.checks.oracle import ORACLE
from surveyloom.checks.registry import QUERIES

TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


# At sf0.001 few cells have 30 answers, and the suppressed queries would compare next to nothing.
@pytest.fixture(scope="module")
def sf_dir():
    return "/root/testdata/sf0.01"


@pytest.fixture
def database(sf_dir):
    """A connection of its own for each query: an internal error invalidates the connection."""
    connection = duckdb.connect()
    for file in os.listdir(sf_dir):
        name = file.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{file}')")
    return connection


def _sorted(rows):
    return sorted(rows, key=lambda row: tuple((value is None, str(value)) for value in row))


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(name, spark, sf_dir, database):
    frame = QUERIES[name](spark, sf_dir)
    columns = sorted(frame.columns)
    wanted = database.sql(ORACLE[name])
    assert sorted(wanted.columns) == columns
    quoted = ", ".join(f'"{c}"' for c in columns)
    ordered = database.sql(f"SELECT {quoted} FROM ({ORACLE[name]})")
    assert [TYPES[frame.schema[c].dataType.simpleString()] for c in columns] == [str(t) for t in ordered.types]
    found = [tuple(row) for row in frame.select(*[f"`{c}`" for c in columns]).collect()]
    assert _sorted(found) == _sorted(ordered.fetchall())


def test_registered_queries_are_offered():
    assert set(QUERIES) <= set(entry_points.queries()) and set(ORACLE) <= set(entry_points.oracle_sql())


# Query -> its order; "-" is descending. NULLs are last either way.
ORDERS = {
    "kpi_annual_summary": "ano_pesquisa",
    "kpi_market_by_title_min30": "ano_pesquisa -respondentes",
    "kpi_pay_by_seniority_min30": "ano_pesquisa -salario_medio_aproximado",
    "kpi_pay_by_title_year_min30": "-salario_medio_aproximado",
    "kpi_diversity_min30": "ano_pesquisa cargo_padronizado senioridade -respondentes",
    "kpi_technology_overall": "tecnologia ano_pesquisa",
    "kpi_technology_by_title_year_min30": "tecnologia -percentual_adocao",
    "kpi_ai_overall": "ano_pesquisa",
    "kpi_ai_by_seniority_min30": "ano_pesquisa -percentual_adocao_ia",
    "kpi_region_work_min30": "ano_pesquisa regiao_moradia -respondentes",
    "kpi_conform_audit": "ano",
    "extract_kpis": "ano_pesquisa",
    "extract_gender_rollup": "ano_pesquisa genero",
    "extract_title_rollup": "ano_pesquisa -respondentes",
    "extract_pay_by_title_year": "-salario_medio_aproximado",
    "extract_pay_by_seniority": "ano_pesquisa senioridade",
    "extract_technologies": "ano_pesquisa tecnologia",
    "extract_ai_overall": "ano_pesquisa",
    "extract_ai_by_seniority": "ano_pesquisa senioridade",
    "extract_work_model_rollup": "ano_pesquisa modelo_trabalho_padronizado",
    "extract_region_model_weighted_pay": "regiao_moradia modelo_trabalho_padronizado",
}


@pytest.mark.parametrize("name", sorted(ORDERS))
def test_rows_come_in_order(name, spark, sf_dir):
    found = QUERIES[name](spark, sf_dir).collect()
    wanted = list(found)
    for column in reversed(ORDERS[name].split()):
        down, column = column.startswith("-"), column.lstrip("-")
        known = [row for row in wanted if row[column] is not None]
        known.sort(key=lambda row: row[column], reverse=down)
        wanted = known + [row for row in wanted if row[column] is None]
    columns = [c.lstrip("-") for c in ORDERS[name].split()]
    assert [[row[c] for c in columns] for row in found] == [[row[c] for c in columns] for row in wanted]


def test_entry_runs(spark):
    frame = entry_points.entry(spark)
    assert frame.count() == 7
    assert frame.columns[0] == "ano_pesquisa"
