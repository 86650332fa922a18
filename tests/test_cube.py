"""All aggregate tables from one cube of mergeable states."""

import pytest
from pyspark.sql import functions as F

from surveyloom.fixtures.respondents import FIXTURE_SETTINGS, varied_respondents
from surveyloom.plans import gold


def _plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def odd_rows(spark, sf_dir):
    """Varied answers with gaps in every dimension and flag, unlisted values, and rows without an edition."""
    frame = varied_respondents(spark, sf_dir)
    for i, name in enumerate(gold.BASE.dimensions[1:] + (gold.MIDPOINT, *gold.BASE.flags)):
        frame = frame.withColumn(name, F.when((F.col("id_respondente") + i) % 23 != 0, F.col(name)))
    return frame.withColumn("ano_pesquisa", F.when(F.col("id_respondente") % 301 != 0, F.col("ano_pesquisa")))


@pytest.mark.parametrize("table", gold.GOLD_BUILDERS)
def test_tables_from_the_cube_equal_tables_from_the_rows(table, odd_rows, silver, rows):
    for frame in (silver, odd_rows, odd_rows.limit(0)):
        wanted = gold.GOLD_BUILDERS[table](frame, FIXTURE_SETTINGS)
        found = gold.gold_from_cube(gold.base_cube(frame), FIXTURE_SETTINGS)[table]
        assert found.dtypes == wanted.dtypes
        assert rows(found) == rows(wanted)


def test_cells_can_be_merged_further(odd_rows, rows):
    """Cubes of parts, put together, give what the cube of the whole gives."""
    parts = [gold.base_cube(odd_rows.filter(f"id_respondente % 3 = {i}")) for i in range(3)]
    merged = parts[0].unionByName(parts[1]).unionByName(parts[2])
    whole = gold.base_cube(odd_rows)
    for name in gold.GOLD_BUILDERS:
        assert rows(gold.gold_from_cube(merged, FIXTURE_SETTINGS)[name]) == rows(gold.gold_from_cube(whole, FIXTURE_SETTINGS)[name])


def test_the_rows_are_scanned_once(silver):
    plan = _plan(gold.base_cube(silver))
    assert plan.count("FileScan parquet") == 1 and plan.count("Exchange") == 1


def test_tables_read_cells_only(spark, silver, tmp_path):
    gold.base_cube(silver).write.parquet(str(tmp_path / "cube"))
    tables = gold.gold_from_cube(spark.read.parquet(str(tmp_path / "cube")), FIXTURE_SETTINGS)
    for name in tables:
        assert "id_respondente" not in _plan(tables[name])


def test_no_task_gets_all_cells_of_an_edition(spark, silver, tmp_path):
    """Edition totals of the market table are joined on; no window collects an edition."""
    table = gold.gold_from_cube(gold.base_cube(silver))["gold_mercado_profissionais"]
    assert "Window" not in _plan(table)


def test_measures_that_cells_do_not_hold_are_refused():
    with pytest.raises(ValueError, match="is 1"):
        gold.BASE.hits("usa_sql", 0)
    with pytest.raises(ValueError, match="among"):
        gold.BASE.mentions("ia_gratuita")


def test_exact_pay_is_the_mean_of_all_answers(odd_rows):
    keys = ["regiao_moradia"]
    found = {r.regiao_moradia: r.salario_medio_exato for r in gold.exact_pay(gold.base_cube(odd_rows), keys, FIXTURE_SETTINGS).collect()}
    rows = odd_rows.filter("ano_pesquisa = 2001 AND regiao_moradia IS NOT NULL").groupBy(*keys).agg(F.round(F.avg(gold.MIDPOINT), 6).alias("m"))
    assert found == {r.regiao_moradia: r.m for r in rows.collect()}
