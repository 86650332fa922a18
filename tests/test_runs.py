"""Publishing whole runs, adding editions, counting while writing, audits over runs."""

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from surveyloom.fixtures.editions import REGIONS, write_editions
from surveyloom.fixtures.respondents import FIXTURE_SETTINGS
from surveyloom.operators import audit
from surveyloom.plans import lifecycle
from surveyloom.plans.gold import GOLD_BUILDERS
from surveyloom.session import fresh_folder
from surveyloom.sinks import runs
from surveyloom.sinks.audit_log import append_run, compact_runs, history, latest_by_edition, new_run_id, read_runs
from surveyloom.vocabulary import AUDIT_TABLE, SILVER_TABLE

TABLES = [SILVER_TABLE, *GOLD_BUILDERS, AUDIT_TABLE]


@pytest.fixture(scope="module")
def editions(spark, sf_dir):
    return write_editions(spark, sf_dir)


def _build(spark, editions, database, location):
    return lifecycle.build_lake(spark, editions, database, location, REGIONS, FIXTURE_SETTINGS)


def _seen(spark, database):
    """What a reader of the catalog finds: rows and editions of every table."""
    return {
        name: tuple(spark.table(f"{database}.{name}").agg(F.count("*"), F.sort_array(F.collect_set(key))).first())
        for name, key in [*((n, "ano_pesquisa") for n in TABLES[:-1]), (AUDIT_TABLE, "ano")]
    }


@pytest.fixture(scope="module")
def two_runs(spark, editions):
    """A lake with a published run of two editions, and the folder of its files."""
    location = fresh_folder(spark, "two-runs")
    _build(spark, editions[-2:], "two_runs", location)
    return location


@pytest.mark.parametrize("failing", [1, 2, 5, 9])
def test_a_run_that_fails_after_any_table_is_not_seen_at_all(spark, editions, two_runs, monkeypatch, failing):
    before, plain, calls = _seen(spark, "two_runs"), runs._add_parts, []

    def fail(*args):
        calls.append(args)
        if len(calls) == failing:
            raise RuntimeError("the catalog is gone")
        plain(*args)

    monkeypatch.setattr(runs, "_add_parts", fail)
    staged = lifecycle.Staged(two_runs, tuple(runs.published_parts(spark, two_runs)))
    changed = [runs.Part(p.table, p.key, p.schema, p.year, p.path) for p in staged.parts if p.year == 2001]
    with pytest.raises(RuntimeError, match="catalog is gone"):
        runs.publish_run(spark, "two_runs", two_runs, new_run_id(datetime.now(timezone.utc)), changed)
    for table in ("publicacoes", *TABLES):
        spark.catalog.refreshTable(f"{runs.store_of('two_runs')}.{table}")
    assert _seen(spark, "two_runs") == before
    assert before[SILVER_TABLE][1] == [2000, 2001]


def test_a_later_run_replaces_all_tables_and_can_be_reverted(spark, editions):
    location = fresh_folder(spark, "later")
    _build(spark, editions[-1:], "later", location)
    first, before = runs.current_run(spark, location), _seen(spark, "later")
    pinned = runs.read_run(spark, "later", first, TABLES)
    _build(spark, editions[-3:], "later", location)
    after = _seen(spark, "later")
    assert after[SILVER_TABLE][1] == [1999, 2000, 2001] and after != before
    assert pinned[SILVER_TABLE].count() == before[SILVER_TABLE][0]
    runs.revert(spark, "later", location, first)
    assert _seen(spark, "later") == before and runs.current_run(spark, location) == first
    assert runs.publications(spark, location).count() == 3
    with pytest.raises(runs.UnknownRun):
        runs.revert(spark, "later", location, "none")


def test_the_catalog_can_be_made_again_from_the_log(spark, two_runs):
    before = _seen(spark, "two_runs")
    for name in TABLES:
        spark.sql(f"DROP VIEW two_runs.{name}")
        spark.sql(f"DROP TABLE {runs.store_of('two_runs')}.{name}")
    tables = runs.attach(spark, "two_runs", two_runs)
    assert set(tables) == set(TABLES) and _seen(spark, "two_runs") == before
    assert runs.current_run(spark, fresh_folder(spark, "nothing")) is None
    with pytest.raises(runs.UnknownRun):
        runs.attach(spark, "nothing", fresh_folder(spark, "nothing"))


def test_an_added_edition_reads_only_itself_and_equals_a_full_build(spark, editions, rows):
    whole, grown = fresh_folder(spark, "whole"), fresh_folder(spark, "grown")
    full = _build(spark, editions[3:], "whole", whole)
    _build(spark, editions[3:-1], "grown", grown)
    first = runs.current_run(spark, grown)
    added = lifecycle.add_editions(spark, editions[-1:], "grown", grown, REGIONS, FIXTURE_SETTINGS)
    for name in TABLES:
        columns = [c for c in full[name].columns if c != "processado_em"]
        wanted = rows(full[name], *columns)
        assert rows(added[name], *columns) == wanted and rows(spark.table(f"grown.{name}"), *columns) == wanted
    for part in runs.published_parts(spark, grown):
        assert (f"/runs/{first}/" in part.path) == (part.year != 2001)
    assert {f.split("/ano_pesquisa=")[1][:4] for f in added[SILVER_TABLE].filter("ano_pesquisa = 2001").inputFiles()} == {"2001"}


def test_an_edition_can_be_built_anew(spark, editions):
    location = fresh_folder(spark, "anew")
    before = _build(spark, editions[-2:], "anew", location)["gold_mercado_profissionais"].count()
    after = lifecycle.add_editions(spark, editions[-1:], "anew", location, REGIONS, FIXTURE_SETTINGS)
    assert after["gold_mercado_profissionais"].count() == before
    assert after[AUDIT_TABLE].count() == 2


def test_an_edition_without_a_topic_can_be_added_but_not_stand_alone(spark, editions):
    """The oldest edition did not ask about AI: that table has no rows for it."""
    location = fresh_folder(spark, "topic")
    with pytest.raises(audit.EmptyTable, match="gold_inteligencia_artificial"):
        _build(spark, editions[:1], "topic", location)
    assert runs.current_run(spark, location) is None
    _build(spark, editions[-1:], "topic", location)
    tables = lifecycle.add_editions(spark, editions[:1], "topic", location, REGIONS, FIXTURE_SETTINGS)
    years = {r[0] for r in tables["gold_inteligencia_artificial"].select("ano_pesquisa").distinct().collect()}
    assert years == {2001} and tables["gold_kpis_anuais"].count() == 2


def test_a_run_based_on_an_old_one_is_refused(spark, two_runs):
    parts = runs.published_parts(spark, two_runs)
    with pytest.raises(runs.ConcurrentPublication):
        runs.publish_run(spark, "two_runs", two_runs, "new", parts, based_on="another")


def test_new_columns_are_added_and_changed_ones_refused(spark):
    location = fresh_folder(spark, "columns")

    def part(sql, run):
        frame = spark.sql(sql)
        frame.write.partitionBy("ano").parquet(f"{location}/{run}")
        return runs.parts_of("t", "ano", frame, f"{location}/{run}", [1])

    runs.publish_run(spark, "columns", location, "a", part("SELECT 1 AS ano, 'x' AS b", "a"))
    runs.publish_run(spark, "columns", location, "b", part("SELECT 1 AS ano, 'y' AS b, 2L AS c", "b"))
    assert [tuple(r) for r in spark.table("columns.t").collect()] == [(1, "y", 2)]
    runs.revert(spark, "columns", location, "a")
    assert spark.table("columns.t").select("ano", "b").first()[:] == (1, "x")
    with pytest.raises(runs.ChangedColumn, match="b"):
        runs.publish_run(spark, "columns", location, "c", part("SELECT 1 AS ano, 5 AS b", "c"))


def test_rows_without_an_edition_stay(spark, silver):
    location = fresh_folder(spark, "no-edition")
    odd = silver.withColumn("ano_pesquisa", F.when(F.col("id_respondente") % 50 != 0, F.col("ano_pesquisa")))
    tables = lifecycle.store_gold(spark, odd, "no_edition", location, FIXTURE_SETTINGS)
    assert tables[SILVER_TABLE].count() == silver.count()
    assert tables[SILVER_TABLE].filter("ano_pesquisa IS NULL").count() == silver.filter("id_respondente % 50 = 0").count()
    assert spark.table("no_edition.gold_kpis_anuais").filter("ano_pesquisa IS NULL").count() == 1


def test_lost_rows_are_noticed_before_anything_is_built_from_the_rest(spark, silver):
    folder = fresh_folder(spark, "lost")
    expected = {r.ano_pesquisa: r["count"] for r in silver.groupBy("ano_pesquisa").count().collect()}
    with pytest.raises(audit.LostRows, match=r"\[1998\]"):
        lifecycle.stage_gold(silver.filter("ano_pesquisa <> 1998 OR id_respondente % 10 <> 0"), folder, expected=expected)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(f"{folder}/cubo")
    staged = lifecycle.stage_gold(silver, folder + "-2", FIXTURE_SETTINGS, expected=expected)
    assert {p.year for p in staged.parts if p.table == SILVER_TABLE} == set(expected)


def test_raw_rows_are_counted_while_they_are_stored(spark, editions):
    stored = lifecycle.store_raw(spark, editions[:2], fresh_folder(spark, "bronze"))
    assert [e.rows for e in stored] == [spark.read.parquet(e.stored).count() for e in stored]


@pytest.mark.parametrize(
    ("query", "table"),
    [("kpi_pay_by_title_year_min30", "gold_remuneracao"), ("kpi_technology_by_title_year_min30", "gold_tecnologias"),
     ("extract_pay_by_title_year", "gold_remuneracao"), ("extract_region_model_weighted_pay", "gold_regiao_trabalho")],
)
def test_queries_of_one_year_open_only_its_files(spark, sf_dir, query, table):
    from surveyloom.checks.registry import QUERIES

    frame = QUERIES[f"stored_{query}"](spark, sf_dir)
    files = frame.inputFiles()
    assert files and all(f"/{table}/ano_pesquisa=2001/" in f for f in files)


# --- audits over runs ------------------------------------------------------------------------


def _audit(spark, *rows):
    return spark.createDataFrame(list(rows), "ano_pesquisa int, registros bigint, status string, id_execucao string")


def test_the_newest_run_of_each_edition_decides(spark, tmp_path):
    path, start = str(tmp_path / "log"), datetime(2024, 1, 1, tzinfo=timezone.utc)
    ids = [new_run_id(start + timedelta(days=i)) for i in range(4)]
    assert ids == sorted(ids)
    append_run(_audit(spark, (2022, 10, "OK", ids[2]), (2023, 7, "DIVERGENTE", ids[2])), path)
    append_run(_audit(spark, (2022, 9, "DIVERGENTE", ids[0]), (2023, 8, "OK", ids[0])), path)
    append_run(_audit(spark, (2023, 8, "OK", ids[1]), (2021, 1, "SEM_PERFIL", ids[1])), path)
    log = read_runs(spark, path)
    latest = {r.ano_pesquisa: (r.registros, r.status) for r in latest_by_edition(log).collect()}
    assert latest == {2021: (1, "SEM_PERFIL"), 2022: (10, "OK"), 2023: (7, "DIVERGENTE")}
    told = {r.ano_pesquisa: (r.execucoes, r.aprovadas, r.ultima_aprovada, r.registros_mudaram, r.status) for r in history(log).collect()}
    assert told == {2021: (1, 0, None, False, "SEM_PERFIL"), 2022: (2, 1, ids[2], True, "OK"), 2023: (3, 2, ids[1], True, "DIVERGENTE")}
    recent = read_runs(spark, path, since=start + timedelta(days=1))
    assert recent.count() == 4
    recent.collect()
    assert "PartitionFilters: [isnotnull(id_execucao" in recent._jdf.queryExecution().executedPlan().toString()


def test_archived_runs_are_read_once(spark, tmp_path, rows):
    path, start = str(tmp_path / "log"), datetime(2024, 1, 1, tzinfo=timezone.utc)
    ids = [new_run_id(start + timedelta(days=i)) for i in range(5)]
    for run in ids[:4]:
        append_run(_audit(spark, (2022, 1, "OK", run), (2023, 2, "OK", run)), path)
    before = rows(read_runs(spark, path))
    compact_runs(spark, path, keep=2)
    assert rows(read_runs(spark, path)) == before and len(before) == 8
    # An old run that is appended late, after others were archived, is not lost.
    late = new_run_id(start - timedelta(days=1))
    append_run(_audit(spark, (2022, 5, "OK", late)), path)
    append_run(_audit(spark, (2022, 6, "OK", ids[4])), path)
    compact_runs(spark, path, keep=1)
    found = rows(read_runs(spark, path))
    assert len(found) == 10 and set(before) < set(found)
    assert len(spark.read.parquet(f"{path}_arquivo/versao=2").inputFiles()) == 1
    assert read_runs(spark, path, since=start + timedelta(days=3)).count() == 3
