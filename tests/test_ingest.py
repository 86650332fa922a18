"""Strict files, conforming rules, audits and stored tables."""

import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from surveyloom.fixtures.editions import REGIONS, WIDTH, edition_rules, write_editions
from surveyloom.fixtures.respondents import FIXTURE_SETTINGS
from surveyloom.operators import audit
from surveyloom.operators.duplicates import duplicate_profile
from surveyloom.plans import lifecycle
from surveyloom.plans.charts import build_charts
from surveyloom.plans.kpi_queries import conform_audit
from surveyloom.session import fresh_folder, shared_folder
from surveyloom.sinks.audit_log import append_run, preview, read_runs
from surveyloom.sinks.catalog import ensure_database, inventory, read_tables, use_database, write_table
from surveyloom.sources.conform import Answer, Code, Flag, Number, conform
from surveyloom.sources.extract_files import read_extract_files
from surveyloom.sources.raw_csv import WidthMismatch, check_width, read_raw_csv
from surveyloom.vocabulary import AUDIT_TABLE, EDITION_PROFILES, SILVER_TABLE, SILVER_TYPES

AT = datetime(2024, 5, 6, 7, 8, 9)


def _file(folder, text, name="raw.csv"):
    path = folder / name
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_quotes_line_breaks_and_odd_headers(spark, tmp_path):
    path = _file(tmp_path, '"P1.a `x`","b c",a,a\n"line one\nline two","say ""hi""","",7\n1,2,3,\n')
    frame = read_raw_csv(spark, path)
    assert frame.columns == ["P1.a `x`", "b c", "a2", "a3"]
    assert {kind for _, kind in frame.dtypes} == {"string"}
    assert [tuple(r) for r in frame.collect()] == [
        ("line one\nline two", 'say "hi"', None, "7"),
        ("1", "2", "3", None),
    ]


@pytest.mark.parametrize("row", ["1,2", "1,2,3,4"])
def test_short_and_long_rows_fail(spark, tmp_path, row):
    path = _file(tmp_path, f"a,b,c\n1,2,3\n{row}\n")
    with pytest.raises(Exception, match="MALFORMED"):
        read_raw_csv(spark, path).count()


def test_malformed_rows_fail_when_the_raw_text_is_stored(spark, tmp_path):
    path = _file(tmp_path, "a,b,c\n1,2,3\n1,2\n")
    with pytest.raises(Exception, match="MALFORMED"):
        lifecycle.store_raw(spark, [lifecycle.Edition(1, path)], fresh_folder(spark, "bad"))


def test_width_guard(spark, tmp_path):
    frame = read_raw_csv(spark, _file(tmp_path, "a,b\n1,2\n"))
    assert check_width(frame, 1, 2) is frame
    assert check_width(frame, 1, None) is frame
    with pytest.raises(WidthMismatch, match="2 columns, expected 3"):
        check_width(frame, 1, 3)


def test_conforming_rules(spark):
    bronze = spark.createDataFrame(
        [("1", " F ", "A", "1.0", "x"), ("2", "??", "E", "2", ""), (None, "", "Q", None, None)],
        "`P.id` string, g string, band string, flag string, level string",
    )
    rules = {
        "id_respondente": Number("P.id"),
        "genero": Answer("g", {"F": "Feminino"}),
        "senioridade": Answer("level"),
        "salario_ordem": Code("band", {"A": 1, "E": 5}),
        "salario_ponto_medio": Code("band", {"A": 50.0}),
        "usa_sql": Flag("flag"),
    }
    silver = conform(bronze, 2023, rules, AT)
    assert [f.name for f in silver.schema] == [*SILVER_TYPES, "processado_em"]
    assert [silver.schema[c].dataType.simpleString() for c in SILVER_TYPES] == list(SILVER_TYPES.values())
    picked = silver.select(
        "id_respondente", "ano_pesquisa", "genero", "senioridade", "salario_ordem", "salario_ponto_medio",
        "usa_sql", "usa_python", "quantidade_flags_qualidade",
    )
    assert [tuple(r) for r in picked.collect()] == [
        (1, 2023, "Feminino", "x", 1, 50.0, 1, None, 1),
        (2, 2023, "??", None, 5, None, None, None, 3),
        (None, 2023, None, None, None, None, None, None, 3),
    ]
    assert silver.select("processado_em").distinct().count() == 1


def test_contradictory_ai_answers(spark):
    bronze = spark.createDataFrame(
        [("0", "1"), ("0", "0"), ("1", "1"), (None, "1"), ("0", None)], "ai string, free string"
    )
    rules = {"usa_ia_generativa": Flag("ai"), "ia_gratuita": Flag("free")}
    silver = conform(bronze, 2023, rules, AT)
    assert [r[0] for r in silver.select("flag_ia_contraditoria").collect()] == [1, 0, 0, 0, 0]


def test_rules_for_unknown_columns_are_refused(spark):
    with pytest.raises(ValueError, match="not conformed"):
        conform(spark.createDataFrame([("1",)], "a string"), 1, {"nope": Answer("a")}, AT)


def test_profiles_of_the_published_editions(spark):
    expected = audit.expected_profiles(spark, EDITION_PROFILES)
    assert audit.compare_profiles(expected, expected).filter("NOT confere").count() == 0
    assert expected.agg(F.sum("registros")).first()[0] == 14_781


def test_profile_mismatch_names_edition_and_metric(spark):
    found = spark.createDataFrame([(2022, 10, 3, 1), (2023, 5, 3, 0)], audit.PROFILE_SCHEMA)
    wanted = spark.createDataFrame([(2022, 11, 3, 1), (2024, 5, 3, 0)], audit.PROFILE_SCHEMA)
    comparison = audit.compare_profiles(found, wanted)
    wrong = {(r.ano_pesquisa, r.metrica) for r in comparison.filter("NOT confere").collect()}
    others = {(y, m) for y in (2023, 2024) for m in audit.METRICS}
    assert wrong == {(2022, "registros")} | others
    with pytest.raises(audit.ProfileMismatch, match=r"2022, 'registros', 10, 11"):
        audit.raise_on_mismatch(comparison)


def test_conform_audit_status(spark):
    silver = spark.createDataFrame(
        [(1, 1, "ASIA", "Pleno"), (1, 2, None, None), (2, None, "MARS", "Chefe"), (3, 5, "ASIA", "Pleno")],
        "ano_pesquisa int, id_respondente bigint, regiao_moradia string, senioridade string",
    )
    profile = spark.createDataFrame(
        [(1, 2, 1), (2, 1, 0), (3, 2, 0), (4, 1, 0)],
        "ano_pesquisa int, registros bigint, duplicados_excedentes bigint",
    )
    rows = conform_audit({AUDIT_TABLE: audit.conform_audit(profile, silver, ["ASIA"], ["Pleno"])}).collect()
    assert [tuple(r) for r in rows] == [
        (1, "bronze_para_silver", 2, 2, 0, 0, 0, 0, 0, "ERRO"),
        (2, "bronze_para_silver", 1, 1, 0, 0, 1, 1, 1, "ALERTA"),
        (3, "bronze_para_silver", 2, 1, 1, 0, 0, 0, 0, "ERRO"),
        (4, "bronze_para_silver", 1, 0, 1, 0, 0, 0, 0, "ERRO"),
    ]


@pytest.fixture(scope="module")
def editions(spark, sf_dir):
    return write_editions(spark, sf_dir)


def test_failed_validation_is_logged_before_it_raises(spark, editions, tmp_path):
    log = str(tmp_path / "log")
    good = {e.year: e for e in editions}
    profile = lifecycle.profile_editions(spark, editions).select("ano_pesquisa", *audit.METRICS)
    wanted = {r.ano_pesquisa: {m: r[m] for m in audit.METRICS} for r in profile.collect()}
    known = [lifecycle.Edition(y, e.path, e.rules, wanted[y]) for y, e in good.items()]
    first = lifecycle.validate_editions(spark, known, log)
    wrong = [*known[:-1], lifecycle.Edition(2001, known[-1].path, {}, {**wanted[2001], "registros": 1})]
    with pytest.raises(audit.ProfileMismatch, match="2001, 'registros'"):
        lifecycle.validate_editions(spark, wrong, log)
    runs = read_runs(spark, log)
    assert runs.count() == 14
    matched = runs.filter("status = 'OK'").groupBy("id_execucao").agg(F.count("*").alias("n"))
    by_run = {row.id_execucao: row.n for row in matched.collect()}
    assert by_run[first] == 7 and sorted(by_run.values()) == [6, 7]
    assert runs.select("id_execucao", "data_hora_processamento").distinct().count() == 2


def test_lake_from_raw_files(spark, editions, rows):
    location = fresh_folder(spark, "lake-test")
    tables = lifecycle.build_lake(spark, editions, "lake_test", location, REGIONS, FIXTURE_SETTINGS)
    raw = sum(read_raw_csv(spark, e.path).count() for e in editions)
    assert tables[SILVER_TABLE].count() == raw
    assert tables[SILVER_TABLE].select("processado_em").distinct().count() == 1
    assert {r.status for r in tables[AUDIT_TABLE].collect()} == {"OK"}
    listed = {r.tableName for r in inventory(spark, "lake_test").collect()}
    assert listed == set(tables)
    plan = tables[SILVER_TABLE].filter("ano_pesquisa = 2001")._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*ano_pesquisa#\d+ = 2001", plan)
    again = lifecycle.build_lake(spark, editions, "lake_test", location, REGIONS, FIXTURE_SETTINGS)
    assert again[SILVER_TABLE].count() == raw


def test_a_failed_run_leaves_the_tables_as_they_were(spark, editions, monkeypatch):
    location = fresh_folder(spark, "lake-fail")
    lifecycle.build_lake(spark, editions[-2:], "lake_fail", location, REGIONS, FIXTURE_SETTINGS)
    name = "gold_inteligencia_artificial"
    before = spark.table(f"lake_fail.{name}").count()
    with pytest.raises(audit.EmptyTable, match=name):
        lifecycle.build_lake(spark, editions[:1], "lake_fail", location, REGIONS, FIXTURE_SETTINGS)
    whole = lifecycle.conform_editions
    monkeypatch.setattr(lifecycle, "conform_editions", lambda *args: whole(*args).filter("id_respondente % 50 <> 0"))
    with pytest.raises(audit.LostRows, match="2000, 2001"):
        lifecycle.build_lake(spark, editions[-2:], "lake_fail", location, REGIONS, FIXTURE_SETTINGS)
    assert spark.table(f"lake_fail.{name}").count() == before > 0


def test_a_lost_and_a_doubled_row_are_noticed(spark):
    silver = spark.createDataFrame([(1, 1), (1, 1), (1, 3)], "ano_pesquisa int, id_respondente bigint")
    silver = silver.selectExpr("*", "'ASIA' AS regiao_moradia", "'Pleno' AS senioridade")
    profile = spark.createDataFrame([(1, 3, 0)], "ano_pesquisa int, registros bigint, duplicados_excedentes bigint")
    assert audit.conform_audit(profile, silver, ["ASIA"], ["Pleno"]).first().status == "ALERTA"


def test_files_of_a_folder_must_share_their_header(spark, tmp_path):
    folder = tmp_path / "edition"
    folder.mkdir()
    (folder / "a.csv").write_text("x,y\n1,2\n")
    (folder / "b.csv").write_text("y,x\n3,4\n")
    with pytest.raises(Exception, match="(?i)header|malformed"):
        read_raw_csv(spark, str(folder)).collect()


def test_whole_numbers_with_decimals(spark, tmp_path):
    frame = spark.createDataFrame([("1.0",), ("9007199254740993",), ("1e3",), ("1.5",), ("x",), (None,)], "id string")
    ids = [r.id_respondente for r in conform(frame, 2001, {"id_respondente": Number("id")}, AT).collect()]
    assert ids == [1, 9007199254740993, 1000, None, None, None]
    _file(tmp_path, "ano_pesquisa,genero,respondentes,extra\n2024.0,Feminino,123.0,kept\n", "diversidade_genero.csv")
    assert read_extract_files(spark, str(tmp_path))["diversidade"].first()[:] == (2024, "Feminino", 123, "kept")


def test_only_declared_metrics_are_compared(spark, editions, tmp_path):
    found = spark.createDataFrame([(2022, 10, 3, 1)], audit.PROFILE_SCHEMA)
    comparison = audit.compare_profiles(found, audit.expected_profiles(spark, {2022: {"colunas": 3}}))
    assert [(r.metrica, r.confere) for r in comparison.collect()] == [("colunas", True)]
    log = str(tmp_path / "log")
    bare = lifecycle.Edition(2000, editions[-2].path, {}, None)
    lifecycle.validate_editions(spark, [bare, editions[-1]], log)
    assert {r.ano_pesquisa: r.status for r in read_runs(spark, log).collect()} == {2000: "SEM_PERFIL", 2001: "OK"}


def test_every_mismatch_is_named(spark):
    found = spark.createDataFrame([(2000 + i, 1, 1, 1) for i in range(9)], audit.PROFILE_SCHEMA)
    wanted = spark.createDataFrame([(2000 + i, 2, 2, 2) for i in range(9)], audit.PROFILE_SCHEMA)
    with pytest.raises(audit.ProfileMismatch) as error:
        audit.raise_on_mismatch(audit.compare_profiles(found, wanted))
    assert str(error.value).count("(20") == 27


def test_silver_row_equals_its_raw_row(spark, editions):
    edition = next(e for e in editions if e.year == 1998)
    silver = conform(read_raw_csv(spark, edition.path), 1998, edition_rules(1998), AT)
    profile = duplicate_profile(read_raw_csv(spark, edition.path)).first()
    kept = duplicate_profile(silver.select("id_respondente")).first()
    assert profile[:] == kept[:]
    assert len(read_raw_csv(spark, edition.path).columns) == WIDTH


def test_small_tables_end_in_one_file_and_overwrite(spark, silver):
    location = fresh_folder(spark, "table-test")
    ensure_database(spark, "table_test", location)
    counts = silver.groupBy("ano_pesquisa").count()
    for _ in range(2):
        write_table(counts, "table_test", "counts", f"{location}/counts")
    tables = read_tables(spark, "table_test", ["counts"])
    assert tables["counts"].count() == 7
    assert len(tables["counts"].inputFiles()) == 1
    details = {r.col_name: r.data_type for r in spark.sql("DESCRIBE EXTENDED table_test.counts").collect()}
    assert details["Type"] == "EXTERNAL"
    spark.range(1).createOrReplaceTempView("only_a_view")
    assert [r.tableName for r in inventory(spark, "table_test").collect()] == ["counts"]
    use_database(spark, "table_test")
    assert spark.table("counts").count() == 7
    use_database(spark, "default")


def test_empty_tables_are_named(spark):
    tables = {"full": spark.range(1), "void": spark.range(0)}
    with pytest.raises(audit.EmptyTable, match="void"):
        audit.assert_not_empty(tables, tables)
    audit.assert_not_empty(tables, ["full"])


def test_audit_runs_are_appended(spark, tmp_path, capsys):
    path = str(tmp_path / "runs")
    for run in ("a", "b", "b2"):
        append_run(spark.createDataFrame([(1, run)], "ano int, id_execucao string"), path)
    assert read_runs(spark, path).count() == 3
    preview(read_runs(spark, path), "ano")
    assert "id_execucao" in capsys.readouterr().out


def test_local_extracts_have_declared_types_and_skip_two_charts(spark, tmp_path):
    header = "total_respondentes,ano_pesquisa,percentual_remoto,percentual_mulheres,percentual_ia"
    _file(tmp_path, f"{header}\n10,2024,1.5,x,2\n", "kpis_anuais.csv")
    _file(tmp_path, "ano_pesquisa,percentual_adocao_ia,respondentes_validos\n2024,45.25,1234\n", "ia_geral.csv")
    data = read_extract_files(spark, str(tmp_path))
    assert data["kpis"].first()[:] == (2024, 10, 1.5, None, 2.0)
    charts = build_charts(data)
    assert not {"region_model_matrix", "ai_seniority_matrix", "ai_access_mentions"} & set(charts)
    assert charts["ai_yearly"].first().rotulo == "45,2%\nn=1.234"


def test_shared_folder_is_the_one_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    folder = shared_folder(spark)
    assert folder == shared_folder(spark)
    if named:
        assert folder == named.rstrip("/")


def test_many_spellings_are_joined_and_not_searched(spark, tmp_path):
    """Thousands of spellings give the rows that a map in the code gives; unknown and blank answers stay as they are."""
    answers = [(str(i), f" t{i % 3000} " if i % 7 else None, f"b{i % 90}") for i in range(6000)]
    bronze = spark.createDataFrame(answers, "id string, `t x` string, b string")
    titles = {f"t{i}": f"title {i % 12}" for i in range(0, 3000, 2)}
    bands = {f"b{i}": i for i in range(80)}
    table = spark.createDataFrame([(f"  {k}", v) for k, v in titles.items()] + [("", "blank"), (None, "none"), ("t0", "zzz")], "grafia string, valor string")
    few = {k: v for k, v in list(titles.items())[:20]}

    def conformed(titles, bands):
        rules = {"id_respondente": Number("id"), "cargo_padronizado": Answer("t x", titles), "salario_ordem": Code("b", bands)}
        return conform(bronze, 2024, rules, AT)

    wanted = []
    for i, title, band in answers:
        title = title.strip() if title else None
        wanted.append((int(i), titles.get(title, title), bands.get(band)))
    for spellings in (titles, table):
        frame = conformed(spellings, bands)
        found = frame.select("id_respondente", "cargo_padronizado", "salario_ordem").collect()
        assert sorted(map(tuple, found), key=str) == sorted(wanted, key=str)
        assert "map(" not in frame._jdf.queryExecution().optimizedPlan().toString()
    assert conformed(few, bands).count() == len(answers)


def test_flags_are_read_in_one_expression(spark):
    """Odd spellings of 0 and 1, and steps that do not multiply with the flags: a method of over 8,000 bytes is never compiled."""
    texts = [" 1 ", "1.0", "1e0", "10e-1", "0", "-0", ".0", "+1", "01", "1d", "0x1p0", "NaN", "inf", "2", "0.5", "", " ", "x", None]
    wanted = [1, 1, 1, 1, 0, 0, 0, 1, 1, *[None] * 10]
    names = [n for n, kind in SILVER_TYPES.items() if n.startswith(("usa_", "ia_")) or n == "eh_gestor"]
    rows = [(i, *[texts[(i + k) % len(texts)] for k in range(len(names))]) for i in range(len(texts))]
    bronze = spark.createDataFrame(rows, "id int, " + ", ".join(f"`p.{n}` string" for n in names))
    rules = {"id_respondente": Number("id"), **{n: Flag(f"p.{n}") for n in names}}
    silver = conform(bronze, 2023, rules, AT)
    for row in silver.collect():
        assert [row[n] for n in names] == [wanted[(row.id_respondente + k) % len(texts)] for k in range(len(names))]
    few = conform(bronze, 2023, {n: rules[n] for n in names[:2]}, AT)
    patterns = [f._jdf.queryExecution().optimizedPlan().toString().count("RLIKE") for f in (few, silver.drop("id_respondente"))]
    assert patterns[0] == patterns[1]


def test_what_is_expected_is_computed_once(spark, editions, monkeypatch, tmp_path):
    plain, plans = lifecycle.compare_profiles, []

    def compare(found, expected):
        plans.append(expected._jdf.queryExecution().optimizedPlan().toString())
        return plain(found, expected)

    monkeypatch.setattr(lifecycle, "compare_profiles", compare)
    profile = lifecycle.profile_editions(spark, editions[-1:]).select("ano_pesquisa", *audit.METRICS)
    lifecycle.validate_editions(spark, editions[-1:], str(tmp_path / "log"), profile)
    assert len(plans) == 2 and not any("Aggregate" in plan for plan in plans)
    assert [r.status for r in read_runs(spark, str(tmp_path / "log")).collect()] == ["OK"]
