"""Plan shape: what is read, how often, and how it is joined."""

import re

import pytest

import __spark_entry__ as entry_points
from surveyloom.checks.registry import QUERIES
NO_FLAGS = (
    "market_structure",
    "pay_by_dimension",
    "diversity_cells",
    "kpi_market_by_title_min30",
    "extract_work_model_rollup",
    "market_top8",
    "gender_share_stack",
)

def _plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def _final(frame):
    frame.collect()
    return _plan(frame).split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_cross_join(name, spark, sf_dir):
    plan = _plan(QUERIES[name](spark, sf_dir))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "ScalaUDF"):
        assert operator not in plan


@pytest.mark.parametrize("name", NO_FLAGS)
def test_queries_without_flags_do_not_read_the_lines(name, spark, sf_dir):
    assert "l_orderkey" not in _plan(QUERIES[name](spark, sf_dir))


@pytest.mark.parametrize(
    "name", ["market_structure", "market_structure_joined", "market_top8", "technology_adoption"]
)
def test_rows_are_read_once(name, spark, sf_dir):
    plan = _final(QUERIES[name](spark, sf_dir))
    assert plan.count("FileScan parquet [o_") == 1


@pytest.mark.parametrize("name", ["kpi_ai_overall", "pay_progression", "kpi_technology_overall", "extract_ai_by_seniority"])
def test_one_segment_is_built_alone(name, spark, sf_dir):
    plan = _plan(QUERIES[name](spark, sf_dir))
    assert "Expand [" not in plan


def test_only_the_wanted_line_columns_are_read(spark, sf_dir):
    lines = {
        name: re.search(r"FileScan parquet \[(l_[^\]]*)\]", _plan(QUERIES[name](spark, sf_dir))).group(1)
        for name in ("region_work", "ai_access_mentions")
    }
    assert re.sub(r"#\d+L?", "", lines["region_work"]) == "l_orderkey,l_quantity"
    assert "l_returnflag" not in lines["ai_access_mentions"] and "l_linenumber" not in lines["ai_access_mentions"]


def test_matrix_median_reuses_the_cells(spark, sf_dir):
    frame = QUERIES["region_model_matrix"](spark, sf_dir)
    frame.collect()
    assert "ReusedExchange [regiao_moradia" in _plan(frame)


def test_reads_are_pruned_and_filters_pushed(spark, sf_dir):
    plan = _plan(QUERIES["pay_by_dimension"](spark, sf_dir))
    assert "o_totalprice" in plan and "PushedFilters: [IsNotNull(c_nationkey), IsNotNull(c_custkey)]" in plan
    customer = re.search(r"FileScan parquet \[(c_[^\]]*)\]", plan).group(1)
    assert "c_name" not in customer and "c_acctbal" not in customer


def test_segments_are_one_expand(spark, sf_dir):
    for name in ("pay_by_dimension", "technology_adoption", "ai_adoption"):
        plan = _plan(QUERIES[name](spark, sf_dir))
        assert plan.count("Expand [") == 1
        assert "ObjectHashAggregate" not in plan and "SortAggregate" not in plan


def test_hot_customer_is_split_by_adaptive_execution(spark, sf_dir, tmp_path):
    """Half of all orders belong to one customer: the join reads that partition in parts."""
    from pyspark.sql import functions as F

    from surveyloom.fixtures.respondents import respondents

    folder = str(tmp_path)
    for table in ("nation", "region", "customer", "lineitem"):
        spark.read.parquet(f"{sf_dir}/{table}.parquet").write.parquet(f"{folder}/{table}.parquet")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    many = orders.withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(400)))).withColumn(
        "o_orderkey", F.col("o_orderkey") * 400 + F.col("i")
    )
    hot = many.withColumn("o_custkey", F.when(F.col("i") % 2 == 0, F.lit(1).cast("long")).otherwise(F.col("o_custkey")))
    hot.drop("i").repartition(16).write.parquet(f"{folder}/orders.parquet")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200KB",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        cells = respondents(spark, folder).groupBy("ano_pesquisa", "cargo_padronizado").count()
        plan = _final(cells)
        total = cells.agg(F.sum("count")).first()[0]
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    assert "skew=true" in plan
    assert total == orders.count() * 400


def test_flagship_is_one_of_the_queries(spark):
    assert "kpi_annual_summary" in entry_points.queries()
