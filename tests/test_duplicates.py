"""Copies of wide rows: fingerprints first, fields where they repeat."""

import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from surveyloom.operators import duplicates
from surveyloom.operators.duplicates import copies, duplicate_profile, repeated_rows

ODD = [
    (1, None, "a", 0.0, datetime(2024, 1, 1, 0, 0, 0, 1)),
    (1, None, "a", -0.0, datetime(2024, 1, 1, 0, 0, 0, 1)),
    (1, None, "a", 0.0, datetime(2024, 1, 1, 0, 0, 0, 2)),
    (None, 1, "a", 0.0, datetime(2024, 1, 1, 0, 0, 0, 1)),
    (None, None, None, math.nan, None),
    (None, None, None, math.nan, None),
    (None, None, None, None, None),
    (None, None, "", None, None),
    (None, None, None, None, None),
]
SCHEMA = "a int, b int, c string, d double, e timestamp"


@pytest.fixture(scope="module")
def wide(spark):
    """Odd rows beside ten further columns, some of them with names that need quotes."""
    frame = spark.createDataFrame(ODD, SCHEMA)
    return frame.select("*", *[F.lit(f"v{i}").alias(f"p.{i} `x`") for i in range(10)])


@pytest.fixture(params=["hashes", "one hash for all"])
def hashing(request, monkeypatch):
    """Rows whose fingerprints are all equal must still be told apart by their fields."""
    if request.param != "hashes":
        same = lambda names: [F.lit(7).cast("long").alias(duplicates._FIRST), F.lit(1).cast("long").alias(duplicates._SECOND)]
        monkeypatch.setattr(duplicates, "fingerprint", same)


def test_fields_decide(wide, hashing, rows):
    assert duplicate_profile(wide).first()[:] == (9, 3)
    per_key = {r.a: (r.registros, r.duplicados_excedentes) for r in duplicate_profile(wide, keys=["a"]).collect()}
    assert per_key == {1: (3, 1), None: (6, 2)}
    found = repeated_rows(wide)
    assert found.columns == [*wide.columns, "copies"] and sorted(r.copies for r in found.collect()) == [2, 2, 2]
    assert found.count() == copies(wide).filter("copies > 1").count()


def test_measures_are_summed_over_all_rows(wide, hashing, monkeypatch):
    measures = {"vazios": F.when(F.col("b").isNull(), 1).otherwise(0)}
    wanted = {1: (3, 1, 3), None: (6, 2, 5)}
    for narrow in (0, 10**6):
        monkeypatch.setattr(duplicates, "NARROW_BYTES", narrow)
        found = duplicate_profile(wide, keys=["a"], measures=measures).collect()
        assert {r.a: (r.registros, r.duplicados_excedentes, r.vazios) for r in found} == wanted


def test_empty_and_hot(spark, wide, hashing):
    assert duplicate_profile(wide.limit(0)).first()[:] == (0, 0)
    hot = spark.range(20_000).select(*[(F.col("id") % 3 * 0 if i else F.greatest(F.lit(0), F.col("id") - 10_000)).alias(f"c{i}") for i in range(12)])
    assert duplicate_profile(hot).first()[:] == (20_000, 10_000)


def test_both_ways_count_alike_on_real_rows(silver, rows, monkeypatch):
    frame = silver.unionByName(silver.filter("id_respondente % 7 = 0"))
    two_phases = rows(duplicate_profile(frame, keys=["ano_pesquisa"]))
    again = rows(repeated_rows(frame))
    monkeypatch.setattr(duplicates, "NARROW_BYTES", 10**6)
    assert two_phases == rows(duplicate_profile(frame, keys=["ano_pesquisa"]))
    assert again == rows(repeated_rows(frame))


def _shuffled(frame):
    """Bytes that all exchanges of rows wrote."""
    frame.collect()
    todo, total = [frame._jdf.queryExecution().executedPlan()], 0
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(node.plan())
        elif name != "ReusedExchangeExec":
            if name == "ShuffleExchangeExec":
                total += node.metrics().apply("shuffleBytesWritten").value()
            todo.extend(node.children().apply(i) for i in range(node.children().size()))
    return total


def test_an_edition_of_403_columns_is_hardly_shuffled(spark, monkeypatch, tmp_path):
    base = spark.range(4000).select("id", *[F.sha2(F.concat(F.lit(f"{i}-"), "id"), 256).alias(f"c{i}") for i in range(402)])
    base.unionByName(base.filter("id % 1000 = 0")).repartition(4).write.parquet(str(tmp_path / "edition"))
    edition = spark.read.parquet(str(tmp_path / "edition"))
    found = duplicate_profile(edition)
    assert found.first()[:] == (4004, 4)
    light = _shuffled(found)
    monkeypatch.setattr(duplicates, "NARROW_BYTES", 10**6)
    whole = duplicate_profile(edition)
    assert whole.first()[:] == (4004, 4)
    assert light < 0.1 * _shuffled(whole)


def test_measures_do_not_shuffle_the_fingerprints_again(spark, tmp_path):
    rows = spark.range(20_000).select("id", F.expr("id % 3").alias("k"), *[(F.col("id") + i).alias(f"c{i}") for i in range(9)])
    rows.unionByName(rows.filter("id % 100 = 0")).write.parquet(str(tmp_path / "r"))
    frame = spark.read.parquet(str(tmp_path / "r"))
    measures = {"pares": F.when(F.col("id") % 2 == 0, 1).otherwise(0)}
    found = duplicate_profile(frame, keys=["k"], measures=measures)
    assert {(r.registros, r.duplicados_excedentes, r.pares) for r in found.collect()} == {(6734, 67, 3401), (6734, 67, 3400), (6732, 66, 3399)}
    assert _shuffled(found) < 1.2 * _shuffled(duplicate_profile(frame, keys=["k"]))
