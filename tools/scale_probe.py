"""How query time grows with the data, and what the plan choices are worth.

Writes copies of the order tables with shifted keys into a fresh temporary folder, optionally
with a third of all orders on one customer, and times queries on them:

    python tools/scale_probe.py --copies 1 10 20 --hot
"""

from __future__ import annotations

import argparse
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from surveyloom.checks.registry import QUERIES  # noqa: E402
from surveyloom.fixtures.respondents import load, respondents  # noqa: E402
from surveyloom.plans import gold  # noqa: E402
from surveyloom.session import build_session  # noqa: E402
from surveyloom.vocabulary import PAY_SEGMENTS  # noqa: E402

GROWTH = ("annual_kpis", "pay_by_dimension", "technology_adoption", "market_structure", "excess_duplicates_by_year")
SHIFT = 10_000_000


def write_copies(spark: SparkSession, source: str, copies: int, hot: bool) -> str:
    folder = tempfile.mkdtemp(prefix="scale-")
    keys = {"orders": ["o_orderkey", "o_custkey"], "lineitem": ["l_orderkey"], "customer": ["c_custkey"]}
    for table in ("region", "nation", "customer", "orders", "lineitem"):
        frame = load(spark, source, table)
        if table in keys:
            frame = frame.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
            frame = frame.withColumns({key: F.col(key) + F.col("i") * SHIFT for key in keys[table]}).drop("i")
            if table == "orders" and hot:
                third = F.xxhash64("o_orderkey") % 3 == 0
                customer = F.when(third, F.lit(1).cast("long")).otherwise(F.col("o_custkey"))
                frame = frame.withColumn("o_custkey", customer)
            frame = frame.repartition(16)
        frame.write.parquet(f"{folder}/{table}.parquet")
    return folder


def seconds(frame_of, repeats: int = 3) -> float:
    times = []
    for _ in range(repeats + 1):
        start = time.perf_counter()
        frame_of().write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times[1:]), 2)


def grouping_sets(silver: DataFrame) -> DataFrame:
    """Pay by dimension as grouping sets, with the quantile sketch."""
    dimensions = list(PAY_SEGMENTS.values())
    return silver.groupingSets([["ano_pesquisa", d] for d in dimensions], "ano_pesquisa", *dimensions).agg(
        *[F.grouping(d).alias(f"g_{d}") for d in dimensions],
        F.count("salario_ordem"),
        F.count("salario_ponto_medio"),
        F.round(F.avg("salario_ponto_medio"), 2),
        F.percentile_approx("salario_ordem", 0.5),
    )


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--source", default="/root/testdata/sf0.1")
    parser.add_argument("--copies", type=int, nargs="+", default=[1, 10])
    parser.add_argument("--hot", action="store_true")
    options = parser.parse_args()
    spark = build_session(
        "scale-probe",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "32",
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            # As on a cluster: neither facts nor customers are small enough to broadcast.
            "spark.sql.autoBroadcastJoinThreshold": "50KB",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "50KB",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    for copies in options.copies:
        folder = write_copies(spark, options.source, copies, options.hot)
        times = {name: seconds(lambda n=name: QUERIES[n](spark, folder)) for name in GROWTH}
        print(f"copies={copies} hot={options.hot}", times, flush=True)
    silver = respondents(spark, folder)
    silver.write.parquet(f"{folder}/silver")
    stored = spark.read.parquet(f"{folder}/silver")
    forms = {
        "one expand, histogram median": lambda: gold.pay_by_dimension(stored),
        "grouping sets, quantile sketch": lambda: grouping_sets(stored),
        "market, window total": lambda: gold.market_structure(stored),
        "market, joined total": lambda: gold.market_structure_joined(stored),
    }
    print({name: seconds(form) for name, form in forms.items()}, flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
