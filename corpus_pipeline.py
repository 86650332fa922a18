"""From raw documents to a training mix, in five stages. Each stage takes (spark, docs, sf_dir) and returns a frame, which is
stored before the next stage reads it. All stages but the last return the columns of documents.

Reference tables (labels, benchmark) are read from sf_dir; everything else comes from the stage before. Each stage keeps rows
with nulls as its operator defines them, and an empty table passes through.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.llm import decontaminate, mixing, neardup, quality, secrets
from surveyloom.llm.storage import stored

#: Documents below this probability of good quality go, as operator 4 predicts.
LEAST_QUALITY = 0.5
#: Near duplicates: words of a shingle and percent of similarity.
SHINGLE, PERCENT = 5, 80
#: A column that the stages use among themselves.
KEY = "_row_key"


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents that the combined views call bad go."""
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score(docs, model).filter(F.col("quality_score") >= LEAST_QUALITY).drop("quality_score")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: of each group the document with the least doc_id stays; of rows that repeat a doc_id, the first by text."""
    found = stored(neardup.near_duplicates(docs, SHINGLE, PERCENT), "groups")
    dropped = found.filter(~F.col("kept")).select("doc_id").distinct()
    repeated = found.filter(F.col("kept") & F.col("doc_id").isNotNull()).groupBy("doc_id").count().filter("count > 1").select("doc_id")
    rest = docs.join(dropped.unionByName(repeated).distinct(), "doc_id", "left_anti")
    again = docs.join(repeated, "doc_id", "left_semi").join(dropped, "doc_id", "left_anti")
    # Equal rows but for the order of their columns: the least of all columns, text first, so that reruns agree.
    others = [c for c in docs.columns if c != "doc_id"]
    least = again.groupBy("doc_id").agg(F.min(F.struct(*sorted(others, key=lambda c: c != "text"))).alias("row"))
    return rest.unionByName(least.select("doc_id", "row.*").select(*docs.columns))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents with a twentieth of their words inside benchmark windows go.

    The operator sees a key of doc_id and text instead of doc_id, so a row without an id goes as well, and of rows that share an id only
    those whose text is contaminated.
    """
    keyed = docs.withColumn(KEY, F.xxhash64("doc_id", "text"))
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.matches(keyed.select(F.col(KEY).alias("doc_id"), "text"), items)
    hit = stored(found.filter(decontaminate.contaminated()).select(F.col("doc_id").alias(KEY)).distinct(), "contaminated")
    return keyed.join(hit, KEY, "left_anti").select(*docs.columns)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: every document stays; each secret becomes a mark."""
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: the documents that the mix takes, with copies (how often) and the figures behind it."""
    sized = mixing.sizes(docs)
    narrow = stored(sized.select("source", "size", "place"), "sizes")
    return mixing.mixed(sized, mixing.plan(narrow)).filter("copies > 0")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", reject_low_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
]

#: The classifier and the similarity join have no SQL form.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is stored and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
