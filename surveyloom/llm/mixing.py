"""Mixing sources to target weights: capped water-filling, then seeded whole and fractional repetitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surveyloom.llm.storage import stored

#: A word of the size measure.
WORD = r"[^\x20\x09-\x0D]+"
#: Hexadecimal digits of the seeded digest that place a document: 4,096 places, so a source's mix is within 1/8,192 of its
#: size of the target, or half a document.
PLACES = 3


def sizes(docs: DataFrame, seed: int = 3) -> DataFrame:
    """`docs` with size (words; null text: 0) and place, which depends on the seed and doc_id only."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    return docs.withColumns(
        {
            "size": F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long"),
            "place": F.substring(digest, 1, PLACES),
        }
    )


def ranked(frame: DataFrame, *order: Column) -> DataFrame:
    """`frame` with `rank` (from 0) over all rows: a range sort, and one count for each partition on the driver."""
    parted = stored(frame.orderBy(*order).withColumns({"part": F.spark_partition_id(), "within": F.monotonically_increasing_id()}), "ranked")
    counts = sorted(parted.groupBy("part").count().collect())
    offset, offsets = 0, {}
    for part, count in counts:
        offsets[part] = offset
        offset += count
    low = F.col("within") - F.shiftleft(F.col("part").cast("long"), 33)
    base = F.element_at(F.create_map(*(F.lit(x).cast("long") for pair in offsets.items() for x in pair)), F.col("part").cast("long")) if offsets else F.lit(0)
    return parted.withColumn("rank", low + base).drop("part", "within")


def plan(sized: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, cap: int = 2) -> DataFrame:
    """source, source_size, target, whole and cut for each source of sized rows (source, size, place).

    Sources by code point, null last, take the weights in turn; together they get `share` of all words. A target above `cap`
    times the size of its source is clamped and the excess goes to the others by weight, until none is above. Only sums go to
    the driver, whatever the number of sources. A source takes `whole` full passes and one over the places up to `cut`.
    """
    histogram = stored(sized.groupBy("source", "place").agg(F.sum("size").alias("mass")), "places")
    sources = histogram.groupBy("source").agg(F.sum("mass").alias("source_size"))
    turn = F.element_at(F.array(*(F.lit(w) for w in weights)), (F.col("rank") % len(weights)).cast("int") + 1)
    sources = ranked(sources, F.col("source").asc_nulls_last()).withColumn("weight", turn).drop("rank")

    total, free = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    rate, clamped = (share * total / free if free else 0.0), 0
    while free:
        over = F.col("weight") * F.lit(rate) > cap * F.col("source_size")
        n, full, rest = sources.agg(
            F.count(F.when(over, 1)), F.coalesce(F.sum(F.when(over, F.col("source_size"))), F.lit(0)), F.sum(F.when(~over, F.col("weight")))
        ).first()
        if n == clamped or not rest:
            break
        rate, clamped = (share * total - cap * full) / rest, n
    target = F.least(F.col("weight") * F.lit(float(rate)), (cap * F.col("source_size")).cast("double"))
    sources = sources.withColumn("target", target)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    sources = sources.withColumn("whole", whole.cast("long")).drop("weight")

    below = F.sum("mass").over(Window.partitionBy("source").orderBy("place")) - F.col("mass") / 2
    rest = F.col("target") - F.col("whole") * F.col("source_size")
    joined = histogram.withColumnRenamed("source", "s").join(sources, F.col("s").eqNullSafe(F.col("source"))).select("source", "place", "mass", rest.alias("rest"))
    cuts = joined.withColumn("below", below).filter((F.col("rest") > 0) & (F.col("below") <= F.col("rest"))).groupBy("source").agg(F.max("place").alias("cut"))
    cuts = cuts.withColumnRenamed("source", "s")
    return stored(sources.join(cuts, F.col("source").eqNullSafe(F.col("s")), "left").drop("s"), "mix-plan")


def mixed(sized: DataFrame, sources: DataFrame) -> DataFrame:
    """Sized rows with source_size, target, copies (how often the mix takes the row) and taken (its words in the mix).

    No row is taken more often than the cap. Rows with one doc_id share their place. A null source is a source of its own; a
    source without words has target 0 and keeps its rows with 0 copies.
    """
    theirs = sources.withColumnRenamed("source", "their_source")
    both = sized.join(theirs, F.col("source").eqNullSafe(F.col("their_source"))).drop("their_source")
    copies = F.col("whole") + F.when(F.col("place") <= F.col("cut"), 1).otherwise(0)
    return both.withColumn("copies", copies.cast("long")).withColumn("taken", F.col("size") * F.col("copies")).drop("whole", "cut", "place")


def mix(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, cap: int = 2, seed: int = 3) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken of every row of docs (doc_id, text, source).

    Nulls count as above, repeated rows as rows, an empty table gives no rows; other columns are ignored. The text is read once.
    """
    sized = stored(sizes(docs.select("doc_id", "text", "source"), seed).drop("text"), "sizes")
    return mixed(sized, plan(sized, weights, share, cap))


#: DuckDB SQL of `mix` on the table documents with the default arguments.
MIX_SQL = r"""
WITH sized AS MATERIALIZED (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         left(md5('3:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 3) AS place
  FROM documents),
places AS MATERIALIZED (SELECT source, place, CAST(sum(size) AS BIGINT) AS mass FROM sized GROUP BY ALL),
sources AS (SELECT source, CAST(sum(mass) AS BIGINT) AS source_size FROM places GROUP BY ALL),
weighed AS (
  SELECT *, [3, 1, 2][CAST((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 AS INTEGER) + 1] AS weight FROM sources),
queue AS (
  SELECT *, row_number() OVER w AS turn, sum(source_size) OVER () AS total,
         sum(source_size) OVER w - source_size AS full_before, sum(weight) OVER () - sum(weight) OVER w + weight AS free_before
  FROM weighed WINDOW w AS (ORDER BY CAST(source_size AS DOUBLE) / weight, encode(source) NULLS LAST ROWS UNBOUNDED PRECEDING)),
rates AS (SELECT *, (CAST(1.5 AS DOUBLE) * total - 2 * full_before) / free_before AS rate FROM queue),
level AS (SELECT arg_min(rate, turn) AS rate FROM rates WHERE weight * rate <= 2 * source_size),
targets AS (
  SELECT source, source_size, least(weight * (SELECT rate FROM level), CAST(2 * source_size AS DOUBLE)) AS target FROM weighed),
wholes AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM targets),
cuts AS (
  SELECT source, max(place) AS cut FROM (
    SELECT p.source, p.place, sum(p.mass) OVER (PARTITION BY p.source ORDER BY p.place) - CAST(p.mass AS DOUBLE) / 2 AS below,
           t.target - t.whole * t.source_size AS rest
    FROM places p JOIN wholes t ON p.source IS NOT DISTINCT FROM t.source)
  WHERE rest > 0 AND below <= rest GROUP BY source)
SELECT s.doc_id, s.size, t.source_size, t.target,
       s.size * (t.whole + CASE WHEN s.place <= c.cut THEN 1 ELSE 0 END) AS taken
FROM sized s JOIN wholes t ON s.source IS NOT DISTINCT FROM t.source LEFT JOIN cuts c ON s.source IS NOT DISTINCT FROM c.source
"""
