"""What each filter of a cascade removes, in every order: decision diagrams over the documents' failure masks.

Spark counts the documents of each part by mask (one bit for each filter that fails them). From these counts a part's
diagram is built: a level for each filter, a node's edges lead to the documents that pass and that fail, equal nodes are shared, a node
that nobody fails is left out, and each node weighs the documents below it. All orders of the filters are
walked by swaps of two neighbouring levels; in each, the path on which everything passes gives the steps.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import permutations
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveyloom.llm.storage import stored

_SPACE = r"[\x20\x09-\x0D]+"
_STEPS = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"
)


def text_filters() -> dict[str, Column]:
    """Whether a document fails each filter that looks at its text alone (a null text is empty)."""
    text = F.coalesce("text", F.lit(""))
    words = F.filter(F.split(text, _SPACE), lambda word: word != "")
    count, distinct = F.size("words"), F.size(F.array_distinct("words"))
    capitals = F.length("whole") - F.length(F.translate("whole", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return {
        "whole": text,
        "words": words,
        "A": count < 100,
        "B": 100 * distinct < 80 * count,
        "C": 100 * capitals > 10 * F.length("whole"),
        "D": F.col("whole").rlike("[#$%&*|]"),
    }


FILTERS = "ABCDE"


def failures(docs: DataFrame) -> DataFrame:
    """doc_id, part, mask of every document: bit i is set if filter i of ABCDE fails it.

    E fails a text that a row with a smaller doc_id has too, anywhere in the table. A null doc_id is neither smaller nor larger, so
    such a row neither fails E nor makes another fail; rows that repeat a doc_id and a text do not fail each other. A null lang is the
    empty part, a null text an empty one.
    """
    parts = text_filters()
    facts = docs.select(F.col("doc_id").cast("long"), "lang", parts["whole"].alias("whole"), parts["words"].alias("words"))
    bits = reduce(lambda a, b: a + b, (F.when(parts[name], 1 << i).otherwise(0) for i, name in enumerate("ABCD")))
    facts = stored(
        facts.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), bits.alias("mask"), F.unhex(F.sha2("whole", 256)).alias("digest")),
        "masks",
    )
    # Only texts under several ids are looked up again; a text with a third of all rows is one row here.
    repeated = facts.groupBy("digest").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).filter("least < most")
    joined = facts.join(repeated.select("digest", "least"), "digest", "left")
    return joined.select("doc_id", "part", (F.col("mask") + F.when(F.col("doc_id") > F.col("least"), 16).otherwise(0)).alias("mask"))


def cells(failed: DataFrame, labels: DataFrame) -> DataFrame:
    """part, masks: for each part the documents, good ones and toxic ones of each mask. A labelled id counts once, with its largest labels."""
    marks = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    marks = marks.filter("good = 1 OR toxic = 1")
    # Ids are spread before they meet the labels; the rows of null ids meet none and stay where they are.
    known = failed.filter("doc_id IS NOT NULL").join(marks, "doc_id", "left")
    unknown = failed.filter("doc_id IS NULL").select("doc_id", "part", "mask", F.lit(0).alias("good"), F.lit(0).alias("toxic"))
    counted = known.unionByName(unknown).groupBy("part", "mask").agg(
        F.count("*").alias("n"),
        F.sum(F.coalesce("good", F.lit(0)).cast("long")).alias("good"),
        F.sum(F.coalesce("toxic", F.lit(0)).cast("long")).alias("toxic"),
    )
    return counted.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))


class Weight(NamedTuple):
    n: int
    good: int
    toxic: int

    def __add__(self, other: tuple) -> Weight:  # type: ignore[override]
        return Weight(self.n + other[0], self.good + other[1], self.toxic + other[2])


NOTHING = Weight(0, 0, 0)


class Diagram:
    """An ordered diagram over the filters, with shared nodes.

    A node is a number; 0 is the diagram without documents. An inner node is (filter, who passes, who fails) with at least one
    document that fails, a leaf is a weight. So a filter that fails nobody below has no node there.
    """

    def __init__(self, weights: dict[int, Weight], filters: int) -> None:
        self.order = list(range(filters))
        self.nodes: list[tuple] = [(NOTHING,)]
        self.weight: list[Weight] = [NOTHING]
        self.known: dict[tuple, int] = {(NOTHING,): 0}
        self.root = self._build(weights, 0)

    def _add(self, node: tuple, weight: Weight) -> int:
        if node not in self.known:
            self.known[node] = len(self.nodes)
            self.nodes.append(node)
            self.weight.append(weight)
        return self.known[node]

    def _leaf(self, weight: Weight) -> int:
        return self._add((weight,), weight)

    def _inner(self, name: int, passes: int, fails: int) -> int:
        return self._add((name, passes, fails), self.weight[passes] + self.weight[fails]) if fails else passes

    def _build(self, weights: dict[int, Weight], level: int) -> int:
        if not weights:
            return 0
        if level == len(self.order):
            return self._leaf(reduce(Weight.__add__, weights.values()))
        bit = 1 << self.order[level]
        sides = [{mask: w for mask, w in weights.items() if bool(mask & bit) == fails} for fails in (False, True)]
        return self._inner(self.order[level], *(self._build(side, level + 1) for side in sides))

    def edges(self, node: int, name: int) -> tuple[int, int]:
        """Who passes and who fails a filter at a node that stands at its level or below."""
        found = self.nodes[node]
        return (found[1], found[2]) if len(found) == 3 and found[0] == name else (node, 0)

    def swap(self, level: int) -> None:
        """Exchange the filters of a level and the next; levels above and below keep their filters."""
        upper, lower = self.order[level], self.order[level + 1]
        above, done = set(self.order[:level]), {}

        def moved(node: int) -> int:
            if node not in done:
                found = self.nodes[node]
                if len(found) == 3 and found[0] in above:
                    done[node] = self._inner(found[0], moved(found[1]), moved(found[2]))
                elif len(found) == 3 and found[0] in (upper, lower):
                    passes, fails = self.edges(node, upper)
                    (pp, pf), (fp, ff) = self.edges(passes, lower), self.edges(fails, lower)
                    done[node] = self._inner(lower, self._inner(upper, pp, fp), self._inner(upper, pf, ff))
                else:
                    done[node] = node
            return done[node]

        self.root = moved(self.root)
        self.order[level], self.order[level + 1] = lower, upper

    def steps(self) -> list[tuple[Weight, Weight]]:
        """(kept, removed) of each filter in the present order, along the path on which everything passes."""
        node, path = self.root, []
        for name in self.order:
            node, fails = self.edges(node, name)
            path.append((self.weight[node], self.weight[fails]))
        return path


def neighbour_swaps(size: int) -> Iterator[int]:
    """Levels to swap, one after another, so that every order of `size` filters comes up once."""
    if size < 2:
        return
    inner = neighbour_swaps(size - 1)
    down = True
    while True:
        yield from range(size - 2, -1, -1) if down else range(size - 1)
        swap = next(inner, None)
        if swap is None:
            return
        # The last filter stands in front of the others or behind them.
        yield swap + 1 if down else swap
        down = not down


def audit_part(weights: dict[int, Weight], names: str) -> list[tuple]:
    """filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley for every order and step."""
    diagram = Diagram(weights, len(names))
    found = {tuple(diagram.order): diagram.steps()}
    for level in neighbour_swaps(len(names)):
        diagram.swap(level)
        found[tuple(diagram.order)] = diagram.steps()
    total, alone, shapley = {}, {}, dict.fromkeys(range(len(names)), 0)
    for order, steps in found.items():
        total[order[0]] = steps[0][1].n
        alone[order[-1]] = steps[-1][1].n
        for name, (_, removed) in zip(order, steps):
            shapley[name] += removed.n
    return [
        ("".join(names[i] for i in order), at + 1, kept.n, removed.n, total[name] - removed.n, alone[name], removed.good, removed.toxic, shapley[name])
        for order in permutations(range(len(names)))
        for at, (name, (kept, removed)) in enumerate(zip(order, found[order]))
    ]


def audit(counted: DataFrame, names: str = FILTERS) -> DataFrame:
    """Every order and step of the filters `names` for every part of `counted` (part, masks)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for part, masks in zip(frame["part"], frame["masks"]):
                weights = {m["mask"]: Weight(m["n"], m["good"], m["toxic"]) for m in masks}
                yield pd.DataFrame([(part, *row) for row in audit_part(weights, names)], columns=[c.split()[0] for c in _STEPS.split(", ")])

    return counted.mapInPandas(run, _STEPS)


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of the five text filters over documents; an empty table has no parts and no rows."""
    return audit(cells(failures(docs), labels))


AUDIT_SQL = r"""
WITH facts AS MATERIALIZED (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS whole,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents
), firsts AS (
  SELECT whole, min(doc_id) AS least FROM facts GROUP BY whole
), marks AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), failed AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         len(words) < 100 AS a,
         100 * len(list_distinct(words)) < 80 * len(words) AS b,
         100 * length(regexp_replace(whole, '[^A-Z]', '', 'g')) > 10 * length(whole) AS c,
         regexp_matches(whole, '[#$%&*|]') AS d,
         coalesce(f.doc_id > least, false) AS e
  FROM facts f JOIN firsts USING (whole) LEFT JOIN marks m ON f.doc_id = m.doc_id
), cells AS MATERIALIZED (
  SELECT part, (CASE WHEN a THEN 'A' ELSE '' END) || (CASE WHEN b THEN 'B' ELSE '' END) || (CASE WHEN c THEN 'C' ELSE '' END)
         || (CASE WHEN d THEN 'D' ELSE '' END) || (CASE WHEN e THEN 'E' ELSE '' END) AS fails,
         count(*) AS n, sum(good) AS good, sum(toxic) AS toxic
  FROM failed GROUP BY ALL
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), orders AS (
  SELECT p.x || q.x || r.x || s.x || t.x AS filter_order
  FROM letters p, letters q, letters r, letters s, letters t
  WHERE len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5
), steps AS (
  SELECT part, filter_order, step, substr(filter_order, step, 1) AS letter,
         sum(CASE WHEN translate(fails, left(filter_order, step), '') = fails THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN hit AND first THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN hit AND NOT first THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN fails = substr(filter_order, step, 1) THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN hit AND first THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN hit AND first THEN toxic ELSE 0 END) AS toxic_lost
  FROM (
    SELECT *, contains(fails, substr(filter_order, step, 1)) AS hit,
           translate(fails, left(filter_order, step - 1), '') = fails AS first
    FROM cells, orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)
  ) GROUP BY part, filter_order, step
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM steps
"""
