"""Spelling variants: a variable-length gram index over the vocabulary.

Grams of 2 to 4 code points are counted over all words; the frequent ones form the dictionary, everything rarer is pruned. From
each place of a word a gram is read on while what has been read is in the dictionary, so rare beginnings give short grams and
frequent ones long grams. Whether a gram is read depends on its own code points alone, so one edit affects only grams that cover
its place. A word's lists are merged from its rarest gram on, and no further than its bound asks: as soon as one edit cannot
affect all grams taken so far (they have no place in common), a word one edit away shares one of them. A gram left of
the edit has the same code points before it in both words, one to the right the same after it, so each list is kept apart by
those. Candidates of a list are verified by edit distance. A list of more than LIST words is kept apart once more, by the word
without each code point that an edit may have touched, so no list is compared pair by pair beyond that size and none is cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveyloom.llm.storage import stored
from surveyloom.llm.text import mix

#: Code points of the shortest and the longest gram.
LEAST, MOST = 2, 4
#: Two grams of a word this long have no place in common; shorter words have no bound.
SHORTEST = MOST + 2
#: At most this many grams are in the dictionary, whatever the vocabulary; it goes to all tasks (12 bytes each).
DICTIONARY = 1 << 18
#: Grams in no more words than this are never in the dictionary.
RARE = 16
#: Words of a list that are compared pair by pair.
LIST = 64
#: Code points that are looked at together.
CELLS = 1 << 18

#: A to Z and the letters of Latin-1 with the two signs among them, after A-Z are lower-cased.
RUNS = "[a-zÀ-ÿ]"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_STEP = np.uint64(0x9E3779B97F4A7C15)
_POSTING = "key long, word string, n long, low int, high int, shorter boolean"


def runs(docs: DataFrame, length: int = 7) -> DataFrame:
    """doc_id, run: every maximal run of at least `length` letters, A-Z lower-cased. A null text has none."""
    lower = F.translate("text", _UPPER, _UPPER.lower())
    return docs.select("doc_id", F.explode(F.regexp_extract_all(lower, F.lit(f"{RUNS}{{{length},}}"), F.lit(0))).alias("run"))


def misspelt(found: DataFrame, rate: int) -> Column:
    """A run with one code point left out where `rate` divides the crc32 of `<doc_id>:<run>` (a null id is empty text)."""
    h = F.crc32(F.concat(F.coalesce(found["doc_id"].cast("string"), F.lit("")), F.lit(":"), found["run"]))
    at = (h % F.length("run")).cast("int")
    left, right = F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run"))
    return F.when(h % rate == 0, F.concat(left, right)).otherwise(found["run"])


def vocabulary(words: DataFrame, length: int = 7, least: int = 2) -> DataFrame:
    """word, n: distinct words (column word) of at least `length` code points that occur at least `least` times."""
    counted = words.filter(F.length("word") >= length).groupBy("word").agg(F.count("*").alias("n"))
    return counted.filter(F.col("n") >= least)


def _equal_lengths(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(numbers, code points) of words of one length, at most about CELLS code points at a time."""
    lengths = np.array([len(w) for w in words], np.int64)
    order = np.argsort(lengths, kind="stable")
    for length in np.unique(lengths):
        same = order[np.searchsorted(lengths[order], length) : np.searchsorted(lengths[order], length, side="right")]
        step = max(1, CELLS // max(int(length), 1))
        for low in range(0, len(same), step):
            numbers = same[low : low + step]
            points = np.frombuffer("".join(words[i] for i in numbers).encode("utf-32-le", "surrogatepass"), np.uint32)
            yield numbers, points.reshape(len(numbers), int(length)).astype(np.uint64)


def _gram_hashes(points: np.ndarray) -> list[np.ndarray]:
    """Hashes of all grams of LEAST to MOST code points; a column for each place."""
    grams, h = [], mix(points + np.uint64(1))
    for size in range(2, MOST + 1):
        places = points.shape[1] - size + 1
        if places < 1:
            break
        h = mix(h[:, :places] * _STEP + points[:, size - 1 :])
        grams.append(h)
    return grams


class Dictionary:
    """Frequent grams: hashes in order, and in how many places each occurs."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray) -> None:
        order = np.argsort(grams)
        self.grams, self.counts = grams[order], counts[order]

    def count(self, grams: np.ndarray) -> np.ndarray:
        """0 for a gram that was pruned."""
        if not len(self.grams):
            return np.zeros(grams.shape, np.int64)
        at = np.minimum(np.searchsorted(self.grams, grams), len(self.grams) - 1)
        return np.where(self.grams[at] == grams, self.counts[at], 0)


def decompose(points: np.ndarray, frequent: Dictionary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(size, hash, count) of the gram at each place of words of one length: as short as the dictionary allows."""
    with np.errstate(over="ignore"):
        hashes = _gram_hashes(points)
    chosen, size = hashes[0].copy(), np.full(hashes[0].shape, LEAST)
    count = frequent.count(chosen)
    reading = count > 0
    for longer in hashes[1:]:
        places = longer.shape[1]
        reading = reading[:, :places]
        chosen[:, :places][reading] = longer[reading]
        size[:, :places][reading] += 1
        count[:, :places][reading] = frequent.count(longer[reading])
        reading = reading & (count[:, :places] > 0)
    return size, chosen, count


def rarest(size: np.ndarray, chosen: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) marks of the grams whose lists are merged: the rarest ones, until one edit cannot affect all of them.

    The order is by count, hash and place, the same in all words, so of two words one edit apart both take the first gram that the
    edit leaves alone.
    """
    order = np.argsort(chosen, axis=1, kind="stable")
    order = np.take_along_axis(order, np.argsort(np.take_along_axis(count, order, 1), axis=1, kind="stable"), 1)
    end = order + np.take_along_axis(size, order, 1)
    apart = np.maximum.accumulate(order, axis=1) >= np.minimum.accumulate(end, axis=1)
    row, rank = np.nonzero(np.arange(order.shape[1]) <= np.argmax(apart, axis=1)[:, None])
    starts, ends = (np.zeros((len(size), size.shape[1] + 2), bool) for _ in range(2))
    starts[row, order[row, rank]] = True
    ends[row, end[row, rank]] = True
    return starts, ends


def _list_keys(points: np.ndarray, frequent: Dictionary) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, bool]]:
    """(rows, keys, low, high, shorter) of the lists each word is in; an edit that the list allows for lies in low to high.

    A list holds words of two neighbouring lengths; shorter tells which of them these are.
    """
    length = points.shape[1]
    starts, ends = rarest(*decompose(points, frequent))
    with np.errstate(over="ignore"):
        powers = np.multiply.accumulate(np.full(length, _STEP))
        value = mix(points + np.uint64(1))
        before = np.cumsum(value * powers, axis=1)
        after = np.cumsum(value[:, ::-1] * powers, axis=1)
        for shorter in (True, False):
            least = np.uint64(length if shorter else length - 1)
            row, end = np.nonzero(ends)
            yield row, mix(mix(before[row, end - 1]) * _STEP + np.uint64(2) * least), end, np.full(len(row), length), shorter
            row, start = np.nonzero(starts)
            keys = mix(mix(after[row, length - 1 - start]) * _STEP + np.uint64(2) * least + np.uint64(1))
            # In the longer word the gram starts behind the code point that the shorter one lacks.
            yield row, keys, np.zeros(len(row), np.int64), start, shorter


def dictionary(words: DataFrame) -> Dictionary:
    """The frequent grams of all words. What is frequent follows from the number of places, so that at most DICTIONARY are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, points in _equal_lengths(batch.column(0).to_pylist()):
                with np.errstate(over="ignore"):
                    grams, counts = np.unique(np.concatenate([h.ravel() for h in _gram_hashes(points)]), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(grams.view(np.int64)), pa.array(counts)], names=["gram", "n"])

    places = sum((F.length("word") - (size - 1) for size in range(LEAST, MOST + 1)), F.lit(0))
    total = words.agg(F.sum(places.cast("long"))).first()[0] or 0
    counted = words.select("word").mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    kept = counted.filter(F.col("n") > max(RARE, total // DICTIONARY)).toArrow()
    return Dictionary(kept.column("gram").to_numpy().view(np.uint64), kept.column("n").to_numpy())


def postings(words: DataFrame, frequent: Dictionary) -> DataFrame:
    """A row for each list that a word (word, n) is in."""
    shared = words.sparkSession.sparkContext.broadcast((frequent.grams, frequent.counts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Dictionary(*shared.value)
        for batch in batches:
            for numbers, points in _equal_lengths(batch.column(0).to_pylist()):
                for row, keys, low, high, shorter in _list_keys(points, known):
                    own = batch.take(pa.array(numbers[row]))
                    ranges = [pa.array(v.astype(np.int32)) for v in (low, high)]
                    columns = [pa.array(keys.view(np.int64)), own.column(0), own.column(1), *ranges, pa.array(np.full(len(row), shorter))]
                    yield pa.RecordBatch.from_arrays(columns, names=["key", "word", "n", "low", "high", "shorter"])

    return words.select("word", "n").mapInArrow(run, _POSTING)


def _split_long_lists(lists: DataFrame) -> DataFrame:
    """Lists of more than LIST words, kept apart by the word without each code point an edit may have touched."""
    long = lists.groupBy("key").agg(F.count("*").alias("members")).filter(F.col("members") > LIST).select("key", F.lit(True).alias("long"))
    marked = lists.join(stored(long, "long_lists"), "key", "left")
    without = F.expr(
        "transform(IF(high > low, sequence(low, high - 1), CAST(array() AS array<int>)),"
        " i -> xxhash64(key, concat(substring(word, 1, i), substring(word, i + 2))))"
    )
    itself = F.when(F.col("shorter"), F.array(F.xxhash64("key", "word"))).otherwise(F.array().cast("array<bigint>"))
    keys = F.when(F.col("long"), F.concat(without, itself)).otherwise(F.array("key"))
    return marked.select(F.explode(keys).alias("key"), "word", "n", "shorter")


def near_pairs(words: DataFrame) -> DataFrame:
    """word, n, other, other_n: pairs of words (word, n) one edit apart, each in both directions.

    Words are distinct, not null and have at least SHORTEST code points.
    """
    lists = _split_long_lists(postings(words, dictionary(words)))
    left, right = lists.alias("a"), lists.alias("b")
    alike = (
        (F.col("a.key") == F.col("b.key"))
        & (F.col("a.word") < F.col("b.word"))
        & (F.col("a.shorter") | F.col("b.shorter"))
        & (F.levenshtein("a.word", "b.word", 1) == 1)
    )
    pairs = left.join(right, alike).select("a.word", "a.n", F.col("b.word").alias("other"), F.col("b.n").alias("other_n")).distinct()
    pairs = stored(pairs, "near_words")
    return pairs.unionByName(pairs.select(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n")))


def _roots(forms: DataFrame) -> DataFrame:
    """word, root for every word that has a form. A form occurs more often than its word, so the way ends.

    Every round doubles the steps taken; `factor` 10 and 10**18 occurrences allow 18 of them, five rounds.
    """
    ways = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = ways.select(F.col("word").alias("root"), F.col("root").alias("end"))
        moved = ways.join(further, "root", "left").select("word", F.coalesce("end", "root").alias("root"), F.col("end").isNotNull().alias("moved"))
        moved = stored(moved, "roots")
        ways = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return ways


def variants(words: DataFrame, factor: int = 10) -> DataFrame:
    """word, form, root, n, n_near, form_n for every word of a vocabulary (word, n; distinct words of SHORTEST code points or more).

    A word's form is the word one edit away that occurs most often (ties: the smallest in code-point order) if it occurs at
    least `factor` times as often, else null; root follows forms to the last one. An empty vocabulary gives no rows.
    Words differ by their code points; accents and case are not folded.
    """
    if factor < 2:
        raise ValueError("a form must occur more often than its word")
    words = stored(words.select("word", "n"), "vocabulary")
    near = near_pairs(words).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best")
    )
    joined = words.join(near, "word", "left")
    chosen = F.when(-F.col("best.less") >= factor * F.col("n"), F.col("best.other"))
    scored = stored(
        joined.select(
            "word", chosen.alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(chosen.isNotNull(), -F.col("best.less")).alias("form_n")
        ),
        "forms",
    )
    roots = _roots(scored.filter("form IS NOT NULL"))
    return scored.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def document_variants(docs: DataFrame, rate: int = 31) -> DataFrame:
    """Variants among the words of whole texts, with one run in `rate` misspelt on purpose."""
    found = runs(docs)
    return variants(vocabulary(found.select(misspelt(found, rate).alias("word"))))
