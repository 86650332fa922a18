"""Document fingerprints: threshold-scaled sketches of word shingles.

A sketch keeps every shingle hash below a fixed fraction of all hashes, so its size follows the text, and its LEAST least hashes
in any case, so a short text is kept whole. The sketches of parts merge to the sketch of the whole. Two sketches compare below
the smaller of their limits, so what they say of two texts follows from the two fingerprints alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyloom.llm.text import EXACT_WORDS, row_groups, shingles, text_bytes, words

SIZE = 5
#: One hash in FRACTION is kept.
FRACTION = 8
#: So many least hashes are kept in any case.
LEAST = 64
#: Ids that are drawn for each partition, to cut the order by doc_id into even ranges; a small table has fewer partitions.
DRAWN, LEAST_ROWS = 40, 64

_LIMIT = np.uint64(2**64 // FRACTION)
_OUT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def sketch(hashes: np.ndarray) -> np.ndarray:
    """Sorted distinct hashes below the limit, and the LEAST least ones."""
    every = np.unique(hashes)
    return every[: max(LEAST, int(np.searchsorted(every, _LIMIT)))]


def limit(kept: np.ndarray) -> int:
    """Every hash of the text below it is in the sketch. A sketch of fewer than LEAST hashes is the whole text."""
    return 2**64 if len(kept) < LEAST else max(int(_LIMIT), int(kept[-1]) + 1)


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of both shingle sets together."""
    return sketch(np.concatenate([a, b]))


def sketches(texts: list[str], size: int = SIZE) -> list[np.ndarray]:
    data, offsets = text_bytes(pa.array(texts, pa.large_string()))
    out = []
    for low, high in row_groups(offsets):
        own = offsets[low : high + 1]
        values, first = shingles(words(data[own[0] : own[-1]], own - own[0], EXACT_WORDS), size)
        for i in range(high - low):
            out.append(sketch(values[first[i] : first[i + 1]]))
    return out


def written(kept: np.ndarray) -> str:
    """Sixteen hexadecimal digits for each hash, in rising order."""
    return kept.astype(">u8").tobytes().hex()


def read(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint), ">u8").astype(np.uint64)


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """Share of the smaller shingle set that lies in the other; 1 if both are empty, 0 if one is.

    It is exact for sketches that are whole texts. Otherwise it is estimated from the hashes below both limits, and 0 where the
    smaller set has none there: nothing shows that they have anything in common.
    """
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    end = min(limit(a), limit(b))
    one, other = (x if end == 2**64 else x[: np.searchsorted(x, np.uint64(end))] for x in (a, b))
    least = min(len(one), len(other))
    return len(np.intersect1d(one, other, assume_unique=True)) / least if least else 0.0


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fingerprint of every row of docs (doc_id, text); a null text is an empty one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([written(s) for s in sketches(texts)], pa.string())], names=["doc_id", "fingerprint"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, fingerprint string")


def edited_text(text: str, following: str) -> str:
    """The last half replaced by the beginning of the text that follows."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _bounds(ids: DataFrame) -> np.ndarray:
    """Ids that cut the table into ranges of about as many rows, one for each partition of a shuffle."""
    rows = ids.count()
    parts = min(int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // LEAST_ROWS))
    if parts < 2:
        return np.zeros(0)
    drawn = ids.filter("doc_id IS NOT NULL").sample(min(1.0, DRAWN * parts / rows), seed=5).toArrow().column(0).to_numpy()
    return np.unique(np.quantile(drawn, np.arange(1, parts) / parts, method="lower")) if len(drawn) else np.zeros(0)


def in_sequence(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) with part and helper, sorted inside partitions so that each row is followed by its successor.

    The order is doc_id descending, nulls last, equal ids by text. It is cut into ranges, one for each partition; the first rows of
    a range are dealt to the range before it once more, as its helpers (the first range's to the last). The driver holds
    one bound and one id for each partition, as a sort does.
    """
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    bounds = _bounds(ids)

    def part_of(numbers: pd.Series) -> np.ndarray:
        low = pd.isna(numbers).to_numpy()
        place = np.searchsorted(bounds, numbers.fillna(0).to_numpy(np.int64), side="right")
        return len(bounds) - np.where(low, 0, place)

    @F.pandas_udf("int")
    def part(numbers: pd.Series) -> pd.Series:
        return pd.Series(part_of(numbers))

    found = ids.groupBy(part("doc_id").alias("part")).agg(F.max("doc_id").alias("head")).orderBy("part").collect()
    heads = {p: head for p, head in found}
    place = {p: i for i, p in enumerate(heads)}

    @F.pandas_udf("array<int>")
    def dealt(numbers: pd.Series) -> pd.Series:
        missing = pd.isna(numbers)
        return pd.Series([
            [place[p], (place[p] - 1) % len(place)] if (heads[p] is None if none else heads[p] == n) else [place[p]]
            for p, n, none in zip(part_of(numbers).tolist(), numbers.fillna(0).astype("int64").tolist(), missing.tolist())
        ])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("dealt", dealt("doc_id"))
    rows = rows.select("doc_id", "text", F.posexplode("dealt").alias("helper", "part"))
    return rows.repartitionById(len(place) or 1, "part").sortWithinPartitions("part", "helper", F.col("doc_id").desc_nulls_last(), "text")


def edit_report(docs: DataFrame) -> DataFrame:
    """The columns of op5 for every row of docs (doc_id, text).

    A null text is an empty one. A null doc_id is the last; rows that repeat a doc_id follow each other by text. A single row
    follows itself. An empty table gives no rows; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                rows.append(row)
                if len(rows) > 512:
                    yield _block(rows)
                    rows = rows[-1:]
        yield _block(rows)

    return in_sequence(docs).select("doc_id", "text", "helper").mapInArrow(run, _OUT)


def _block(rows: list[tuple]) -> pa.RecordBatch:
    texts = [text or "" for _, text, _ in rows]
    edited = [edited_text(a, b) for a, b in zip(texts, texts[1:])]
    own, other = sketches(texts), sketches(edited)
    out = []
    for i, ((doc_id, _, helper), text) in enumerate(zip(rows[:-1], edited)):
        if not helper:
            digest = hashlib.sha256(text.encode()).hexdigest()
            out.append((doc_id, len(texts[i]), digest, written(own[i]), written(other[i]), containment(own[i], other[i]), containment(own[i], own[i + 1])))
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
    columns = list(zip(*out)) if out else [()] * 7
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[f.split()[0] for f in _OUT.split(", ")])
