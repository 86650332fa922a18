"""Token ids in ORC files, in ascending doc_id order, to be read by stripes.

Texts are dealt by ranges of doc_id, sorted, encoded and written by Spark's ORC writer: ids are an integer column (run lengths, deltas
or bit packing as the writer finds fit), every stripe has a row index, and doc_id a Bloom filter. Each row knows its place
in its file, and a small table knows how many ids the files before it hold. So readers can start at any stripe, a reader of
few documents or of a range of ids opens few stripes, and no row needs its neighbours.
"""

from __future__ import annotations

import json
import os
import re
import sys
import types
import zlib
from collections.abc import Iterator, Sequence
from itertools import chain, compress, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from surveyloom.llm.text import row_groups
from surveyloom.session import fresh_folder

VOCABULARY = "word_bpe_49k.json"
END = 1
#: Bytes of text that are encoded together.
GROUP_BYTES = 8 << 20
#: Different parts of words whose ids a worker keeps, some 200 bytes each. A full store is emptied, which changes no result.
KEPT_PARTS = 1 << 20
#: Bytes of a stripe in memory; a task can start at any.
STRIPE_BYTES = 16 << 20
#: Rows between two entries of a row index; a Bloom filter is kept for as many rows.
INDEX_ROWS = 1000

_ROWS = "file int, doc_id long, first long, n_tokens long, ids array<int>"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


#: The vocabulary's own rule for the parts of a text, on bytes of lower-case ASCII and Latin-1 letters. Fixed values.
_LATIN = rb"\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]"
_PARTS = re.compile(rb"\n|'(?:s|t|re|ve|m|ll|d)|(?:[a-z]|" + _LATIN + rb")+|[0-9]|[^\sa-z0-9\x80-\xff]+")
#: A word that consists of such bytes only; any other goes through all rules of the vocabulary in one piece.
_SIMPLE = re.compile(rb"(?:[^\s\x80-\xff]|" + _LATIN + rb")+")


class _Ids:
    """The ids of numbered items, one after another."""

    def __init__(self) -> None:
        self.flat, self.size, self.used, self.count = np.zeros(1 << 12, np.int32), np.zeros(1 << 10, np.int64), 0, 0

    def extend(self, flat: np.ndarray, size: np.ndarray) -> None:
        self.flat = _grown(self.flat, self.used + len(flat))
        self.size = _grown(self.size, self.count + len(size))
        self.flat[self.used : self.used + len(flat)] = flat
        self.size[self.count : self.count + len(size)] = size
        self.used, self.count = self.used + len(flat), self.count + len(size)

    def starts(self) -> np.ndarray:
        return np.cumsum(self.size[: self.count]) - self.size[: self.count]

    def of(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of some items, and how many each has."""
        counts = self.size[slots]
        place = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
        return self.flat[np.repeat(self.starts()[slots], counts) + place], counts


def _grown(values: np.ndarray, size: int) -> np.ndarray:
    if size <= len(values):
        return values
    return np.concatenate([values, np.zeros(max(size, 2 * len(values)) - len(values), values.dtype)])


def _sums(counts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of `counts` over runs of `sizes` entries."""
    ends = np.concatenate([[0], np.cumsum(counts)])[np.concatenate([[0], np.cumsum(sizes)])]
    return np.diff(ends)


def _numbers(items: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
    """Each item's number among the different items, and these in order."""
    values = np.empty(len(items), object)
    values[:] = items
    codes, different = pd.factorize(values)
    return codes, list(different)


class Encoder:
    """Ids of whole texts by the tokenizers library.

    White space is dropped by the vocabulary's rules and no rule looks across it, so a text's ids are those of its words. A word of
    ASCII and Latin-1 letters, which normalisation only lower-cases, is parted as the rules part it, and each
    different part is encoded once while it is kept. Words with other characters, and texts with a special token, go through
    all rules in one piece. `whole` encodes every text in one piece, for other vocabularies.
    """

    def __init__(self, rules: str, whole: bool = False) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        declared = json.loads(rules)
        self.tokenizer, self.whole = Tokenizer.from_str(rules), whole
        self.special = [token["content"].encode() for token in declared["added_tokens"]]
        # The same pieces and merges for parts that need no normalising; white space stands between them.
        steps = [{"type": "WhitespaceSplit"}, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]
        plain = {"normalizer": None, "pre_tokenizer": {"type": "Sequence", "pretokenizers": steps}, "added_tokens": []}
        self.plain = Tokenizer.from_str(json.dumps({**declared, **plain}))
        self._forget()

    def _forget(self) -> None:
        self.slots: dict[bytes, int] = {}
        self.ids = _Ids()

    def _encode(self, texts: list[str], into: _Ids) -> None:
        """Texts by all rules."""
        for low in range(0, len(texts), 4096):
            found = [e.ids for e in self.tokenizer.encode_batch(texts[low : low + 4096], add_special_tokens=False)]
            size = np.fromiter(map(len, found), np.int64, len(found))
            into.extend(np.fromiter(chain.from_iterable(found), np.int32, int(size.sum())), size)

    def _encode_parts(self, parts: list[bytes], into: _Ids) -> None:
        """Parts of simple words, many together; each has at least one id."""
        for low in range(0, len(parts), 1024):
            own = parts[low : low + 1024]
            found = self.plain.encode(b" ".join(own).decode().lower(), add_special_tokens=False)
            into.extend(np.array(found.ids, np.int32), np.bincount(np.array(found.word_ids, np.int64), minlength=len(own)))

    def _numbered(self, items: list[bytes], encode) -> np.ndarray:
        """The slots of items, those that are new among them encoded."""
        slots = np.fromiter(map(self.slots.get, items, repeat(-1)), np.int64, len(items))
        missing = np.flatnonzero(slots < 0)
        slots[missing] = self.ids.count + np.arange(len(missing))
        new = [items[i] for i in missing.tolist()]
        self.slots.update(zip(new, slots[missing].tolist()))
        encode(new, self.ids)
        return slots

    def _words(self, words: list[bytes]) -> _Ids:
        """The ids of different words: simple ones by their parts, the others by all rules."""
        is_simple = np.array([w.isascii() or bool(_SIMPLE.fullmatch(w.lower())) for w in words], bool)
        # White space is in no word, so a line break ends each, and a space marks a word that is kept whole.
        others = self._numbered(
            [b" " + w for w, simple in zip(words, is_simple) if not simple],
            lambda new, into: self._encode([w[1:].decode() for w in new], into),
        )
        codes, known = _numbers(_PARTS.findall(b"\n".join(compress(words, is_simple)).lower()))
        end = known.index(b"\n") if b"\n" in known else -1
        real = [p for p in known if p != b"\n"]
        numbers = self._numbered(real, self._encode_parts)
        if end >= 0:
            numbers = np.insert(numbers, end, -1)
        slots = numbers[codes[codes != end]]
        simple = _Ids()
        if is_simple.any():
            ends = np.concatenate([np.flatnonzero(codes == end), [len(codes)]])
            ids, counts = self.ids.of(slots)
            simple.extend(ids, _sums(counts, np.diff(ends, prepend=-1) - 1))
        whole = _Ids()
        whole.extend(*self.ids.of(others))
        # In the order of the words.
        both = _Ids()
        both.extend(np.concatenate([simple.flat[: simple.used], whole.flat[: whole.used]]), np.concatenate([simple.size[: simple.count], whole.size[: whole.count]]))
        place = np.empty(len(words), np.int64)
        place[is_simple] = np.arange(simple.count)
        place[~is_simple] = simple.count + np.arange(whole.count)
        ordered = _Ids()
        ordered.extend(*both.of(place))
        return ordered

    def __call__(self, texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of texts in UTF-8 one after another, and how many each text has."""
        if len(self.slots) > KEPT_PARTS:
            self._forget()
        apart = [i for i, t in enumerate(texts) if self.whole or any(s in t for s in self.special)]
        lone = set(apart)
        words = [[] if i in lone else t.split() for i, t in enumerate(texts)]
        number = np.fromiter(map(len, words), np.int64, len(words))
        codes, different = _numbers(list(chain.from_iterable(words)))
        ids, counts = self._words(different).of(codes)
        counts = _sums(counts, number)
        if not apart:
            return ids, counts
        own = _Ids()
        self._encode([texts[i].decode() for i in apart], own)
        flat, sizes = own.of(np.arange(own.count))
        pieces = np.split(ids, np.cumsum(counts)[:-1])
        for i, piece in zip(apart, np.split(flat, np.cumsum(sizes)[:-1])):
            pieces[i], counts[i] = piece, len(piece)
        return np.concatenate(pieces), counts


def kept_encoder(rules: str, whole: bool) -> Encoder:
    """The encoder that this worker process has made for these rules before, or a new one."""
    kept = sys.modules.setdefault("surveyloom_kept_encoders", types.ModuleType("surveyloom_kept_encoders"))
    key = (hash(rules), whole)
    if key not in kept.__dict__:
        kept.__dict__.clear()
        kept.__dict__[key] = Encoder(rules, whole)
    return kept.__dict__[key]


def _encoded(rules: str, whole: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, file, first = kept_encoder(rules, whole), TaskContext.get().partitionId(), 0
        for batch in batches:
            column = batch.column(1).cast(pa.binary())
            sizes = np.array(pa.compute.binary_length(column).fill_null(0), np.int64)
            for low, high in row_groups(np.concatenate([[0], np.cumsum(sizes)]), GROUP_BYTES):
                ids, counts = encode([t or b"" for t in column.slice(low, high - low).to_pylist()])
                ends = np.cumsum(counts + 1)
                full = np.full(int(ends[-1]), END, np.int32)
                mask = np.ones(len(full), bool)
                mask[ends - 1] = False
                full[mask] = ids
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(full))
                columns = [pa.array(np.full(high - low, file, np.int32)), batch.column(0).slice(low, high - low)]
                columns += [pa.array(first + ends - counts - 1), pa.array(counts + 1), lists]
                yield pa.RecordBatch.from_arrays(columns, names=["file", "doc_id", "first", "n_tokens", "ids"])
                first += int(ends[-1])

    return run


def write_tokens(docs: DataFrame, path: str, vocabulary: str | None = None, whole: bool = False) -> None:
    """Encode docs (doc_id, text) into ORC files below `path`/rows, and the sums of the files into `path`/files.

    Files follow each other in ascending doc_id order, as their rows do. A null doc_id comes last, rows that repeat a doc_id stand
    as they are read; a null text is empty and has the end id alone. There are as many files as `spark.sql.shuffle.partitions`. `whole` is for vocabularies whose rules look across white space.
    """
    with open(vocabulary or vocabulary_path(), encoding="utf-8") as file:
        rules = file.read()
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.monotonically_increasing_id().alias("row"))
    files = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # The second key deals out a doc_id that a large part of the rows repeat, nulls among them.
    order = [F.col("doc_id").asc_nulls_last(), F.col("row")]
    dealt = keyed.repartitionByRange(files, *order).sortWithinPartitions(*order)
    rows = dealt.select("doc_id", "text").mapInArrow(_encoded(rules, whole), _ROWS)
    writer = rows.write.option("compression", "snappy").option("orc.bloom.filter.columns", "doc_id")
    writer.option("orc.stripe.size", str(STRIPE_BYTES)).option("orc.row.index.stride", str(INDEX_ROWS)).option("orc.bloom.filter.fpp", "0.01").orc(f"{path}/rows")
    stored = docs.sparkSession.read.orc(f"{path}/rows")
    sums = stored.groupBy("file").agg(
        F.count("*").alias("documents"), F.sum("n_tokens").alias("tokens"), F.min("doc_id").alias("least"), F.max("doc_id").alias("most")
    )
    # One row for each file: the window is over files and not over documents.
    before = F.sum("tokens").over(W.orderBy("file").rowsBetween(W.unboundedPreceding, -1))
    sums.withColumn("start", F.coalesce(before, F.lit(0).cast("long"))).coalesce(1).write.orc(f"{path}/files")


def files(spark: SparkSession, path: str) -> DataFrame:
    """file, documents, tokens, least, most (doc_id), start: how many ids the files before it hold."""
    return spark.read.orc(f"{path}/files")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids of every document; start is the place of its first id among all ids.

    Filters on doc_id and on columns reach the files: row indexes and Bloom filters leave out what cannot match.
    """
    rows = spark.read.orc(f"{path}/rows")
    starts = files(spark, path).select("file", "start")
    return rows.join(starts, "file").select("doc_id", (F.col("start") + F.col("first")).alias("start"), "n_tokens", "ids")


def read_span(spark: SparkSession, path: str, low: int, high: int) -> DataFrame:
    """place, id: the ids at places low to high (exclusive) of the whole sequence. Only files that hold some of them are opened."""
    wanted = files(spark, path).filter((F.col("start") < high) & (F.col("start") + F.col("tokens") > low)).select("file", "start")
    rows = spark.read.orc(f"{path}/rows").join(wanted, "file")
    rows = rows.withColumn("at", F.col("start") + F.col("first")).filter((F.col("at") < high) & (F.col("at") + F.col("n_tokens") > low))
    spread = rows.select("at", F.posexplode("ids").alias("within", "id"))
    return spread.select((F.col("at") + F.col("within")).alias("place"), "id").filter((F.col("place") >= low) & (F.col("place") < high))


def digests(rows: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of read rows: the unsigned crc32 of the ids as little-endian unsigned 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            ends = np.array(lists.offsets, np.int64)
            values = np.array(lists.values, "<u4").tobytes()
            sums = [zlib.crc32(values[4 * a : 4 * b]) for a, b in zip(ends, ends[1:])]
            columns = [batch.column(0), batch.column(1), pa.array(np.diff(ends)), pa.array(sums, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return rows.select("doc_id", "start", "n_tokens", "ids").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame) -> DataFrame:
    """Documents written as token files into the shared folder and read back."""
    path = fresh_folder(docs.sparkSession, "tokens")
    write_tokens(docs, path)
    return digests(read_tokens(docs.sparkSession, path))
