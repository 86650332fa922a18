"""Benchmark decontamination by a distributed positional inverted index of the training text.

The index is partitioned by documents: a shard holds the postings (term, positions) of some megabytes of text, is stored as one
row, and answers the test items alone. Test items go to the shards in blocks of bounded size. In a shard, the windows of an item
are answered from their rarest term on: its list, moved by the term's place in the window, is intersected with the lists of
the next terms until no place or no term is left.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveyloom.llm.storage import stored
from surveyloom.llm.text import ALNUM_WORDS, row_groups, text_bytes, words

WINDOW = 13
#: Bytes of text of a shard; a longer document is a shard of its own.
SHARD_BYTES = 8 << 20
#: Bytes of test text that are sent to the shards together.
BLOCK_BYTES = 4 << 20
#: Terms that no test item has are not stored. The filter is a bitmap of this many bits over the hashes, whatever the number
#: of terms: a term that only shares its bit is stored in vain, none is missed.
FILTER_BITS = 22

_SHIFT = np.uint64(64 - FILTER_BITS)
_INDEX = "shard long, doc_ids binary, missing binary, first binary, terms binary, ends binary, positions binary"
_FOUND = "shard long, place int, doc_id long, n_words long, hits array<struct<start:int,end:int>>, items array<string>"


def term_filter(items: DataFrame) -> np.ndarray:
    """The bitmap of the terms of all items, as bytes; at most 2 ** FILTER_BITS / 64 numbers go to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = words(*text_bytes(batch.column(0)), ALNUM_WORDS)
            slots = np.unique(found.hash >> _SHIFT).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(slots)], names=["slot"])

    slots = items.select("text").mapInArrow(run, "slot long")
    cells = slots.groupBy(F.shiftright("slot", 6).alias("cell")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(slot & 63 AS INT))")).alias("bits")).collect()
    bitmap = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    for cell, bits in cells:
        bitmap[cell] = bits
    return np.unpackbits(bitmap.view(np.uint8), bitorder="little")


def build_index(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The stored shards over docs (doc_id, text), with the terms that items (text) can ask for."""
    bitmap = docs.sparkSession.sparkContext.broadcast(np.packbits(term_filter(items), bitorder="little"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        wanted = np.unpackbits(bitmap.value, bitorder="little").astype(bool)
        shard = TaskContext.get().partitionId() << 32
        for batch in batches:
            ids = batch.column(0)
            missing = np.array(ids.is_null())
            numbers = np.array(ids.fill_null(0), np.int64)
            data, offsets = text_bytes(batch.column(1))
            for low, high in row_groups(offsets, SHARD_BYTES):
                own = offsets[low : high + 1]
                found = words(data[own[0] : own[-1]], own - own[0], ALNUM_WORDS)
                at = np.flatnonzero(wanted[found.hash >> _SHIFT])
                order = np.argsort(found.hash[at], kind="stable")
                terms, counts = np.unique(found.hash[at], return_counts=True)
                values = (numbers[low:high], missing[low:high], found.first, terms, np.cumsum(counts), at[order].astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard]), *(pa.array([v.tobytes()], pa.binary()) for v in values)],
                    names=["shard", "doc_ids", "missing", "first", "terms", "ends", "positions"],
                )
                shard += 1

    return stored(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, _INDEX), "index")


class Shard(NamedTuple):
    """first: place of the first word of each document; ends: where the list of each term ends in positions."""

    first: np.ndarray
    terms: np.ndarray
    ends: np.ndarray
    positions: np.ndarray

    def slots(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of each term in this shard and the length of its list (0: not there)."""
        if not len(self.terms):
            return np.zeros(len(terms), np.int64), np.zeros(len(terms), np.int64)
        slot = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        size = np.diff(self.ends, prepend=0)[slot]
        return slot, np.where(self.terms[slot] == terms, size, 0)

    def postings(self, slot: int) -> np.ndarray:
        return self.positions[self.ends[slot - 1] if slot else 0 : self.ends[slot]]

    def doc_of(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, places, side="right") - 1


class Block(NamedTuple):
    """Test items: their names, the hashes of their words, and where each item begins among them."""

    names: list[str]
    terms: np.ndarray
    first: np.ndarray


def phrases(shard: Shard, block: Block, size: int = WINDOW) -> Iterator[tuple[int, int, np.ndarray]]:
    """(item, length, places) of every window of the block that occurs in the shard.

    A window is `size` consecutive words of an item; an item of fewer words, but not none, is one window.
    """
    slot, count = shard.slots(block.terms)
    for item in range(len(block.names)):
        low, high = block.first[item], block.first[item + 1]
        length = min(size, int(high - low))
        if not length:
            continue
        starts = np.arange(low, high - length + 1)
        least = reduce(np.minimum, (count[starts + j] for j in range(length)))
        for start in starts[least > 0]:
            order = np.argsort(count[start : start + length], kind="stable")
            places = shard.postings(slot[start + order[0]]).astype(np.int64) - order[0]
            for j in order[1:]:
                own = shard.postings(slot[start + j])
                at = np.minimum(np.searchsorted(own, places + j), len(own) - 1)
                places = places[own[at] == places + j]
                if not len(places):
                    break
            if len(places):
                doc = shard.doc_of(places)
                places = places[places + length <= shard.first[doc + 1]]
            if len(places):
                yield item, length, places


def near(shard: Shard, block: Block, within: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(item, within, places) of every item all of whose terms occur in some run of `within` words of one document.

    A place is a word of the item at which such a run can begin.
    """
    slot, count = shard.slots(block.terms)
    for item in range(len(block.names)):
        low, high = block.first[item], block.first[item + 1]
        if low == high or count[low:high].min() == 0:
            continue
        lists = sorted((shard.postings(s).astype(np.int64) for s in set(slot[low:high].tolist())), key=len)
        places = np.unique(np.concatenate(lists))
        for own in lists:
            at = np.searchsorted(own, places)
            places = places[(at < len(own)) & (own[np.minimum(at, len(own) - 1)] < places + within)]
        if len(places):
            last = reduce(np.maximum, (own[np.searchsorted(own, places)] for own in lists))
            places = places[shard.doc_of(places) == shard.doc_of(last)]
        if len(places):
            yield item, within, places


def _blocks(items: DataFrame, limit: int) -> Iterator[list[tuple[str, str]]]:
    """Items in blocks of at most about `limit` bytes of text, read one partition at a time."""
    block: list[tuple[str, str]] = []
    size = 0
    for name, text in items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")), F.coalesce("text", F.lit(""))).toLocalIterator():
        block.append((name, text))
        size += len(text.encode())
        if size >= limit:
            yield block
            block, size = [], 0
    yield block


def _merged(hits: list[tuple[int, int]]) -> list[dict[str, int]]:
    out: list[dict[str, int]] = []
    for start, end in sorted(hits):
        if out and start <= out[-1]["end"]:
            out[-1]["end"] = max(out[-1]["end"], end)
        else:
            out.append({"start": start, "end": end})
    return out


def _answers(index: DataFrame, rows: list[tuple[str, str]], search: Callable, every: bool) -> DataFrame:
    """What one block of items finds: a row for each document with a match, or for every document."""
    held = index.sparkSession.sparkContext.broadcast(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = words(*text_bytes(pa.array([t for _, t in held.value], pa.string())), ALNUM_WORDS)
        block = Block([n for n, _ in held.value], found.hash, found.first)
        span = pa.struct([("start", pa.int32()), ("end", pa.int32())])
        for batch in batches:
            for number, *parts in zip(*(c.to_pylist() for c in batch.columns)):
                ids, missing, first, terms, ends, positions = (np.frombuffer(p, t) for p, t in zip(parts, (np.int64, bool, np.int64, np.uint64, np.int64, np.int32)))
                shard = Shard(first, terms, ends, positions)
                hits: dict[int, list[tuple[int, int]]] = {}
                names: dict[int, set[str]] = {}
                for item, length, places in search(shard, block):
                    for doc, place in zip(shard.doc_of(places).tolist(), places.tolist()):
                        at = place - int(first[doc])
                        hits.setdefault(doc, []).append((at, at + length))
                        names.setdefault(doc, set()).add(block.names[item])
                docs = list(range(len(ids))) if every else sorted(hits)
                sizes = np.diff(first)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([number] * len(docs), pa.int64()),
                        pa.array(docs, pa.int32()),
                        pa.array([None if missing[d] else int(ids[d]) for d in docs], pa.int64()),
                        pa.array([int(sizes[d]) for d in docs], pa.int64()),
                        pa.array([_merged(hits.get(d, [])) for d in docs], pa.list_(span)),
                        pa.array([sorted(names.get(d, ())) for d in docs], pa.list_(pa.string())),
                    ],
                    names=["shard", "place", "doc_id", "n_words", "hits", "items"],
                )

    return index.mapInArrow(run, _FOUND)


def _covered(hits: Column) -> Column:
    """How many words the spans cover together."""
    begin = F.struct(F.lit(0).alias("at"), F.lit(0).alias("n"))

    def step(state: Column, hit: Column) -> Column:
        low = F.greatest(state["at"], hit["start"])
        return F.struct(F.greatest(low, hit["end"]).alias("at"), (state["n"] + F.greatest(hit["end"] - low, F.lit(0))).alias("n"))

    return F.aggregate(F.array_sort(hits), begin, step, lambda s: s["n"]).cast("long")


def matches(docs: DataFrame, items: DataFrame, search: Callable = phrases) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items (sorted as strings) for every row of docs (doc_id, text) against items (item_id, text).

    Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after lower-casing A-Z. A null text has no words; a null item_id is named by
    the empty string, and items with one id are one item. Repeated documents are rows of their own. Without items nothing is
    hit; without documents there are no rows. Other columns are ignored. `search` is `phrases`, or `near` with its distance.
    """
    index = build_index(docs, items)
    found = [_answers(index, rows, search, every=not i) for i, rows in enumerate(_blocks(items, BLOCK_BYTES))]
    every = reduce(DataFrame.unionByName, found)
    if len(found) > 1:
        lists = (F.flatten(F.collect_list(c)).alias(c) for c in ("hits", "items"))
        every = every.groupBy("shard", "place").agg(F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"), *lists)
    names = F.array_sort(F.array_distinct("items"))
    return every.select("doc_id", "n_words", _covered(F.col("hits")).alias("n_hit"), F.size(names).cast("long").alias("n_items"), names.alias("items"))


def contaminated() -> Column:
    """At least a twentieth of the words is part of a test window."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def report(found: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), contaminated().alias("contaminated"))
