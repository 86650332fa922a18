"""Near-duplicate documents: many universal hash minima, banding, verification, connected components.

Equal shingle sets become one class first, so copies cost one row each and are never compared. Each class is then linked inside
its buckets. The first round compares every member of a bucket with the bucket's hub, the member that most others meet.  with all members of other components that it can still be similar
to, by an exact bound from both ends' differences from the hub. So no similar pair that shares a bucket is left out unless both
ends are in one component already. Links count only after both signatures and full sets agree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveyloom.llm.components import components
from surveyloom.llm.storage import stored
from surveyloom.llm.text import SPACED_WORDS, mix, row_groups, shingles, text_bytes, words

#: 36 bands of 5 minima: a pair at 0.8 misses all of them with probability 6e-7.
BANDS, ROWS = 36, 5
#: Signatures are compared by one byte of each minimum. With 180 minima a pair at 0.8 has a standard error of 0.03, so it falls below
#: the slack of 0.17 (5.7 of them) with probability 2e-8, less than it misses all bands.
SLACK = 0.17
#: Bits of the filter that tells which documents need their full sets, and the most documents it is used for; more are joined.
FILTER_BITS = 23
FILTER_IDS = 1 << 21
#: Strays that a bucket may have to be joined with itself. Beyond, its members meet by their rarest shingles.
WIDE = 64
#: Shingles are ordered by counts in so many cells (any order is exact, a finer one leaves fewer candidates).
COUNT_BITS = 18
#: Set sizes fall into classes this far apart.
CLASS_STEP = 1.05
#: 64-bit words that describe the difference of a set from its hub's (a power of two).
DIFFERENCE_WORDS = 32

_PRINT = "doc_id long, n_shingles long, set_key binary, bands array<long>, signature binary"
_COMPARED = "member long, hub long, n long, hub_n long, common long, own array<long>, gone array<long>"
_SET = "doc_id long, shingles array<long>"
_RARE = "doc_id long, n long, own_class int, met_class int, shingles array<long>"


def _universal(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Multiply-add-shift functions a * x + b, of which the high half is used."""
    rng = np.random.default_rng(8)
    return (
        rng.integers(1, 2**64, count, dtype=np.uint64) | np.uint64(1),
        rng.integers(0, 2**64, count, dtype=np.uint64),
    )


def minima(values: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least value of each function over a set, as 32 bits."""
    least = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for low in range(0, len(values), 256):
            least = np.minimum(least, (values[low : low + 256, None] * a + b).min(axis=0))
    return (least >> np.uint64(32)).astype(np.uint32)


def _sets(batch: pa.RecordBatch, size: int) -> Iterator[tuple[int | None, np.ndarray]]:
    ids = batch.column(0).to_pylist()
    data, offsets = text_bytes(batch.column(1))
    for low, high in row_groups(offsets):
        own = offsets[low : high + 1]
        values, first = shingles(words(data[own[0] : own[-1]], own - own[0], SPACED_WORDS), size)
        for row in range(low, high):
            yield ids[row], np.unique(values[first[row - low] : first[row - low + 1]])


def fingerprints(docs: DataFrame, size: int, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, set_key (digest of the whole set), bands and signature of every document, nulls included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _universal(bands * rows)
        salt = mix(np.arange(1, bands + 1, dtype=np.uint64))
        for batch in batches:
            out: list[tuple] = []
            for doc_id, values in _sets(batch, size):
                if not len(values):
                    out.append((doc_id, 0, None, None, None))
                    continue
                least = minima(values, a, b)
                key = salt.copy()
                with np.errstate(over="ignore"):
                    for part in least.reshape(bands, rows).T:
                        key = mix(key + part.astype(np.uint64))
                digest = hashlib.blake2b(values.tobytes(), digest_size=16).digest()
                out.append((doc_id, len(values), digest, key.view(np.int64), mix(least.astype(np.uint64)).astype(np.uint8).tobytes()))
            columns = list(zip(*out)) if out else [[]] * 5
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.binary())
            names = ("doc_id", "n_shingles", "set_key", "bands", "signature")
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return docs.select("doc_id", "text").mapInArrow(run, _PRINT)


def _filter_of(ids: DataFrame) -> bytes:
    """A bitmap over the hashes of `ids` (doc_id): of fixed size, so at most 2 ** FILTER_BITS / 64 numbers go to the driver."""

    slot = F.shiftrightunsigned(F.xxhash64("doc_id"), 64 - FILTER_BITS)
    cells = ids.select(slot.alias("slot")).groupBy(F.shiftright("slot", 6).alias("cell"))
    bitmap = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    for cell, bits in cells.agg(F.bit_or(F.expr("shiftleft(1L, CAST(slot & 63 AS INT))")).alias("bits")).collect():
        bitmap[cell] = bits
    return bitmap.tobytes()


def _over_sets(docs: DataFrame, ids: DataFrame, size: int, emit: Callable[[list], pa.RecordBatch], schema: str) -> DataFrame:
    """What `emit` makes of the shingle sets of the documents in `ids` (doc_id, distinct).

    Up to FILTER_IDS documents no text is shuffled: a bitmap finds them, and a few more whose hashes fall on the same bits.
    """
    texts = docs.filter("doc_id IS NOT NULL").select("doc_id", "text")
    if ids.count() > FILTER_IDS:

        def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield emit(list(_sets(batch, size)))

        return texts.join(ids, "doc_id", "left_semi").select("doc_id", "text").mapInArrow(joined, schema)
    bitmap = docs.sparkSession.sparkContext.broadcast(_filter_of(ids))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.unpackbits(np.frombuffer(bitmap.value, np.uint8), bitorder="little").astype(bool)
        for batch in batches:
            yield emit(list(_sets(batch.select([0, 1]).filter(pa.array(wanted[np.array(batch.column(2))])), size)))

    slot = F.shiftrightunsigned(F.xxhash64("doc_id"), 64 - FILTER_BITS)
    return texts.withColumn("slot", slot).mapInArrow(found, schema)


def _whole_sets(got: list) -> pa.RecordBatch:
    shingle_lists = pa.array([v.view(np.int64) for _, v in got], pa.list_(pa.int64()))
    return pa.RecordBatch.from_arrays([pa.array([i for i, _ in got], pa.int64()), shingle_lists], names=["doc_id", "shingles"])


def _agreeing(pairs: DataFrame, prints: DataFrame, threshold: float) -> DataFrame:
    """Pairs whose signatures let the threshold be possible."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (np.array([np.frombuffer(x, np.uint8) for x in batch.column(i).to_pylist()]) for i in (2, 3))
            same = (a == b).mean(axis=1)
            likely = (same - 1 / 256) / (1 - 1 / 256) >= threshold - SLACK
            yield batch.select([0, 1]).filter(pa.array(likely))

    left = prints.select(F.col("doc_id").alias("member"), F.col("signature").alias("sa"))
    right = prints.select(F.col("doc_id").alias("hub"), F.col("signature").alias("sb"))
    both = pairs.join(left, "member").join(right, "hub")
    return both.select("member", "hub", "sa", "sb").mapInArrow(run, "member long, hub long")


def _compared(pairs: DataFrame, docs: DataFrame, size: int) -> DataFrame:
    """member, hub, n, hub_n, common and what tells the two full sets apart: bits of the shingles that only the member has (own)
    and of those that only the hub has (gone)."""
    needed = stored(pairs.select(F.explode(F.array("member", "hub")).alias("doc_id")).distinct(), "needed")
    sets = stored(_over_sets(docs, needed, size, _whole_sets, _SET), "sets")
    mine = sets.select(F.col("doc_id").alias("member"), F.col("shingles").alias("x"))
    theirs = sets.join(pairs.select(F.col("hub").alias("doc_id")).distinct(), "doc_id", "left_semi")
    both = pairs.join(mine, "member").join(theirs.select(F.col("doc_id").alias("hub"), F.col("shingles").alias("y")), "hub")

    def bits(values: np.ndarray) -> np.ndarray:
        out = np.zeros(64 * DIFFERENCE_WORDS, np.uint8)
        out[values.view(np.uint64) >> np.uint64(58 - (DIFFERENCE_WORDS.bit_length() - 1))] = 1
        return np.packbits(out, bitorder="little").view(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            x_all, y_all = batch.column(2), batch.column(3)
            for i in range(batch.num_rows):
                x, y = (np.asarray(c[i].values).view(np.uint64) for c in (x_all, y_all))
                at = np.minimum(np.searchsorted(y, x), max(len(y) - 1, 0))
                same = y[at] == x
                gone = np.ones(len(y), bool)
                gone[at[same]] = False
                rows.append((len(x), len(y), int(same.sum()), bits(x[~same]), bits(y[gone])))
            n, hub_n, common, own, lost = zip(*rows) if rows else ((),) * 5
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array(c, pa.int64()) for c in (n, hub_n, common)), pa.array(own, longs), pa.array(lost, longs)],
                names=["member", "hub", "n", "hub_n", "common", "own", "gone"],
            )

    return both.select("member", "hub", "x", "y").mapInArrow(run, _COMPARED)


def _links(compared: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets reach the similarity: 100 * intersection >= percent * union."""
    near = 100 * F.col("common") >= percent * (F.col("n") + F.col("hub_n") - F.col("common"))
    return compared.filter(near).select(F.col("member").alias("u"), F.col("hub").alias("v")).distinct()


def _hubs(members: DataFrame) -> DataFrame:
    """Every member of a bucket with its hub: the member that meets most others over all buckets."""
    met = members.groupBy("doc_id").agg(F.sum("m").alias("met"))
    known = members.join(met, "doc_id").select("doc_id", "bucket", "met")
    hub = known.groupBy("bucket").agg(F.max(F.struct("met", -F.col("doc_id"))).alias("top"))
    return known.join(hub.select("bucket", (-F.col("top.col2")).alias("hub")), "bucket").select("doc_id", "bucket", "hub")


def _shared_bits(a: str, b: str) -> Column:
    return F.expr(f"aggregate(zip_with({a}, {b}, (x, y) -> bit_count(x & y)), 0, (n, x) -> n + x)")


def _spare(bits: str, count: Column) -> Column:
    """Shingles of a set beyond the bits they set."""
    return count - F.expr(f"aggregate({bits}, 0, (n, x) -> n + bit_count(x))")


def _most_common() -> Column:
    """The most shingles that two sets compared with one hub can share; null without facts of both."""
    beside = _shared_bits("own", "s_own") + _spare("own", F.col("size") - F.col("common"))
    lacking = _shared_bits("gone", "s_gone") + _spare("gone", F.col("hub_n") - F.col("common"))
    most = F.col("common") + F.col("s_common") - F.col("hub_n") + lacking + beside
    # Without facts of both ends the bound stays null; least() alone would skip the null.
    return F.when(most.isNotNull(), F.least("size", "s_size", most))


def _placed(members: DataFrame, found: DataFrame) -> DataFrame:
    """doc_id, bucket, hub, component and main (the largest component of the bucket) of all members but hubs, where a bucket
    holds several components."""
    own = members.join(found, members["doc_id"] == found["node"], "left").select(
        "doc_id", "bucket", "hub", F.coalesce("component", "doc_id").alias("component")
    )
    cells = own.groupBy("bucket", "component").count()
    top = cells.groupBy("bucket").agg(F.max(F.struct("count", "component")).alias("top"), F.count("*").alias("n"))
    mixed = top.filter("n > 1").select("bucket", F.col("top.component").alias("main"))
    return own.filter("doc_id <> hub").join(mixed, "bucket")


def _stray_pairs(own: DataFrame, compared: DataFrame, leaders: DataFrame, percent: int) -> DataFrame:
    """Members outside the largest component of their bucket, with all members of other components there that can be similar.

    Both ends have been compared with the hub, which bounds their intersection: what they have of the hub together is
    |a & h| + |b & h| - |h| and the shingles that both lack; the rest is what both have beside the hub. The bits of the two
    differences bound these overlaps from above, so no similar pair is left out. Where an end was too far from the hub to be
    compared, the signatures decide here and not in the next step. A pair is emitted by the first bucket that both ends share.
    """
    own = own.join(leaders.select("doc_id", F.col("n_shingles").alias("size"), "bands", "signature"), "doc_id")
    facts = compared.select(F.col("member").alias("doc_id"), "hub", "hub_n", "common", "own", "gone")
    own = own.join(facts, ["doc_id", "hub"], "left")
    stray = own.filter("component <> main").select(
        "bucket", *(F.col(c).alias("s_" + c) for c in ("doc_id", "component", "size", "bands", "signature", "common", "own", "gone"))
    )
    shared = F.expr("element_at(filter(zip_with(bands, s_bands, (x, y) -> if(x = y, x, NULL)), x -> x IS NOT NULL), 1) = bucket")
    once = (F.col("component") == F.col("main")) | (F.col("s_doc_id") < F.col("doc_id"))
    most = _most_common()
    same = F.expr(f"aggregate(sequence(1, {BANDS * ROWS}), 0, (n, i) -> n + int(substring(signature, i, 1) = substring(s_signature, i, 1)))")
    alike = same >= BANDS * ROWS * (percent / 100 - SLACK)
    close = F.coalesce(100 * most >= percent * (F.col("size") + F.col("s_size") - most), alike)
    both = stray.join(own, "bucket").filter((F.col("component") != F.col("s_component")) & once & shared & close)
    return both.select(F.col("s_doc_id").alias("member"), F.col("doc_id").alias("hub"))


def size_bounds(most: int = 1 << 40) -> np.ndarray:
    """The least set size of every class of sizes."""
    bounds = [1]
    while bounds[-1] < most:
        bounds.append(max(bounds[-1] + 1, int(bounds[-1] * CLASS_STEP)))
    return np.array(bounds, np.int64)


def rarest(values: np.ndarray, counts: np.ndarray, bounds: np.ndarray, percent: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """For every class of sizes that a similar set can have: this set's class, that class, and the rarest shingles of this set, of
    which a similar set of that class has one among its own rarest.

    Similar sets of n and m shingles share at least percent * (n + m) / (100 + percent); so with one order for all sets, one of the
    first n + 1 less that number is shared.
    """
    n = len(values)
    if not n:
        return
    cells = counts[values >> np.uint64(64 - COUNT_BITS)]
    ordered = values[np.lexsort((values, cells))]
    least, most = -(-percent * n // 100), 100 * n // percent
    mine, first, last = np.searchsorted(bounds, [n, least, most], side="right") - 1
    for other in range(max(first, 0), last + 1):
        m = max(int(bounds[other]), least)
        keep = n - -(-percent * (n + m) // (100 + percent)) + 1
        if keep > 0:
            yield int(mine), int(other), ordered[:keep]


def _rare_pairs(crowd: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Strays of `crowd` (doc_id, component, stray) with members of other components that share one of the rarest shingles which
    similar sets of their sizes must share. Counts of 2 ** COUNT_BITS cells go to the driver and to all tasks."""
    ids = crowd.select("doc_id")
    shift = np.uint64(64 - COUNT_BITS)

    def cells(got: list) -> pa.RecordBatch:
        cell, n = np.unique(np.concatenate([np.zeros(0, np.uint64), *(v >> shift for _, v in got)]), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int64)), pa.array(n.astype(np.int64))], names=["cell", "n"])

    counts = np.zeros(1 << COUNT_BITS, np.int64)
    for cell, n in _over_sets(docs, ids, size, cells, "cell long, n long").groupBy("cell").agg(F.sum("n")).collect():
        counts[cell] = n
    known = docs.sparkSession.sparkContext.broadcast(counts)
    bounds = size_bounds()

    def lists(got: list) -> pa.RecordBatch:
        rows = [(i, len(v), own, met, part.view(np.int64)) for i, v in got for own, met, part in rarest(v, known.value, bounds, percent)]
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64()))
        columns = zip(*rows) if rows else ((),) * 5
        names = ["doc_id", "n", "own_class", "met_class", "shingles"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    rare = stored(_over_sets(docs, ids, size, lists, _RARE).join(crowd, "doc_id"), "rarest")
    rare = rare.select("doc_id", "component", "stray", "n", "own_class", "met_class", F.explode("shingles").alias("shingle"))
    # A shingle that no stray has meets nothing; most of a template's are such.
    turned = (F.col("own_class").alias("met_class"), F.col("met_class").alias("own_class"))
    strays = rare.filter("stray").select("shingle", *turned, *(F.col(c).alias("s_" + c) for c in ("doc_id", "component", "n")))
    once = ~F.col("stray") | (F.col("s_doc_id") < F.col("doc_id"))
    sizes = 100 * F.least("n", "s_n") >= percent * F.greatest("n", "s_n")
    both = strays.join(rare, ["shingle", "own_class", "met_class"]).filter((F.col("component") != F.col("s_component")) & once & sizes)
    return both.select(F.col("s_doc_id").alias("member"), F.col("doc_id").alias("hub")).distinct()


def _bounded(pairs: DataFrame, crowd: DataFrame, compared: DataFrame, percent: int) -> DataFrame:
    """Pairs without those that their differences from one hub rule out: of an end's hubs the one that most are compared
    with, where both ends have the same. An id with several texts, or whose hub has several, rules nothing out."""
    mine = compared.join(crowd.select(F.col("doc_id").alias("member")), "member", "left_semi")
    met = mine.groupBy("hub").agg(F.count("*").alias("met"))
    known = mine.select("member", "hub").join(met, "hub")
    top = known.groupBy("member").agg(F.max(F.struct("met", "hub")).alias("top"), F.count("*").alias("rows"), F.countDistinct("hub").alias("hubs"))
    top = top.filter(F.col("rows") == F.col("hubs")).select("member", F.col("top.hub").alias("hub"))
    facts = stored(mine.join(top, ["member", "hub"]), "facts").withColumnRenamed("n", "size")
    names = ("size", "common", "own", "gone")
    one = facts.select("member", F.col("hub").alias("via"), *(F.col(c).alias("s_" + c) for c in names))
    other = facts.select(F.col("member").alias("hub"), F.col("hub").alias("other_via"), "hub_n", *names)
    most = F.when(F.col("via") == F.col("other_via"), _most_common())
    close = F.coalesce(100 * most >= percent * (F.col("size") + F.col("s_size") - most), F.lit(True))
    return pairs.join(one, "member", "left").join(other, "hub", "left").filter(close).select("member", "hub")


def _all_stray_pairs(
    members: DataFrame, compared: DataFrame, found: DataFrame, leaders: DataFrame, docs: DataFrame, size: int, percent: int
) -> DataFrame:
    """Pairs of strays: inside their bucket where it has up to WIDE of them, else by their rarest shingles."""
    placed = stored(_placed(members, found), "placed")
    stray = F.col("component") != F.col("main")
    wide = stored(placed.filter(stray).groupBy("bucket").count().filter(F.col("count") > WIDE).select("bucket"), "wide")
    if wide.isEmpty():
        return _stray_pairs(placed, compared, leaders, percent)
    narrow = _stray_pairs(placed.join(wide, "bucket", "left_anti"), compared, leaders, percent)
    crowd = placed.join(wide, "bucket", "left_semi").groupBy("doc_id").agg(F.min("component").alias("component"), F.max(stray).alias("stray"))
    crowd = stored(crowd, "crowd")
    rare = _bounded(_rare_pairs(crowd, docs, size, percent), crowd, compared, percent)
    return narrow.unionByName(rare).distinct()


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of docs (doc_id, text).

    Words are `[^\\x20\\x09-\\x0D]+` with A-Z lower-cased, a set holds the distinct runs of `size` words (fewer words: the
    whole sequence), and two documents are linked if 100 * intersection >= percent * union. component_id is the least doc_id
    that can be reached; kept marks it.

    Null, empty and blank texts have an empty set and stay alone. A null doc_id is never linked: component_id is null and the
    row is kept. Rows that repeat a doc_id are one document with the links of all its texts. An empty table gives no rows.
    Other columns are ignored.
    """
    docs = docs.select("doc_id", "text")
    prints = stored(fingerprints(docs, size), "prints")
    linked = prints.filter("doc_id IS NOT NULL AND n_shingles > 0")
    classes = linked.groupBy("set_key").agg(F.min("doc_id").alias("doc_id"))
    leaders = stored(linked.join(classes, ["set_key", "doc_id"]).select("doc_id", "n_shingles", "bands", "signature"), "leaders")

    spread = leaders.select("doc_id", F.explode("bands").alias("bucket"))
    shared = spread.groupBy("bucket").agg(F.count("*").alias("m")).filter("m > 1")
    members = stored(spread.join(shared, "bucket").select("doc_id", "bucket", "m"), "members")
    members = stored(_hubs(members), "hubs")

    pairs = members.filter("doc_id <> hub").select(F.col("doc_id").alias("member"), "hub").distinct()
    pairs = stored(_agreeing(pairs, leaders, percent / 100), "hub-pairs")
    compared = stored(_compared(pairs, docs, size), "compared")
    first = _links(compared, percent)
    strays = _all_stray_pairs(members, compared, components(first), leaders, docs, size, percent)
    strays = stored(_agreeing(strays, leaders, percent / 100), "stray-pairs")
    second = _links(_compared(strays, docs, size), percent)

    # Copies follow the leader of their class and are no links; only an id with several texts ties their classes together.
    several = linked.groupBy("doc_id").agg(F.min("set_key").alias("a"), F.max("set_key").alias("b")).filter("a <> b").select("doc_id")
    ties = linked.join(several, "doc_id", "left_semi").join(classes.withColumnRenamed("doc_id", "v"), "set_key")
    found = components(first.unionByName(second).unionByName(ties.select(F.col("doc_id").alias("u"), "v")))
    led = classes.join(found, classes["doc_id"] == found["node"], "left").select("set_key", F.coalesce("component", "doc_id").alias("led"))
    # A row without words belongs to no class, but its id may have another text that does; without an id it belongs to nothing.
    bare = prints.filter("doc_id IS NOT NULL AND n_shingles = 0")
    owned = linked.join(bare.select("doc_id").distinct(), "doc_id", "left_semi").join(led, "set_key").groupBy("doc_id").agg(F.min("led").alias("led"))
    rest = prints.filter("doc_id IS NULL OR n_shingles > 0").join(led, "set_key", "left")
    columns = ("doc_id", "n_shingles", "led")
    out = rest.select(*columns).unionByName(bare.join(owned, "doc_id", "left").select(*columns))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("led", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept"))
