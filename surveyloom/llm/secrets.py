"""Secret scan in DataFrame functions only: patterns, and sliding-window entropy over candidate strings.

A document is one row all the way: no explode, no shuffle, no Python. Positions are code points; ends are exclusive.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The patterns of the scan.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "entropy")

#: What may be a secret by its characters alone, and what never is: placeholders, identifiers in words, counting rows.
CANDIDATE = r"[A-Za-z0-9+/_=-]{24,}"
ALLOWED = r"(?i)example|sample|placeholder|changeme|redacted|dummy|x{6}|0123456|1234567|abcdefg|qwerty|(?:[a-z]{5,}[-_/]){2}"
WINDOW = 20
#: Bits a window must reach, by the class of the candidate's characters.
THRESHOLDS = {"hex": 3.0, "single case": 3.6, "mixed": 3.8}

_EMPTY = "CAST(array() AS array<struct<start:int,rank:int,end:int,text:string>>)"
#: Entries of an array, or code points of a text, that are handled together. What is appended one by one or searched from its
#: beginning is never longer, so the cost of a text grows with its length and not with its square.
BLOCK = 256


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is computed once: an expression within a lambda would be computed anew for every element."""
    return F.element_at(F.transform(F.array(value), use), 1)


def running(values: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """Of an array of non-negative ints the running sums or maxima (`combine`; 0 is neutral), block by block."""
    none = F.expr("CAST(array() AS array<int>)")

    def walk(block: Column, start: Column) -> Column:
        begin = F.struct(start.cast("int").alias("at"), none.alias("out"))

        def step(state: Column, value: Column) -> Column:
            at = combine(state["at"], value).cast("int")
            return F.struct(at.alias("at"), F.concat(state["out"], F.array(at)).alias("out"))

        return F.aggregate(block, begin, step, lambda state: state["out"])

    def whole(block: Column) -> Column:
        return F.aggregate(block, F.lit(0), lambda at, value: combine(at, value).cast("int"))

    def of_blocks(blocks: Column) -> Column:
        def from_ends(ends: Column) -> Column:
            start = lambda i: F.when(i == 0, F.lit(0)).otherwise(F.element_at(ends, F.greatest(i, F.lit(1))))
            return F.flatten(F.transform(blocks, lambda block, i: walk(block, start(i))))

        return _once(walk(F.transform(blocks, whole), F.lit(0)), from_ends)

    def blocked(kept: Column) -> Column:
        places = F.sequence(F.lit(0), F.floor((F.size(kept) - 1) / BLOCK).cast("int"))
        return F.transform(places, lambda i: F.slice(kept, i * BLOCK + 1, F.lit(BLOCK)))

    return _once(values, lambda kept: F.when(F.size(kept) == 0, none).otherwise(_once(blocked(kept), of_blocks)))


def _positions(text: Column, pattern: str, rank: int) -> Column:
    """All leftmost matches as (start, rank, end, text), from the lengths of the matches and of what lies between them."""
    between = F.split(text, pattern, -1)

    def spans(found: Column) -> Column:
        pairs = F.zip_with(
            found, F.slice(between, F.lit(1), F.size(found)), lambda hit, gap: F.struct(hit.alias("hit"), F.length(gap).alias("gap"))
        )

        def placed(kept: Column) -> Column:
            ends = running(F.transform(kept, lambda pair: pair["gap"] + F.length(pair["hit"])), lambda a, b: a + b)
            return F.zip_with(
                kept,
                ends,
                lambda pair, end: F.struct(
                    (end - F.length(pair["hit"])).alias("start"), F.lit(rank).alias("rank"), end.alias("end"), pair["hit"].alias("text")
                ),
            )

        return F.when(F.size(found) == 0, F.expr(_EMPTY)).otherwise(_once(pairs, placed))

    return _once(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), spans)


def best_window_entropy(value: Column, window: int = WINDOW) -> Column:
    """The highest Shannon entropy (bits a character) of any `window` consecutive ASCII characters.

    One pass over the characters: the counts of the window are the characters of a string, of which one place changes when a
    character enters and one when a character leaves; the sum of n log n changes with them. The window itself is in the state.
    """
    logs = F.array(*(F.lit(n * math.log2(n) if n else 0.0) for n in range(window + 2)))

    def log_of(n: Column) -> Column:
        return F.element_at(logs, n + 1)

    def count(counts: Column, code: Column) -> Column:
        return F.ascii(F.substring(counts, code + 1, F.lit(1))) - 48

    def put(counts: Column, code: Column, n: Column) -> Column:
        return F.overlay(counts, F.char(n + 48), code + 1, F.lit(1))

    def step(state: Column, char: Column) -> Column:
        code, full = F.ascii(char), F.length(state["last"]) == window
        gone = F.ascii(F.substring(state["last"], F.lit(1), F.lit(1)))
        before = count(state["counts"], gone)
        left = F.when(
            full,
            F.struct(
                put(state["counts"], gone, before - 1).alias("counts"),
                (state["sum"] - log_of(before) + log_of(before - 1)).alias("sum"),
            ),
        ).otherwise(F.struct(state["counts"].alias("counts"), state["sum"].alias("sum")))

        def enter(kept: Column) -> Column:
            n = count(kept["counts"], code)
            total = kept["sum"] - log_of(n) + log_of(n + 1)
            last = F.concat(F.when(full, F.substring(state["last"], F.lit(2), F.lit(window - 1))).otherwise(state["last"]), char)
            bits = F.when(F.length(last) == window, F.lit(math.log2(window)) - total / window).otherwise(F.lit(0.0))
            return F.struct(
                put(kept["counts"], code, n + 1).alias("counts"),
                total.alias("sum"),
                F.greatest(state["best"], bits).alias("best"),
                last.alias("last"),
            )

        return _once(left, enter)

    begin = F.struct(F.lit("0" * 128).alias("counts"), F.lit(0.0).alias("sum"), F.lit(0.0).alias("best"), F.lit("").alias("last"))
    return F.aggregate(F.slice(F.split(value, ""), F.lit(1), F.length(value)), begin, step, lambda s: s["best"])


def _suspicious(span: Column) -> Column:
    """A candidate of letters and digits that is not on the allow-list, with a window beyond the threshold of its class."""
    value = span["text"]
    hexadecimal = value.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$")
    threshold = (
        F.when(hexadecimal, F.lit(THRESHOLDS["hex"]))
        .when(~value.rlike("[a-z]") | ~value.rlike("[A-Z]"), F.lit(THRESHOLDS["single case"]))
        .otherwise(F.lit(THRESHOLDS["mixed"]))
    )
    plausible = value.rlike("[0-9]") & value.rlike("[A-Za-z]") & ~value.rlike(ALLOWED)
    return F.when(plausible, best_window_entropy(value) >= threshold).otherwise(F.lit(False))


def scan(docs: DataFrame) -> DataFrame:
    """`docs` with the column `secret_spans`: array of (start, rank, end, text) in order of start, then of KINDS.

    A null or empty text has no spans. All other columns, nulls and repeated rows pass through; a column that is already named
    `secret_spans` is replaced. Base spans are all those of the three patterns; a candidate inside a base span adds nothing.
    """
    text = F.coalesce("text", F.lit(""))
    assigned = F.filter(_positions(text, ASSIGN, 0), lambda s: F.length(F.regexp_extract(s["text"], ASSIGN, 2)) >= 6)
    every = F.concat(assigned, _positions(text, ACCESS, 1), _positions(text, HEX, 2), _positions(text, CANDIDATE, 3))

    def outside(spans: Column) -> Column:
        # The furthest end of the base spans that begin no later: a candidate that ends beyond it is in none of them.
        reach = running(F.transform(spans, lambda s: F.when(s["rank"] < 3, s["end"]).otherwise(0)), lambda a, b: F.greatest(a, b))
        judged = F.zip_with(spans, reach, lambda s, end: F.struct(s.alias("span"), _kept(s, end).alias("kept")))
        return F.transform(F.filter(judged, lambda j: j["kept"]), lambda j: j["span"])

    return docs.withColumn("secret_spans", _once(F.array_sort(every), outside))


def _kept(span: Column, reach: Column) -> Column:
    return F.when(span["rank"] < 3, F.lit(True)).when(span["end"] <= reach, F.lit(False)).otherwise(_suspicious(span))


def _joined(spans: Column) -> Column:
    kinds = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["rank"] + 1), s["start"], s["end"])), ","
    )


def report(scanned: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, digest of the base spans, and all spans."""
    spans = F.col("secret_spans")

    def count(rank: int) -> Column:
        return F.size(F.filter(spans, lambda s: s["rank"] == rank)).cast("long")

    return scanned.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(_joined(F.filter(spans, lambda s: s["rank"] < 3)), 256).alias("base_sha256"),
        _joined(spans).alias("spans"),
    )


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """Documents with every span replaced by a mark and n_chars (if there is one) counted anew; overlapping spans become one.

    Rows without spans are unchanged, null texts included.
    """
    spans, size = F.col("secret_spans"), F.length("text")
    # Code points are counted from the beginning of a block and not of the text.
    blocks = F.regexp_extract_all(F.col("text"), F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))

    def piece(kept: Column, low: Column, high: Column) -> Column:
        """Code points low to high of a text in blocks."""
        places = F.sequence(F.floor(low / BLOCK).cast("int"), F.floor((high - 1) / BLOCK).cast("int"))

        def part(i: Column) -> Column:
            first = F.greatest(low - i * BLOCK, F.lit(0))
            return F.substring(F.element_at(kept, i + 1), first + 1, F.least(high - i * BLOCK, F.lit(BLOCK)) - first)

        return F.when(low < high, F.array_join(F.transform(places, part), "")).otherwise("")

    def rebuilt(kept: Column) -> Column:
        def from_ends(ends: Column) -> Column:
            def before(span: Column, i: Column) -> Column:
                # The end of all spans before this one; an overlapping one adds nothing.
                at = F.when(i == 0, F.lit(0)).otherwise(F.element_at(ends, F.greatest(i, F.lit(1))))
                return F.when(span["start"] >= at, F.concat(piece(kept, at, span["start"]), F.lit(mark))).otherwise("")

            return F.concat(F.array_join(F.transform(spans, before), ""), piece(kept, F.element_at(ends, -1), size))

        return _once(running(F.transform(spans, lambda s: s["end"]), lambda a, b: F.greatest(a, b)), from_ends)

    found = F.size("secret_spans") > 0
    text = F.when(found, _once(blocks, rebuilt)).otherwise(F.col("text"))
    clean = scan(docs).withColumn("text", text)
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.when(found, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return clean.drop("secret_spans")
