"""Toxicity of text after noisy-channel deobfuscation.

A token that carries noise (digits and signs for letters, stretched letters, letters set apart) is a lattice of what each
character may stand for; the most likely path under a character trigram model, trained on all texts, is its restored form.
Restored and plain words are then scored alike, by log odds of words and word beginnings.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyloom.llm.storage import stored
from surveyloom.llm.text import FOLDED_LETTERS, SPACED_WORDS, mix, row_groups, text_bytes, words

#: Labelled documents that the classifier learns from, on average, drawn by the hash of doc_id. Each half of them is
#: measured with the terms of the other half to calibrate the score.
TRAINING_DOCS = 20_000
#: A term counts if at least so many toxic training documents have it, and from this log odds on. Its share of toxic documents
#: is smoothed with this many documents of the base rate, so that rare terms weigh less.
LEAST_DOCS, LEAST_ODDS, PRIOR = 3, 2.0, 4.0
BEGINNINGS = (4, 5, 6)

#: What a character may stand for besides itself.
STANDS_FOR = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "2": "z", "@": "a", "$": "s",
    "!": "il", "|": "il", "+": "t", "€": "e", "£": "l", "¡": "i", "(": "c", "<": "c", "*": "aeiou", "#": "h", "%": "x",
}
#: Cost of a substitution, of dropping a sign, and of shortening a run of letters, in nats.
SUBSTITUTED, DROPPED, SHORTENED = 0.5, 9.0, 0.3
#: Cost of dropping a character that stands for no letter, and of shortening a mere double letter.
STRIPPED, UNDOUBLED = 1.0, 3.0

#: Signs that count as noise behind a letter at the end of a token, too; the others end sentences and lists.
AT_THE_END = "0123456789@$€£"
#: Characters of a token that are decoded in one piece; of longer ones pieces that overlap by OVERLAP.
PIECE, OVERLAP = 4096, 256

_LETTERS = 28
_PARTED = re.compile(r"[A-Za-z0-9@$!|*](?:[.\-_*~,/\\][A-Za-z0-9@$!|*]){2,}[.!?,;:]*")


def _symbols() -> np.ndarray:
    """0: no letter, 1 to 26: a to z in either case, 27: a byte of any other character."""
    table = np.zeros(256, np.int64)
    table[97:123] = table[65:91] = np.arange(1, 27)
    table[128:] = 27
    return table


class CharacterModel(NamedTuple):
    """logs[a, b, c]: log probability of symbol c after a and b."""

    logs: np.ndarray

    def symbol(self, char: str) -> int:
        return ord(char) - 96 if "a" <= char <= "z" else 0 if not char.isalpha() else 27


def train_characters(docs: DataFrame) -> CharacterModel:
    """Trigrams of letters of all texts; 28 ** 3 numbers go to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, total = _symbols(), np.zeros(_LETTERS**3, np.int64)
        for batch in batches:
            data, offsets = text_bytes(batch.column(0))
            for low, high in row_groups(offsets):
                for at in range(int(offsets[low]), int(offsets[high]), 1 << 20):
                    own = table[data[at : min(at + (1 << 20), int(offsets[high]))]]
                    own = np.concatenate([[0, 0], own])
                    total += np.bincount(own[:-2] * _LETTERS**2 + own[1:-1] * _LETTERS + own[2:], minlength=_LETTERS**3)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["gram", "n"])

    counts = np.zeros(_LETTERS**3)
    for gram, n in docs.select("text").mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n")).collect():
        counts[gram] = n
    counts = counts.reshape(_LETTERS, _LETTERS, _LETTERS)
    pair = (counts.sum(axis=0) + 1) / (counts.sum(axis=0) + 1).sum(axis=1, keepdims=True)
    return CharacterModel(np.log((counts + 5 * pair[None]) / (counts.sum(axis=2, keepdims=True) + 5)))


def _lattice(token: str) -> list[list[tuple[str, float]]]:
    """For each run of equal characters, the strings it may stand for with their costs."""
    out = []
    for run in re.finditer(r"(.)\1*", token, re.S):
        char, size = run[1], len(run[0])
        short = min(size, 2)
        edges: dict[str, float] = {}
        if char.isalpha():
            edges[char * short] = 0.0 if size <= 2 else SHORTENED
            if size > 1:
                edges[char] = SHORTENED if size > 2 else UNDOUBLED
        for letter in STANDS_FOR.get(char, ""):
            edges[letter * short] = SUBSTITUTED * short + math.log(len(STANDS_FOR[char]))
            if size > 1:
                edges[letter] = SUBSTITUTED + SHORTENED + math.log(len(STANDS_FOR[char]))
        if not char.isalpha():
            edges[""] = DROPPED if char in STANDS_FOR else STRIPPED
        out.append(list(edges.items()))
    return out


def restore(token: str, model: CharacterModel) -> str:
    """The most likely letters behind a token (Viterbi over states of two symbols); the empty string if it has none."""
    states: dict[tuple[int, int], tuple[float, str]] = {(0, 0): (0.0, "")}
    for edges in [*_lattice(token.lower().rstrip("!?.,;:)*")), [(" ", 0.0)]]:
        following: dict[tuple[int, int], tuple[float, str]] = {}
        for (a, b), (cost, text) in states.items():
            for piece, price in edges:
                x, y, total = a, b, cost + price
                for char in piece:
                    z = model.symbol(char)
                    total -= model.logs[x, y, z]
                    x, y = y, z
                if (x, y) not in following or total < following[x, y][0]:
                    following[x, y] = (total, text + piece)
        states = following
    return min(states.values())[1].strip() if states else ""


def _byte_classes(data: np.ndarray) -> np.ndarray:
    """For each byte 1: letter, 2: digit or sign that stands for a letter, 4: sign that sets letters apart, 8: one of AT_THE_END.

    All bytes of a character beyond ASCII count as a letter, or as a sign if the character is one.
    """
    table = np.zeros(256, np.uint8)
    table[65:91] = table[97:123] = 1
    table[128:] = 1
    for char in STANDS_FOR:
        if char.isascii():
            table[ord(char)] |= 2 | 8 * (char in AT_THE_END)
    for char in ".-_*~,/\\":
        table[ord(char)] |= 4
    kinds = table[data]
    for char in STANDS_FOR:
        own = np.frombuffer(char.encode(), np.uint8)
        if len(own) > 1 and len(data) >= len(own):
            begins = np.logical_and.reduce([data[i : len(data) - len(own) + 1 + i] == own[i] for i in range(len(own))])
            for i in range(len(own)):
                kinds[np.flatnonzero(begins) + i] = 2 | 8 * (char in AT_THE_END)
    return kinds


def _noisy(data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, str, bool]]:
    """(text, token, parted) of every token that carries noise, and of every run of three or more lone characters."""
    found = words(data, offsets, SPACED_WORDS)
    if not len(found.start):
        return []
    kinds = _byte_classes(data)
    letter, sign = (kinds & 1).astype(bool), (kinds & 2).astype(bool)
    parts = (kinds & 4).astype(bool)
    noise = np.zeros(len(data), bool)
    noise[:-1] |= sign[:-1] & letter[1:]
    noise[1:] |= ((kinds[1:] & 8) > 0) & letter[:-1]
    inner = sign[1:-1] & letter[:-2] & (sign[2:] | letter[2:]) & (data[1:-1] != data[2:])
    noise[1:-1] |= inner
    folded = np.where((data >= 65) & (data <= 90), data + 32, data)
    noise[2:] |= letter[2:] & (data[2:] < 128) & (folded[2:] == folded[1:-1]) & (folded[2:] == folded[:-2])
    if len(data) > 3:
        either = letter | sign
        noise[3:-1] |= parts[3:-1] & either[2:-2] & either[4:] & parts[1:-3]
    edge = np.concatenate([[0], np.cumsum(noise)])
    has = edge[found.end] > edge[found.start]
    edge = np.concatenate([[0], np.cumsum(letter)])
    has &= edge[found.end] > edge[found.start]
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(found.first))
    out = []
    for i in np.flatnonzero(has).tolist():
        token = data[found.start[i] : found.end[i]].tobytes().decode()
        if _PARTED.fullmatch(token):
            out.append((int(owner[i]), re.sub(r"[.\-_*~,/\\]", "", token), True))
        else:
            out += [(int(owner[i]), token[k : k + PIECE], False) for k in range(0, max(1, len(token) - OVERLAP), PIECE - OVERLAP)]
    size = found.end - found.start
    last = np.isin(data[found.end - 1], np.frombuffer(b".,!?;:", np.uint8))
    alone = ((size == 1) | ((size == 2) & last)) & (letter | sign)[found.start]
    step = np.diff(np.concatenate([[0], alone.view(np.int8), [0]]))
    for low, high in zip(np.flatnonzero(step == 1).tolist(), np.flatnonzero(step == -1).tolist()):
        for text in range(int(owner[low]), int(owner[high - 1]) + 1):
            a, b = max(low, int(found.first[text])), min(high, int(found.first[text + 1]))
            if b - a >= 3:
                out.append((text, data[found.start[a:b]].tobytes().decode(), True))
    return out


def terms(data: np.ndarray, start: np.ndarray, end: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Feature hashes of words: the whole word, and its beginnings (the whole word again where it is not longer)."""
    columns = [mix(hashes ^ np.uint64(1))]
    with np.errstate(over="ignore"):
        h = np.zeros(len(start), np.uint64)
        for j in range(max(BEGINNINGS)):
            inside = start + j < end
            byte = FOLDED_LETTERS.value[data[np.minimum(start + j, len(data) - 1)]]
            h = np.where(inside, h * np.uint64(0x9E3779B97F4A7C15) + byte, h)
            if j + 1 in BEGINNINGS:
                columns.append(np.where(start + j < end, mix(h ^ np.uint64(j + 2)), columns[0]))
    return np.stack(columns, axis=1)


def document_terms(texts: pa.Array, model: CharacterModel) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For each group of rows: low, high, and for each distinct word of each text the text (from low) and its terms."""
    data, offsets = text_bytes(texts)
    memory: dict[str, str] = {}
    for low, high in row_groups(offsets, 2 << 20):
        own = offsets[low : high + 1]
        part, begin = data[own[0] : own[-1]], own - own[0]
        found = words(part, begin, FOLDED_LETTERS)
        owner = np.repeat(np.arange(high - low), np.diff(found.first))
        _, at, number = np.unique(found.hash, return_index=True, return_inverse=True)
        plain = terms(part, found.start[at], found.end[at], found.hash[at]) if len(at) else np.zeros((0, 1 + len(BEGINNINGS)), np.uint64)
        pairs = np.unique(owner * max(1, len(at)) + number)
        rows, known = pairs // max(1, len(at)), plain[pairs % max(1, len(at))] if len(at) else plain
        restored: list[tuple[int, str]] = []
        for text, token, parted in _noisy(part, begin):
            if token not in memory:
                if len(memory) > 200_000:
                    memory.clear()
                memory[token] = restore(token, model)
            word = memory[token]
            restored.append((text, word))
            if parted:
                restored += [(text, word[i : i + k]) for k in range(4, 13) for i in range(len(word) - k + 1)]
        if restored:
            extra, edges = text_bytes(pa.array([w for _, w in restored], pa.large_string()))
            more = words(extra, edges, FOLDED_LETTERS)
            whose = np.repeat(np.array([t for t, _ in restored]), np.diff(more.first))
            rows = np.concatenate([rows, whose])
            known = np.concatenate([known, terms(extra, more.start, more.end, more.hash)])
        yield low, high, rows, known


class Classifier(NamedTuple):
    """Log odds of the terms that count (sorted), and the calibration of a document's evidence."""

    terms: np.ndarray
    odds: np.ndarray
    calibration: np.ndarray


def evidence(low: int, high: int, rows: np.ndarray, known: np.ndarray, lexicon: np.ndarray, odds: np.ndarray) -> np.ndarray:
    """For each text the highest odds of a word, and the sum of the three highest."""
    out = np.zeros((high - low, 2))
    if not len(lexicon) or not len(rows):
        return out
    slot = np.minimum(np.searchsorted(lexicon, known), len(lexicon) - 1)
    best = np.where(lexicon[slot] == known, odds[slot], 0.0).max(axis=1)
    some = np.flatnonzero(best > 0)
    some = some[np.lexsort((-best[some], rows[some]))]
    row, value = rows[some], best[some]
    first = np.searchsorted(row, row)
    place = np.arange(len(row)) - first
    np.add.at(out[:, 1], row[place < 3], value[place < 3])
    out[row[place == 0], 0] = value[place == 0]
    return out


def _fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = 0.1) -> np.ndarray:
    """Intercept and weights by Newton's method; without both classes a constant near their share."""
    design = np.column_stack([np.ones(len(x)), x])
    weights = np.zeros(design.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(design @ weights, -30, 30)))
        gradient = design.T @ (p - y) + penalty * weights
        hessian = (design * (p * (1 - p))[:, None]).T @ design + penalty * np.eye(design.shape[1])
        step = np.linalg.solve(hessian, gradient)
        weights -= step
        if np.abs(step).max() < 1e-6:
            break
    return weights


def train(docs: DataFrame, labels: DataFrame, characters: CharacterModel, bound: int = TRAINING_DOCS) -> Classifier:
    """Learns from docs (doc_id, text) with labels (doc_id, toxic); about `bound` labelled rows are drawn and broadcast."""
    labelled = labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int")).filter("doc_id IS NOT NULL AND toxic IN (0, 1)")
    labelled = labelled.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    share = min(1.0, bound / max(1, labelled.count()))
    drawn = labelled.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    sample = docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(drawn), "doc_id")
    half = F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(2)).cast("int")
    # Stored, as it is read three times; a bounded sample, whatever the corpus.
    sample = stored(sample.select("text", "toxic", half.alias("half")), "labelled")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label, side = np.array(batch.column(1)), np.array(batch.column(2))
            for low, high, rows, known in document_terms(batch.column(0), characters):
                term = known.ravel()
                row = np.repeat(rows, known.shape[1])
                order = np.lexsort((row, term))
                term, row = term[order], row[order]
                new = np.ones(len(term), bool)
                new[1:] = (term[1:] != term[:-1]) | (row[1:] != row[:-1])
                row = row[new]
                unique, at = np.unique(term[new], return_inverse=True)
                cell = 4 * at + 2 * side[low:high][row] + label[low:high][row]
                counts = np.bincount(cell, minlength=4 * len(unique)).reshape(-1, 4)
                names = ["term", "good0", "bad0", "good1", "bad1"]
                yield pa.RecordBatch.from_arrays([pa.array(unique.view(np.int64)), *(pa.array(c) for c in counts.T)], names=names)

    sizes = np.zeros((2, 2))
    for side, toxic, n in sample.groupBy("half", "toxic").count().collect():
        sizes[side, toxic] = n
    names = ("good0", "bad0", "good1", "bad1")
    counts = sample.mapInArrow(count, "term long, good0 long, bad0 long, good1 long, bad1 long")
    counts = counts.groupBy("term").agg(*(F.sum(c).alias(c) for c in names)).filter(F.col("bad0") + F.col("bad1") >= LEAST_DOCS)
    good, bad = sizes.sum(axis=0).tolist()
    rate = (bad + 1) / (good + bad + 2)
    seen = sum((F.col(c) for c in names[1:]), F.col(names[0]))
    toxic = (F.col("bad0") + F.col("bad1") + PRIOR * rate) / (seen + PRIOR)
    odds = F.log(toxic / (1 - toxic)) - math.log(rate / (1 - rate))
    found = np.array([tuple(r) for r in counts.filter(odds >= LEAST_ODDS).collect()], np.int64).reshape(-1, 5)
    hashes = found[:, 0].copy().view(np.uint64)
    order = np.argsort(hashes)
    hashes, cells = hashes[order], found[order, 1:].reshape(-1, 2, 2)

    def odds_of(cells: np.ndarray) -> np.ndarray:
        toxic = (cells[:, 1] + PRIOR * rate) / (cells.sum(axis=1) + PRIOR)
        own = np.log(toxic / (1 - toxic)) - math.log(rate / (1 - rate))
        return np.where((cells[:, 1] >= LEAST_DOCS) & (own >= LEAST_ODDS), own, 0.0)

    # Each half of the sample is measured with the odds of the other half.
    sides = [odds_of(cells[:, 1]), odds_of(cells[:, 0])]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            side = np.array(batch.column(2))
            for low, high, rows, known in document_terms(batch.column(0), characters):
                either = [evidence(low, high, rows, known, hashes, own) for own in sides]
                values = np.where((side[low:high] == 0)[:, None], either[0], either[1])
                names = ["top", "three", "toxic"]
                yield pa.RecordBatch.from_arrays([pa.array(values[:, 0]), pa.array(values[:, 1]), batch.column(1)[low:high]], names=names)

    points = np.array([tuple(r) for r in sample.mapInArrow(measure, "top double, three double, toxic int").collect()], float).reshape(-1, 3)
    return Classifier(hashes, odds_of(cells.sum(axis=1)), _fit_logistic(points[:, :2], points[:, 2]))


def score(docs: DataFrame, characters: CharacterModel, classifier: Classifier) -> DataFrame:
    """doc_id, score, predicted for every row of docs (doc_id, text)."""
    held = docs.sparkSession.sparkContext.broadcast((characters.logs, *classifier))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logs, lexicon, odds, calibration = held.value
        model = CharacterModel(logs)
        for batch in batches:
            out = np.zeros(batch.num_rows)
            for low, high, rows, known in document_terms(batch.column(1), model):
                found = evidence(low, high, rows, known, lexicon, odds)
                out[low:high] = 1 / (1 + np.exp(-np.clip(calibration[0] + found @ calibration[1:], -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out), pa.array((out >= 0.5).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double, predicted int")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs (doc_id, text); labels (doc_id, toxic) of the rows that are not
    held out are learned from.

    held_out: crc32 of doc_id as text is divisible by 5. A null doc_id is not held out and has no label; a null label is none;
    a doc_id labelled twice is toxic if any label says so. Null and empty texts have the score of a text without evidence.
    Without labels every score is 0.5. An empty table gives no rows; other columns are ignored.
    """
    rest = F.crc32(F.col("doc_id").cast("string")) % 5
    characters = train_characters(docs)
    classifier = train(docs, labels.filter(rest != 0), characters)
    scored = score(docs, characters, classifier)
    return scored.select("doc_id", F.coalesce(rest == 0, F.lit(False)).alias("held_out"), "score", "predicted")
