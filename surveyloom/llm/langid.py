"""Language identification by segmentation-marginalised unigrams.

A word is the sum over all its segmentations into pieces of a fixed public vocabulary; each language has its own piece
probabilities. They are learned from a bounded sample of the training text: piece occurrences first, then a round of expected
counts over all segmentations (forward and backward sums). Distinct words of a batch are scored together, position by position.
Short words are summed as they are; where a sum comes near the least number of the machine, and for long words, logarithms
are summed instead, so no text is too long and no byte too rare.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.llm.text import LETTER_WORDS, has_letter, row_groups, text_bytes, words

VOCABULARY = "piece_bpe_32k.model"
#: Where the vocabulary is, unless a caller names its path; by default it is the installed public one.
VOCABULARY_SETTING = "surveyloom.vocabulary.pieces"
#: Words up to this many bytes are summed without logarithms first.
SHORT = 48
#: Sums below this are computed again with logarithms; what has underflowed before does not count beside it.
LEAST_SUM = 1e-250
#: Bytes of a long word that are looked at together.
BLOCK = 1 << 14
#: Words over this many bytes (unbroken runs of letters of a whole book) are scored, but not learned from.
LEARNED = 1 << 16
ROUNDS = 1
#: Documents of each language that the model learns from, on average; they are drawn by the hash of doc_id.
TRAINING_DOCS = 5000
UNDETERMINED = "und"

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


_SPREAD = np.uint64(0xD6E8FEB86659FD93)
_SHIFT = np.uint64(44)


class Vocabulary(NamedTuple):
    """Sorted hashes of the pieces, a table that tells most other hashes apart without a search, and the bytes of the longest piece."""

    hashes: np.ndarray
    maybe: np.ndarray
    longest: int

    @property
    def size(self) -> int:
        return len(self.hashes)

    def find(self, h: np.ndarray) -> np.ndarray:
        """The number of the piece of each hash, or -1."""
        out = np.full(len(h), -1, np.int32)
        with np.errstate(over="ignore"):
            some = np.flatnonzero(self.maybe[(h * _SPREAD) >> _SHIFT])
        slot = np.minimum(np.searchsorted(self.hashes, h[some]), self.size - 1)
        hit = self.hashes[slot] == h[some]
        out[some[hit]] = slot[hit]
        return out


def _vocabulary(hashes: np.ndarray, longest: int) -> Vocabulary:
    maybe = np.zeros(1 << 20, bool)
    with np.errstate(over="ignore"):
        maybe[(hashes * _SPREAD) >> _SHIFT] = True
    return Vocabulary(hashes, maybe, longest)


def _piece_hash(piece: bytes) -> int:
    h = 0
    for byte in piece:
        h = (h * int(_MULTIPLIER) + byte + 1) & (2**64 - 1)
    return h


def vocabulary_path(spark: SparkSession) -> str:
    named = spark.conf.get(VOCABULARY_SETTING, None)
    if named:
        return named
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def load_vocabulary(path: str) -> Vocabulary:
    """All pieces of letters of the model, with every single byte besides; a leading space marks a word's beginning."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = {bytes([b]) for b in range(256)}
    for i in range(model.get_piece_size()):
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)):
            piece = model.id_to_piece(i).replace("▁", " ")
            if piece.strip().isalpha() or piece == " ":
                pieces.add(piece.encode())
    return _vocabulary(np.sort(np.array([_piece_hash(p) for p in pieces], np.uint64)), max(map(len, pieces)))


class Lattice(NamedTuple):
    """Words as rows of equal width: bytes that are there, and the piece (or -1) of each start and length."""

    length: np.ndarray
    piece: np.ndarray


def lattice(runs: np.ndarray, length: np.ndarray, vocabulary: Vocabulary) -> Lattice:
    """runs: bytes padded with 0. piece[l - 1, i, w] is the piece of run w from i of l bytes."""
    width = runs.shape[1]
    longest = min(vocabulary.longest, width)
    piece = np.full((longest, width, len(runs)), -1, np.int32)
    columns = np.ascontiguousarray(runs.T).astype(np.uint64) + np.uint64(1)
    with np.errstate(over="ignore"):
        h = np.zeros_like(columns)
        for size in range(1, longest + 1):
            h = h[: width - size + 1] * _MULTIPLIER + columns[size - 1 :]
            inside = np.arange(width - size + 1)[:, None] + size <= length[None, :]
            piece[size - 1, : width - size + 1][inside] = vocabulary.find(h[inside])
    return Lattice(length, piece)


def forward(grid: Lattice, weights: np.ndarray) -> np.ndarray:
    """alpha[i, w, language]: sum over all segmentations of the first i bytes; too small numbers become 0."""
    longest, width, count = grid.piece.shape
    alpha = np.zeros((width + 1, count, weights.shape[1]))
    alpha[0] = 1.0
    for i in range(1, width + 1):
        live = np.flatnonzero(grid.length >= i)
        if not len(live):
            break
        for size in range(1, min(longest, i) + 1):
            own = grid.piece[size - 1, i - size, live]
            some = own >= 0
            at = live[some]
            alpha[i, at] += alpha[i - size, at] * weights[own[some]]
    return alpha


def _log_sum(terms: np.ndarray) -> np.ndarray:
    """Logarithm of the sum over the first axis; one term at least is there, as every byte is a piece."""
    most = terms.max(axis=0)
    return most + np.log(np.exp(terms - most).sum(axis=0))


def _log_weights(weights: np.ndarray) -> np.ndarray:
    """Logarithms, with a last row for no piece."""
    return np.log(np.vstack([weights, np.zeros((1, weights.shape[1]))]), where=np.vstack([weights > 0, np.zeros((1, weights.shape[1]), bool)]), out=np.full((len(weights) + 1, weights.shape[1]), -np.inf))


def log_forward(grid: Lattice, weights: np.ndarray) -> np.ndarray:
    """Logarithms of the same sums, however small they are. Past the end of a word they mean nothing."""
    longest, width, count = grid.piece.shape
    logs, known = np.zeros((width + 1, count, weights.shape[1])), _log_weights(weights)
    for i in range(1, width + 1):
        sizes = np.arange(1, min(longest, i) + 1)
        live = np.flatnonzero(grid.length >= i)
        if not len(live):
            break
        logs[i, live] = _log_sum(known[grid.piece[sizes - 1, i - sizes][:, live]] + logs[i - sizes][:, live])
    return logs


def _padded(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of words with a space before each, padded with 0, and how many there are."""
    size = end - start
    out = np.zeros((len(start), int(size.max()) + 1 if len(start) else 1), np.uint8)
    out[:, 0] = 0x20
    place = np.arange(out.shape[1] - 1)
    inside = place[None, :] < size[:, None]
    out[:, 1:][inside] = data[(start[:, None] + place)[inside]]
    return out, size + 1


def _log_of_long(word: np.ndarray, model: Model) -> np.ndarray:
    """Log probability of one word of any length, block after block: a block needs the sums of the longest piece before it."""
    longest, known = model.vocabulary.longest, _log_weights(model.weights)
    # window[s - 1]: the sum up to s bytes before the place at hand.
    window = np.full((longest, len(model.languages)), -np.inf)
    window[0] = 0.0
    for low in range(0, len(word), BLOCK):
        before = min(low, longest - 1)
        part = word[low - before : low + BLOCK]
        grid = lattice(part[None, :], np.array([len(part)]), model.vocabulary).piece[:, :, 0]
        sizes = np.arange(1, len(grid) + 1)
        begin = np.arange(before + 1, len(part) + 1)[:, None] - sizes[None, :]
        own = np.where(begin >= 0, grid[sizes[None, :] - 1, np.maximum(begin, 0)], -1)
        for pieces in own:
            total = _log_sum(known[pieces] + window[: len(pieces)])
            window[1:] = window[:-1].copy()
            window[0] = total
    return window[0]


def _by_length(length: np.ndarray, limit: int = 1 << 17) -> Iterator[np.ndarray]:
    """Rows in groups of near lengths, at most `limit` bytes together."""
    order = np.argsort(length, kind="stable")
    low = 0
    while low < len(order):
        high = low + 1
        step = max(1, limit // int(length[order[low]] + 4))
        high = min(len(order), low + step)
        high = low + int(np.searchsorted(length[order[low:high]], length[order[low]] + 4, side="right"))
        yield order[low:high]
        low = high


def _distinct(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each group of rows: low, high, bytes, start and end of each distinct word, and the number of each word and where texts begin."""
    data, offsets = text_bytes(texts)
    for low, high in row_groups(offsets, 16 << 20):
        own = offsets[low : high + 1]
        part = data[own[0] : own[-1]]
        found = words(part, own - own[0], LETTER_WORDS)
        _, at, number = np.unique(found.hash, return_index=True, return_inverse=True)
        yield low, high, part, found.start[at], found.end[at], number, found.first


def _counts_frame(training: DataFrame, count, names: list[str]) -> DataFrame:
    """Sums of piece counts by language: piece long, one double for each language."""
    place = {name: i for i, name in enumerate(names)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, total = None, None
        for batch in batches:
            if vocabulary is None:
                vocabulary = count.vocabulary
                total = np.zeros((vocabulary.size, len(names)))
            language = np.array([place[x] for x in batch.column(1).to_pylist()], np.int64)
            for low, high, part, start, end, number, first in _distinct(batch.column(0)):
                owner = np.repeat(language[low:high], np.diff(first))
                times = np.bincount(number * len(names) + owner, minlength=len(start) * len(names)).reshape(len(start), len(names)).astype(float)
                learned = np.flatnonzero(end - start <= LEARNED)
                for rows in _by_length(end[learned] - start[learned]):
                    own = learned[rows]
                    count(*_padded(part, start[own], end[own]), times[own], total)
        if total is not None:
            some = np.flatnonzero(total.any(axis=1))
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(list(total[some]), pa.list_(pa.float64()))], names=["piece", "n"])

    rows = training.mapInArrow(run, "piece long, n array<double>")
    return rows.groupBy("piece").agg(F.array(*(F.sum(F.col("n")[i]) for i in range(len(names)))).alias("n"))


class _Occurrences:
    """Every piece wherever it occurs."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary

    def __call__(self, runs, length, times, total) -> None:
        grid = lattice(runs, length, self.vocabulary)
        for size in range(len(grid.piece)):
            some = grid.piece[size] >= 0
            _, row = np.nonzero(some)
            piece = grid.piece[size][some]
            for language in range(times.shape[1]):
                total[:, language] += np.bincount(piece, times[row, language], self.vocabulary.size)


class _Expected:
    """Expected uses over all segmentations, by forward and backward sums."""

    def __init__(self, vocabulary: Vocabulary, weights: np.ndarray):
        self.vocabulary, self.weights = vocabulary, weights

    def __call__(self, runs, length, times, total) -> None:
        grid = lattice(runs, length, self.vocabulary)
        everyone = np.arange(len(runs))
        fine = np.zeros(len(runs), bool)
        if runs.shape[1] <= SHORT + 1:
            alpha = forward(grid, self.weights)
            fine = (alpha[length, everyone] >= LEAST_SUM).all(axis=1)
            if fine.any():
                kept = Lattice(length[fine], grid.piece[:, :, fine])
                self._plain(kept, alpha[:, fine], times[fine], total)
        if not fine.all():
            self._by_logs(Lattice(length[~fine], grid.piece[:, :, ~fine]), times[~fine], total)

    def _plain(self, grid, alpha, times, total) -> None:
        longest, width, count = grid.piece.shape
        everyone = np.arange(count)
        beta = np.zeros_like(alpha)
        beta[grid.length, everyone] = 1.0
        scale = times / alpha[grid.length, everyone]
        for i in range(width - 1, -1, -1):
            for size in range(1, min(longest, width - i) + 1):
                own = grid.piece[size - 1, i]
                at = np.flatnonzero(own >= 0)
                if not len(at):
                    continue
                onward = self.weights[own[at]] * beta[i + size, at]
                beta[i, at] += onward
                self._add(own[at], alpha[i, at] * onward * scale[at], total)

    def _add(self, pieces, used, total) -> None:
        for language in range(total.shape[1]):
            total[:, language] += np.bincount(pieces, used[:, language], self.vocabulary.size)

    def _by_logs(self, grid, times, total) -> None:
        """The same with logarithms: the sums from the end are those from the beginning of the word read backwards."""
        longest, width, count = grid.piece.shape
        alpha = log_forward(grid, self.weights)
        # Piece of `size` bytes from i, read backwards: it begins where the word's last byte was, length - i - size.
        back = np.full_like(grid.piece, -1)
        for size in range(1, longest + 1):
            i, w = np.nonzero(grid.piece[size - 1] >= 0)
            back[size - 1, grid.length[w] - i - size, w] = grid.piece[size - 1, i, w]
        beta = log_forward(Lattice(grid.length, back), self.weights)
        whole = alpha[grid.length, np.arange(count)]
        for size in range(1, longest + 1):
            i, w = np.nonzero(grid.piece[size - 1] >= 0)
            own = grid.piece[size - 1, i, w]
            logs = alpha[i, w] + np.log(self.weights[own]) + beta[grid.length[w] - i - size, w] - whole[w]
            self._add(own, np.exp(logs) * times[w], total)


def _weights(counts: DataFrame, vocabulary: Vocabulary, languages: int) -> np.ndarray:
    """Probabilities by piece and language; what a language lacks has a small share. At most a number for each piece and language."""
    total = np.full((vocabulary.size, languages), 0.01)
    for piece, n in counts.collect():
        total[piece] += n
    return total / total.sum(axis=0)


class Model(NamedTuple):
    languages: list[str]
    vocabulary: Vocabulary
    weights: np.ndarray


def train(training: DataFrame, path: str | None = None, bound: int = TRAINING_DOCS) -> Model:
    """Piece probabilities from rows of training (doc_id, text, lang) whose lang is not null, `bound` of each language.

    One number for each language and for each piece and language goes to the driver.
    """
    training = training.select("doc_id", "text", "lang").filter("lang IS NOT NULL")
    sizes = dict(training.groupBy("lang").count().collect())
    names = sorted(sizes)
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    drawn = [(F.col("lang") == name) & (place < int(min(1.0, bound / size) * (1 << 30))) for name, size in sizes.items()]
    training = training.filter(reduce(lambda a, b: a | b, drawn, F.lit(False))).select("text", "lang")
    vocabulary = load_vocabulary(path or vocabulary_path(training.sparkSession))
    if not names:
        return Model([], vocabulary, np.zeros((vocabulary.size, 0)))
    weights = _weights(_counts_frame(training, _Occurrences(vocabulary), names), vocabulary, len(names))
    for _ in range(ROUNDS):
        weights = _weights(_counts_frame(training, _Expected(vocabulary, weights), names), vocabulary, len(names))
    return Model(names, vocabulary, weights)


def log_likelihoods(texts: pa.Array, model: Model) -> np.ndarray:
    """Log probability of each text in each language: the sum over its words."""
    out = np.zeros((len(texts), len(model.languages)))
    for low, high, part, start, end, number, first in _distinct(texts):
        own = np.zeros((len(start), len(model.languages)))
        short = np.flatnonzero(end - start <= SHORT)
        for rows in _by_length(end[short] - start[short]):
            at = short[rows]
            grid = lattice(*_padded(part, start[at], end[at]), model.vocabulary)
            everyone = np.arange(len(at))
            sums = forward(grid, model.weights)[grid.length, everyone]
            low_sums = np.flatnonzero((sums < LEAST_SUM).any(axis=1))
            with np.errstate(divide="ignore"):
                own[at] = np.log(sums)
            if len(low_sums):
                rest = Lattice(grid.length[low_sums], grid.piece[:, :, low_sums])
                own[at[low_sums]] = log_forward(rest, model.weights)[rest.length, np.arange(len(low_sums))]
        for at in np.flatnonzero(end - start > SHORT):
            word = np.concatenate([np.array([0x20], np.uint8), part[start[at] : end[at]]])
            own[at] = _log_of_long(word, model)
        total = np.concatenate([np.zeros((1, own.shape[1])), np.cumsum(own[number], axis=0)])
        out[low:high] = total[first[1:]] - total[first[:-1]]
    return out


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score for every row of docs (doc_id, text).

    score is the posterior of the language under equal priors; equal ones go to the first name. Null texts, texts without a
    letter and all texts of a model without languages are `und` with score 0.
    """
    held = docs.sparkSession.sparkContext.broadcast((model.languages, model.vocabulary.hashes, model.vocabulary.longest, model.weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages, hashes, longest, weights = held.value
        own = Model(languages, _vocabulary(hashes, longest), weights)
        for batch in batches:
            logs = log_likelihoods(batch.column(1), own)
            names, scores = [], []
            for text, row in zip(batch.column(1).to_pylist(), logs):
                if not own.languages or not has_letter(text):
                    names.append(UNDETERMINED)
                    scores.append(0.0)
                    continue
                best = int(row.argmax())
                names.append(own.languages[best])
                scores.append(float(1 / np.exp(row - row[best]).sum()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def identify(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score; the model learns from the rows that are not held out.

    held_out: crc32 of doc_id as text is divisible by 5 (a null doc_id is not held out and not learned from). Only text and lang
    of the other rows are learned from, only text is scored. Empty tables give no rows; other columns are ignored.
    """
    rest = F.crc32(F.col("doc_id").cast("string")) % 5
    model = train(docs.filter(rest != 0), path)
    predicted = predict(docs, model)
    return predicted.select("doc_id", F.coalesce(rest == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")
