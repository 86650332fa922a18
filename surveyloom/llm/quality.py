"""Quality of documents by co-training two views.

The content view sees the words of a text: their repetition, length, case and script. The page view sees what a page is
besides its words: language, source, size, and how it is set (lines, white space, punctuation and markup signs). No column is in both.
Each view is a logistic classifier. In each round a view gives its most confident guesses on all unlabelled documents to the
other view as labels. At the end both are calibrated on labelled documents that they have not seen, and combined. The features
of all documents are stored once; rounds are passes over them that bring one row of counts, gradients and Hessians to the driver.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from surveyloom.llm.storage import stored
from surveyloom.llm.text import SPACED_WORDS, mix, row_groups, shingles, text_bytes, words

#: Labelled documents that the classifiers learn from, on average; they are drawn by the hash of doc_id. Only their features go
#: to the driver. Of unlabelled documents all take part.
TRAINING_DOCS = 10_000
#: In a round a view gives for each class this share of the unlabelled documents, its most confident ones, if it is CONFIDENT.
ROUNDS, GIVEN, CONFIDENT = 4, 0.05, 0.97
#: Newton steps of a round, which begins with the weights of the round before.
STEPS, SMALL_STEP = 6, 1e-3
#: Cells of the histogram of margins, from -SPAN to SPAN, from which thresholds are taken.
CELLS, SPAN = 4096, 16.0
#: Sources and languages are hashed into so many columns each.
HASHED = 16
CONTENT_FEATURES = 14
LAYOUT_FEATURES = 13
PAGE_FEATURES = LAYOUT_FEATURES + 2 * HASHED
#: Rows of sums that one task adds up.
ADDED = 256


def _text_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Content features, and layout features, of each text. A null text is an empty one."""
    data, offsets = text_bytes(texts)
    content = np.zeros((len(texts), CONTENT_FEATURES))
    layout = np.zeros((len(texts), LAYOUT_FEATURES))
    for low, high in row_groups(offsets):
        own = offsets[low : high + 1]
        content[low:high], layout[low:high] = _group_features(data[own[0] : own[-1]], own - own[0])
    return content, layout


def _sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return (total[offsets[1:]] - total[offsets[:-1]]).astype(float)


def _repeats(values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each text the number of distinct values, and how often its most frequent one occurs."""
    texts = len(first) - 1
    owner = np.repeat(np.arange(texts, dtype=np.uint64), np.diff(first))
    with np.errstate(over="ignore"):
        _, at, count = np.unique(values ^ mix(owner + np.uint64(1)), return_index=True, return_counts=True)
    where = owner[at].astype(np.int64)
    top = np.zeros(texts)
    np.maximum.at(top, where, count)
    return np.bincount(where, minlength=texts).astype(float), top


def _group_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    size = np.maximum(np.diff(offsets), 1).astype(float)
    upper = (data >= 65) & (data <= 90)
    lower = (data >= 97) & (data <= 122)
    digit = (data >= 48) & (data <= 57)
    wide = data >= 128
    space = (data == 32) | ((data >= 9) & (data <= 13))
    sign = ~(upper | lower | digit | wide | space)
    line = data == 10
    n_upper, n_lower, n_digit, n_wide, n_space, n_sign = (_sums(x, offsets) for x in (upper, lower, digit, wide, space, sign))

    found = words(data, offsets, SPACED_WORDS)
    count = np.diff(found.first).astype(float)
    some = np.maximum(count, 1)
    distinct, top = _repeats(found.hash, found.first)
    runs, begin = shingles(found, 3)
    run_count = np.maximum(np.diff(begin), 1)
    run_distinct, run_top = _repeats(runs, begin)
    owner = np.repeat(np.arange(len(size)), np.diff(found.first))
    length = (found.end - found.start).astype(float)
    again = np.zeros(len(found.hash), bool)
    again[1:] = (found.hash[1:] == found.hash[:-1]) & (owner[1:] == owner[:-1])
    ending = sign[found.end - 1] & ~np.isin(data[found.end - 1], np.frombuffer(b".,;:?!)\"'", np.uint8)) if len(owner) else again
    totals = np.concatenate([[0], np.cumsum(~(sign | space))])
    bare = totals[found.end] == totals[found.start]
    double = np.zeros(len(owner), bool)
    if len(owner):
        before = np.maximum(found.end - 2, found.start)
        double = (length > 2) & (data[before] == data[found.end - 1]) & sign[before]

    def share(flags: np.ndarray) -> np.ndarray:
        return np.bincount(owner, flags, len(size)) / some

    mean = np.bincount(owner, length, len(size)) / some
    spread = np.sqrt(np.maximum(np.bincount(owner, length**2, len(size)) / some - mean**2, 0))
    letters = np.maximum(n_upper + n_lower, 1)
    log_words = np.log1p(count)
    content = np.column_stack([
        distinct / some, np.log(np.maximum(distinct, 1)) / np.maximum(log_words, 1), top / some, share(again), run_distinct / run_count,
        run_top / run_count, mean / 10, spread / 10, share(ending), share(bare), share(double), n_upper / letters,
        n_digit / size, n_wide / size,
    ])

    lines = _sums(line, offsets) + 1
    breaks = np.flatnonzero(line)
    ends = np.unique(np.concatenate([breaks, offsets[1:]]))
    starts = np.concatenate([[0], ends[:-1]])
    text_of = np.minimum(np.searchsorted(offsets, ends, side="left") - 1, len(size) - 1)
    longest = np.zeros(len(size))
    if len(text_of) and len(size):
        np.maximum.at(longest, np.maximum(text_of, 0), (ends - starts).astype(float))
    pipes = _sums((data == 124) | (data == 9), offsets)
    stops = _sums((data == 46) | (data == 63), offsets)
    shouts = _sums(data == 33, offsets)
    commas = _sums(data == 44, offsets)
    odd = _sums(np.isin(data, np.frombuffer(b"#$%&*+<=>@[\\]^_`{|}~", np.uint8)), offsets)
    layout = np.column_stack([
        np.log1p(size) / 10, np.log1p(lines) / 5, np.log1p(size / lines) / 10, longest / size, n_sign / size, n_space / size, pipes / lines / 10,
        pipes / some, stops / some, shouts / some, commas / some, odd / some, (np.diff(offsets) == 0).astype(float),
    ])
    return content, layout


def _hashed(names: list[str | None], salt: int) -> np.ndarray:
    out = np.zeros((len(names), HASHED))
    for i, name in enumerate(names):
        if name is not None:
            out[i, zlib.crc32(name.encode(), salt) % HASHED] = 1.0
    return out


def views(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Content and page view of the columns text, lang, source. n_chars is measured, not believed."""
    content, layout = _text_features(batch.column("text"))
    page = np.column_stack([layout, _hashed(batch.column("lang").to_pylist(), 1), _hashed(batch.column("source").to_pylist(), 2)])
    return content, page


def _logit(p: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(p, -30, 30)))


class Logistic(NamedTuple):
    center: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def margin(self, x: np.ndarray) -> np.ndarray:
        return self.weights[0] + np.clip((x - self.center) / self.scale, -8, 8) @ self.weights[1:]


def fit(x: np.ndarray, y: np.ndarray, penalty: float = 1.0) -> Logistic:
    """Penalised logistic regression on standardised columns, by Newton's method."""
    center = x.mean(axis=0) if len(x) else np.zeros(x.shape[1])
    scale = x.std(axis=0) + 1e-3 if len(x) else np.ones(x.shape[1])
    design = np.column_stack([np.ones(len(x)), np.clip((x - center) / scale, -8, 8)])
    ridge = np.full(design.shape[1], penalty)
    ridge[0] = 1e-3
    weights = np.zeros(design.shape[1])
    for _ in range(40):
        p = _logit(design @ weights)
        step = np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + np.diag(ridge), design.T @ (p - y) + ridge * weights)
        weights -= step
        if np.abs(step).max() < 1e-6:
            break
    return Logistic(center, scale, weights)


class Model(NamedTuple):
    content: Logistic
    page: Logistic
    combined: Logistic

    def score(self, content: np.ndarray, page: np.ndarray) -> np.ndarray:
        return _logit(self.combined.margin(np.column_stack([self.content.margin(content), self.page.margin(page)])))


#: Sums of step(content, page) over all unlabelled rows.
Sums = Callable[[Callable[[np.ndarray, np.ndarray], np.ndarray]], np.ndarray]


def _design(model: Logistic, x: np.ndarray) -> np.ndarray:
    return np.column_stack([np.ones(len(x)), np.clip((x - model.center) / model.scale, -8, 8)])


def _newton_sums(design: np.ndarray, y: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Count, gradient and Hessian of the log loss, in one row."""
    p = _logit(design @ weights)
    return np.concatenate([[len(y)], design.T @ (p - y), ((design * (p * (1 - p))[:, None]).T @ design).ravel()])


class Gift(NamedTuple):
    """The guesses that a view gives away: margins up to low are 0, from high on 1."""

    giver: Logistic
    low: float
    high: float


def _cell(margin: np.ndarray) -> np.ndarray:
    return np.clip(np.floor((margin + SPAN) * (CELLS / (2 * SPAN))), 0, CELLS - 1).astype(np.int64)


def _counts(models: list[Logistic]) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    def step(content: np.ndarray, page: np.ndarray) -> np.ndarray:
        return np.concatenate([np.bincount(_cell(m.margin(x)), minlength=CELLS).astype(float) for m, x in zip(models, (content, page))])

    return step


def _gift(giver: Logistic, counts: np.ndarray) -> Gift | None:
    """Whole cells from both ends until they hold the share GIVEN; only confident ones. None if there is none."""
    share, bound = GIVEN * counts.sum(), float(np.log(CONFIDENT / (1 - CONFIDENT)))
    first = _cell(np.array([-bound, bound]))
    low = min(int(np.searchsorted(np.cumsum(counts), share)), int(first[0]) - 1)
    high = max(CELLS - 1 - int(np.searchsorted(np.cumsum(counts[::-1]), share)), int(first[1]) + 1)
    return Gift(giver, low, high) if counts[: low + 1].any() or counts[high:].any() else None


def _taken(gifts: list[Gift], x: np.ndarray) -> np.ndarray:
    """The first label that a row is given, or -1."""
    label = np.full(len(x), -1)
    for giver, low, high in gifts:
        cell = _cell(giver.margin(x))
        label = np.where(label >= 0, label, np.where(cell <= low, 0, np.where(cell >= high, 1, -1)))
    return label


def _gift_sums(models: list[Logistic], gifts: list[list[Gift]]) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """Newton sums of both views over what the other view gave them."""

    def step(content: np.ndarray, page: np.ndarray) -> np.ndarray:
        out = []
        for model, own, other, given in ((models[0], content, page, gifts[1]), (models[1], page, content, gifts[0])):
            label = _taken(given, other)
            own, label = own[label >= 0], label[label >= 0]
            out.append(_newton_sums(_design(model, own), label.astype(float), model.weights))
        return np.concatenate(out)

    return step


def _learned(content: np.ndarray, page: np.ndarray, label: np.ndarray, sums: Sums) -> Model | None:
    """Labelled rows are at hand, unlabelled ones are seen through sums. A quarter of the labelled rows only calibrate.

    What a view was given weighs together as much as the labelled rows at most, so that the balance does not follow the size.
    """
    known = np.arange(len(label))
    if len(np.unique(label)) < 2:
        return None
    held = known[3::4] if len(np.unique(label[known[3::4]])) == 2 and len(np.unique(label[np.setdiff1d(known, known[3::4])])) == 2 else known
    seen = np.setdiff1d(known, held) if len(held) < len(known) else known
    sides, target = [content, page], label[seen].astype(float)
    models = [fit(x[seen], target) for x in sides]
    gifts: list[list[Gift]] = [[], []]
    for _ in range(ROUNDS):
        counts = sums(_counts(models)).reshape(2, CELLS)
        fresh = [_gift(m, c) for m, c in zip(models, counts)]
        if not any(fresh):
            break
        for given, gift in zip(gifts, fresh):
            given += [gift] if gift else []
        for _ in range(STEPS):
            parts = np.split(sums(_gift_sums(models, gifts)), [1 + (n := CONTENT_FEATURES + 1) + n * n])
            moved = []
            for i, (model, x, part) in enumerate(zip(models, sides, parts)):
                n = len(model.weights)
                own = _newton_sums(_design(model, x[seen]), target, model.weights)
                own = own + min(1.0, len(seen) / max(1.0, part[0])) * part
                ridge = np.array([1e-3] + [1.0] * (n - 1))
                step = np.linalg.solve(own[1 + n :].reshape(n, n) + np.diag(ridge), own[1 : 1 + n] + ridge * model.weights)
                models[i] = model._replace(weights=model.weights - step)
                moved.append(np.abs(step).max())
            if max(moved) < SMALL_STEP:
                break
    margins = np.column_stack([m.margin(x[held]) for m, x in zip(models, sides)])
    return Model(models[0], models[1], fit(margins, label[held].astype(float), 0.1))


def co_train(content: np.ndarray, page: np.ndarray, label: np.ndarray) -> Model | None:
    """On rows at hand. label: 0, 1, or -1 for unlabelled rows. None without both classes."""
    known, pool = np.flatnonzero(label >= 0), np.flatnonzero(label < 0)
    return _learned(content[known], page[known], label[known], lambda step: step(content[pool], page[pool]))


_COLUMNS = ("text", "lang", "source")


def _key():
    return F.pmod(F.xxhash64("doc_id", F.lit(4)), F.lit(1 << 30))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float32).reshape(-1, width).astype(float)


def _added(rows: DataFrame) -> DataFrame:
    """rows (part, sums) of a partition as one row, added in the order of part, so that reruns agree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, first = None, 0
        for batch in batches:
            for part, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                first, total = (part, np.frombuffer(own).copy()) if total is None else (first, total + np.frombuffer(own))
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([first]), pa.array([total.tobytes()], pa.binary())], names=["part", "sums"])

    return rows.sortWithinPartitions("part").mapInArrow(run, "part long, sums binary")


def _pool_sums(pool: DataFrame) -> Sums:
    """Each task adds up its rows, further tasks add up ADDED rows of sums each; one row goes to the driver."""
    parts = pool.rdd.getNumPartitions()

    def sums(step: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext

            total = None
            for batch in batches:
                part = step(_matrix(batch.column(0), CONTENT_FEATURES), _matrix(batch.column(1), PAGE_FEATURES))
                total = part if total is None else total + part
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()]), pa.array([total.tobytes()], pa.binary())], names=["part", "sums"])

        rows, left = pool.select("content", "page").mapInArrow(run, "part long, sums binary"), parts
        while left > 1:
            left = -(-left // ADDED)
            rows = _added(rows.repartitionById(left, F.floor(F.col("part") / ADDED).cast("int") % left))
        found = rows.collect()
        return np.frombuffer(found[0].sums) if found else step(np.zeros((0, CONTENT_FEATURES)), np.zeros((0, PAGE_FEATURES)))

    return sums


def features(docs: DataFrame, labels: DataFrame, labelled: int = TRAINING_DOCS) -> DataFrame:
    """doc_id, quality (0, 1, or -1 for rows that are not learned from as labelled), content and page of every row, stored.

    docs: doc_id, text, lang, source; labels: doc_id, quality.
    """
    given = labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int")).filter("doc_id IS NOT NULL AND quality IN (0, 1)")
    given = given.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    drawn = given.filter(_key() < int(min(1.0, labelled / max(1, given.count())) * (1 << 30)))
    own = docs.select(F.col("doc_id").cast("long"), *_COLUMNS).join(F.broadcast(drawn), "doc_id", "left")
    own = own.select(*_COLUMNS, F.coalesce("quality", F.lit(-1)).alias("quality"), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs = [pa.array([row.tobytes() for row in view.astype(np.float32)], pa.binary()) for view in views(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("quality"), *blobs], names=["doc_id", "quality", "content", "page"])

    return stored(own.mapInArrow(run, "doc_id long, quality int, content binary, page binary"), "features")


def learn(known: DataFrame) -> Model | None:
    """Co-trains on the rows of `features`."""
    rows = known.filter("quality >= 0").toArrow().sort_by([("doc_id", "ascending"), ("content", "ascending"), ("page", "ascending")])
    content, page = _matrix(rows["content"], CONTENT_FEATURES), _matrix(rows["page"], PAGE_FEATURES)
    return _learned(content, page, rows["quality"].to_numpy(), _pool_sums(known.filter("quality < 0")))


def train(docs: DataFrame, labels: DataFrame, labelled: int = TRAINING_DOCS) -> Model | None:
    """Co-trains on docs (doc_id, text, lang, source) and labels (doc_id, quality)."""
    return learn(features(docs, labels, labelled))


def score_features(known: DataFrame, model: Model | None) -> DataFrame:
    """doc_id and quality_score of the rows of `features`; no text is read again."""
    parts = [tuple(m) for m in model] if model else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*(Logistic(*p) for p in parts)) if parts else None
        for batch in batches:
            value = np.full(batch.num_rows, 0.5)
            if own and batch.num_rows:
                value = own.score(_matrix(batch.column(1), CONTENT_FEATURES), _matrix(batch.column(2), PAGE_FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(value)], names=["doc_id", "quality_score"])

    return known.select("doc_id", "content", "page").mapInArrow(run, "doc_id long, quality_score double")


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """`docs` with the column quality_score; its other columns and rows pass through."""
    parts = [tuple(m) for m in model] if model else None
    columns = [c for c in docs.columns if c != "quality_score"]
    docs = docs.select(*(F.col(f"`{c}`") for c in columns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*(Logistic(*p) for p in parts)) if parts else None
        for batch in batches:
            value = own.score(*views(batch)) if own and batch.num_rows else np.full(batch.num_rows, 0.5)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(value)], names=[*columns, "quality_score"])

    schema = StructType([*docs.schema.fields, StructField("quality_score", DoubleType())])
    return docs.mapInArrow(run, schema)


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs (doc_id, text, lang, source).

    score is the calibrated probability of quality 1; predicted is 1 from 0.5 on. Only labels of rows whose crc32(doc_id as text)
    mod 5 is not 0 are learned from. Nulls in text, lang or source are features of their own; a null doc_id has no label and
    is not held out; a doc_id labelled twice counts as the lower label. Without labels of both classes every score is 0.5.
    Repeated rows are scored alike, an empty table gives no rows, other columns are ignored.
    """
    rest = F.crc32(F.col("doc_id").cast("string")) % 5
    known = features(docs, labels.filter(rest != 0))
    scored = score_features(known, learn(known))
    return scored.select(
        "doc_id",
        F.coalesce(rest == 0, F.lit(False)).alias("held_out"),
        F.col("quality_score").alias("score"),
        (F.col("quality_score") >= 0.5).cast("int").alias("predicted"),
    )
