import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from surveyloom.llm import quality


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.quality(docs, labels).join(labels.select("doc_id", F.col("quality").alias("label")), "doc_id").filter("held_out").collect()
    good, bad = ([r for r in rows if r.label == x] for x in (1, 0))
    assert sum(r.predicted for r in good) / len(good) >= 0.98
    assert sum(1 - r.predicted for r in bad) / len(bad) >= 0.8


def test_views_teach_each_other():
    """Few labels, a content view that is clear and a page view that is noisy: the pool helps the page view."""
    rng = np.random.default_rng(5)
    truth = rng.integers(0, 2, 4000)
    content = rng.normal(size=(4000, quality.CONTENT_FEATURES))
    content[:, 0] += 6 * truth
    page = rng.normal(size=(4000, quality.PAGE_FEATURES))
    page[:, :3] += truth[:, None]
    label = np.where(np.arange(4000) < 40, truth, -1)
    model = quality.co_train(content, page, label)
    seen = np.setdiff1d(np.arange(40), np.arange(40)[3::4])
    alone = quality.fit(page[seen], truth[seen].astype(float))
    rest = slice(40, None)
    right = lambda m: ((m.margin(page[rest]) > 0) == truth[rest]).mean()
    assert right(model.page) > right(alone)
    assert ((model.score(content[rest], page[rest]) >= 0.5) == truth[rest]).mean() > 0.97


def test_odd_documents(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (3, 0), (4, 0), (6, 1), (6, None), (None, 1), (99, 0)], "doc_id long, quality int").selectExpr("*", "'x' AS text")
    rows = quality.quality(odd_docs, labels).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert {r.score for r in quality.quality(odd_docs, labels.limit(0)).collect()} == {0.5}
    assert quality.quality(no_docs, labels).count() == 0
    scored = quality.score(odd_docs, quality.train(odd_docs, labels))
    assert scored.columns == [c for c in odd_docs.columns if c != "quality_score"] + ["quality_score"]


def test_every_unlabelled_document_is_seen(spark, docs):
    """Passes over many partitions see all unlabelled rows of a corpus beyond any fixed pool, and add up to one pass at hand."""
    seen = []
    learned = quality._learned

    def watched(content, page, label, sums):
        seen.append((len(label), sums(lambda c, p: np.array([float(len(c)), c.sum(), p.sum()]))))
        return learned(content, page, label, sums)

    many = docs.crossJoin(spark.range(60)).select((F.col("doc_id") * 60 + F.col("id")).alias("doc_id"), F.substring("text", 1, 60).alias("text"), "lang", "source")
    labels = many.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality")).filter("doc_id % 97 = 0")
    quality._learned = watched
    try:
        quality.train(many.repartition(7), labels)
    finally:
        quality._learned = learned
    (known, (rows, _, _)), = seen
    assert known == labels.count() and known + rows == many.count() > 10_000


def test_one_pass_equals_many():
    rng = np.random.default_rng(8)
    truth = rng.integers(0, 2, 3000)
    content, page = rng.normal(size=(3000, quality.CONTENT_FEATURES)), rng.normal(size=(3000, quality.PAGE_FEATURES))
    content[:, 0] += 5 * truth
    page[:, 0] += 4 * truth
    label = np.where(np.arange(3000) < 60, truth, -1)
    whole = quality.co_train(content, page, label)
    parts = lambda step: sum(step(content[i : i + 700], page[i : i + 700]) for i in range(60, 3000, 700))
    dealt = quality._learned(content[:60], page[:60], label[:60], parts)
    assert all(np.allclose(a.weights, b.weights) for a, b in zip(whole, dealt))


@pytest.fixture(scope="module")
def at_hand(spark, small):
    """Features, labels and ids of all documents in one place, in the order of the operator."""
    docs, labels = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "labels"))
    known = {r.doc_id: r.quality for r in labels.collect()}
    table = docs.orderBy("doc_id").toArrow().combine_chunks()
    batch, = table.to_batches()
    content, page = (v.astype(np.float32).astype(float) for v in quality.views(batch))
    return docs, labels, batch.column("doc_id").to_pylist(), content, page, known


def test_the_operator_equals_co_training_in_one_place(at_hand):
    """Brute force: the same rounds in memory, without Spark, give every document's score."""
    import zlib

    docs, labels, ids, content, page, known = at_hand
    label = np.array([known.get(i, -1) if zlib.crc32(str(i).encode()) % 5 else -1 for i in ids])
    model = quality.co_train(content, page, label)
    wanted = dict(zip(ids, model.score(content, page)))
    rows = quality.quality(docs.repartition(5), labels).collect()
    assert len(rows) == len(wanted)
    assert all(abs(r.score - wanted[r.doc_id]) < 1e-6 and r.predicted == (r.score >= 0.5) for r in rows)


def test_views_share_no_column():
    """No column of one view follows from one of the other, over texts of random words, signs and lines."""
    rng = np.random.default_rng(3)
    bits = ["word", "Word", "WORDS", "a", "é", "12", "7", "|", "#", "!", ",", ".", "\n", "\t", "--", "the", "the"]
    texts = [rng.choice([" ", "\n", ""]).join(rng.choice(bits, rng.integers(1, 200), p=rng.dirichlet(np.full(len(bits), 0.3)))) for _ in range(500)]
    batch = pa.RecordBatch.from_pydict({"text": texts + ["", " "], "lang": [None] * 502, "source": [None] * 502})
    content, page = quality.views(batch)
    assert all(column.std() for column in (*content.T, *page[:, : quality.LAYOUT_FEATURES].T))
    for a in content.T:
        for b in page[:, : quality.LAYOUT_FEATURES].T:
            assert abs(np.corrcoef(a, b)[0, 1]) < 0.97


def test_many_rows_of_sums_become_one(spark, monkeypatch):
    monkeypatch.setattr(quality, "ADDED", 3)
    rows = [(np.full(quality.CONTENT_FEATURES, i, np.float32).tobytes(), np.full(quality.PAGE_FEATURES, 1, np.float32).tobytes()) for i in range(40)]
    pool = spark.createDataFrame(rows, "content binary, page binary").repartition(17)
    sums = quality._pool_sums(pool)
    wanted = [sum(range(40)) * quality.CONTENT_FEATURES, 40.0 * quality.PAGE_FEATURES]
    assert sums(lambda c, p: np.array([c.sum(), p.sum()])).tolist() == wanted
    assert quality._pool_sums(pool.limit(0))(lambda c, p: np.array([c.sum(), p.sum()])).tolist() == [0.0, 0.0]
