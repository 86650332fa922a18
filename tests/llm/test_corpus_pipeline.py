import pytest

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from surveyloom.llm import queries
from surveyloom.llm.storage import stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    out = [docs]
    for name, stage in pipeline.STAGES:
        docs = stored(stage(spark, docs, small), name)
        out.append(docs)
    return out


def test_stages_and_columns(steps):
    assert [n for n, _ in pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "secrets", "mixing"]
    assert all(s.columns == COLUMNS for s in steps[:-1])
    ids = [{r.doc_id for r in s.select("doc_id").collect()} for s in steps]
    assert all(after <= before for before, after in zip(ids, ids[1:])) and ids[3] == ids[4]


def test_quality_decisions_match_brute_force(spark, small, steps):
    """The first stage keeps what co-training in one place calls good."""
    import numpy as np

    from surveyloom.llm import quality

    batch, = steps[0].orderBy("doc_id").toArrow().combine_chunks().to_batches()
    content, page = (v.astype(np.float32).astype(float) for v in quality.views(batch))
    known = {r.doc_id: r.quality for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
    ids = batch.column("doc_id").to_pylist()
    score = quality.co_train(content, page, np.array([known.get(i, -1) for i in ids])).score(content, page)
    assert {r.doc_id for r in steps[1].collect()} == {i for i, s in zip(ids, score) if s >= 0.5}


def test_contaminated_rows_go_by_row(spark, small):
    """Rows without an id, and of rows with one id only the contaminated."""
    item = spark.read.parquet(f"{small}/benchmark.parquet").filter("size(split(text, ' ')) >= 13").first().text
    rows = [(None, item, "en", "a", 1), (7, item, "en", "a", 1), (7, "clean words of another text", "en", "a", 1), (None, "clean words", "en", "a", 1), (8, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = pipeline.drop_contaminated(spark, docs, small).collect()
    assert sorted((str(r.doc_id), r.text or "") for r in kept) == [("7", "clean words of another text"), ("8", ""), ("None", "clean words")]


def test_one_of_the_rows_that_share_an_id_stays_the_same_one(spark, small):
    rows = [(1, f"{w} some words that no other text here has at all {w}", w, "a", 1) for w in "bcade"] + [(2, "x y z", "en", "a", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for parts in (1, 4):
        kept = pipeline.drop_near_duplicates(spark, docs.repartition(parts), small).collect()
        assert sorted((r.doc_id, r.lang) for r in kept) == [(1, "a"), (2, "en")]


def test_decisions_match_brute_force(spark, small, steps):
    from test_decontaminate import brute as contaminated
    from test_neardup import brute as groups
    from test_secrets import base_spans

    texts = {r.doc_id: r.text for r in steps[1].collect()}
    assert {r.doc_id for r in steps[2].collect()} == {i for i, _, _, kept in groups(texts, 5, 80) if kept}
    items = spark.read.parquet(f"{small}/benchmark.parquet").collect()
    wanted = {r[0] for r in contaminated([(r.doc_id, r.text) for r in steps[2].collect()], items) if not r[-1]}
    assert {r.doc_id for r in steps[3].collect()} == wanted
    assert not any(base_spans(r.text) for r in steps[4].collect())
    assert all(r.n_chars == len(r.text) for r in steps[4].collect())
    taken = steps[5].collect()
    assert all(r.taken == r.copies * r.size == r.copies * len(r.text.split()) and r.copies in (1, 2) for r in taken)


@pytest.mark.parametrize("number", range(5))
def test_odd_documents(spark, small, odd_docs, no_docs, number):
    stage = pipeline.STAGES[number][1]
    base = odd_docs.select(*COLUMNS)
    kept = stored(stage(spark, base, small), "odd")
    assert number == 4 or kept.columns == COLUMNS
    assert {r.doc_id for r in kept.collect()} <= {r.doc_id for r in base.collect()}
    if number == 1:
        assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 0, 1, 3, 4, 5, 6, 7]
    assert stored(stage(spark, no_docs, small), "none").count() == 0


def test_every_operator_is_registered():
    assert [sum(n.startswith(f"op{k}_") for n in entry.queries()) for k in range(1, 14)] == [1] * 13
    assert "pipeline" in entry.queries() and set(queries.ORACLE) <= set(queries.QUERIES)
    assert pipeline.ORACLE_SQL is None and callable(pipeline.run)
