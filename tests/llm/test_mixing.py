from surveyloom.llm import mixing, queries


def test_matches_sql(spark, small, database, same_rows):
    same_rows(queries.op3_mix_sources(spark, small), database.sql(queries.ORACLE["op3_mix_sources"]))


def test_reruns_agree_and_targets_are_met(spark, docs):
    first, second = (sorted(map(tuple, mixing.mix(docs).collect()), key=str) for _ in range(2))
    assert first == second
    found = mixing.mix(docs)
    largest = found.groupBy("source").agg({"taken": "sum", "size": "max", "target": "max"}).collect()
    assert all(abs(r["sum(taken)"] - r["max(target)"]) <= r["max(size)"] for r in largest)
    assert found.filter("taken > 2 * size").count() == 0


def test_clamped_sources_give_their_excess_away(spark):
    rows = [(i, "w " * 10, "a") for i in range(10)] + [(100 + i, "w " * 10, "b") for i in range(90)]
    plan = mixing.plan(mixing.sizes(spark.createDataFrame(rows, "doc_id long, text string, source string")))
    targets = {r.source: r.target for r in plan.collect()}
    assert targets == {"a": 200.0, "b": 1300.0}


def test_odd_documents(odd_docs, no_docs):
    rows = mixing.mix(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert sum(r.size for r in rows) == sum(len((r.text or "").split()) for r in odd_docs.collect())
    assert {r.source_size for r in rows if r.source == "b"} == {0} and {r.taken for r in rows if r.source == "b"} == {0}
    assert mixing.mix(no_docs).count() == 0
