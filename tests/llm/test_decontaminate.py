import hashlib
import re

import pytest

from surveyloom.llm import decontaminate

LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def _words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))


def brute(docs, items):
    windows = [(str(i), tuple(w[k : k + min(13, len(w))])) for i, t in items if (w := _words(t)) for k in range(len(w) - min(13, len(w)) + 1)]
    out = []
    for doc_id, text in docs:
        own, hit, names = _words(text), set(), set()
        places = {}
        for k, word in enumerate(own):
            places.setdefault(word, []).append(k)
        for name, window in windows:
            for k in places.get(window[0], ()):
                if tuple(own[k : k + len(window)]) == window:
                    hit.update(range(k, k + len(window)))
                    names.add(name)
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out.append((doc_id, len(own), len(hit), len(names), digest, bool(hit) and 20 * len(hit) >= len(own)))
    return sorted(out, key=str)


def _found(docs, items):
    return sorted(map(tuple, decontaminate.report(decontaminate.matches(docs, items)).collect()), key=str)


def test_matches_brute_force(spark, small, docs):
    items = spark.read.parquet(f"{small}/benchmark.parquet")
    wanted = brute(docs.select("doc_id", "text").collect(), items.collect())
    assert any(r[2] for r in wanted)
    assert _found(docs, items) == wanted


@pytest.mark.parametrize("block", [1, 4 << 20])
def test_planted_passages(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    monkeypatch.setattr(decontaminate, "SHARD_BYTES", 400)
    long = " ".join(f"q{i}" for i in range(30))
    items = [(10, long), (9, "Short, item!"), (100, "the the the"), (7, None), (8, "..."), (10, "q0 same id")]
    docs = [
        (1, f"before {long} after"), (2, " ".join(f"q{i}" for i in range(12))), (3, "x " * 300 + "SHORT item"), (4, "short"), (5, "item the the"),
        (6, "the the the the the"), (7, None), (8, ""), (9, " ".join(f"q{i}" for i in range(5, 19)) + " q20"), (None, "short item"), (1, "short-item"),
    ]
    docs += [(20 + i, "q0 q1 q2 q3 q4 q5 q6") for i in range(3)] + [(30 + i, "q7 q8 q9 q10 q11 q12 q13 q14") for i in range(3)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    assert _found(frame, spark.createDataFrame(items, "item_id long, text string").coalesce(1)) == brute(docs, items)


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "alpha x x beta"), (2, "beta alpha"), (3, "alpha " + "x " * 9 + "beta"), (4, "alpha"), (5, "beta")], "doc_id long, text string").coalesce(1)
    items = spark.createDataFrame([(1, "alpha beta")], "item_id long, text string")
    found = decontaminate.matches(docs, items, lambda shard, block: decontaminate.near(shard, block, 4))
    assert {r.doc_id for r in found.filter("n_items > 0").collect()} == {1, 2}


def test_odd_documents(spark, odd_docs, no_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert {tuple(r)[2:4] for r in _found_rows(odd_docs, none)} == {(0, 0)}
    items = spark.createDataFrame([(None, "quick brown fox"), (3, "w5 x5")], "item_id long, text string").selectExpr("*", "1 AS terms")
    rows = _found_rows(odd_docs, items)
    assert len(rows) == odd_docs.count()
    assert sorted((r.doc_id, r.n_hit, r.items[0]) for r in rows if r.n_hit) == [(1, 3, ""), (1, 3, ""), (2, 3, ""), (6, 2, "3")]
    assert _found_rows(no_docs, items) == []


def _found_rows(docs, items):
    return decontaminate.matches(docs, items).collect()
