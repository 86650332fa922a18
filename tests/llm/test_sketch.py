import hashlib

import numpy as np
import pytest

from surveyloom.llm import sketch


def _check(frame, pairs):
    """pairs: (doc_id, text) in the order of the edit."""
    rows = frame.collect()
    assert len(rows) == len(pairs)
    wanted = []
    for i, (doc_id, text) in enumerate(pairs):
        text, after = text or "", pairs[(i + 1) % len(pairs)][1] or ""
        edited = text[: len(text) - len(text) // 2] + after[: len(text) // 2]
        # What the written fingerprints say, and nothing else.
        own, other, third = (sketch.read(sketch.written(s)) for s in sketch.sketches([text, edited, after]))
        wanted.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), sketch.written(own), sketch.written(other), sketch.containment(own, other), sketch.containment(own, third)))
    assert sorted(map(tuple, rows), key=str) == sorted(wanted, key=str)


@pytest.mark.parametrize("rows", [4096, 64, 7])
def test_every_row_meets_its_successor(docs, texts, monkeypatch, rows):
    monkeypatch.setattr(sketch, "LEAST_ROWS", rows)
    _check(sketch.edit_report(docs.repartition(5)), sorted(texts.items(), reverse=True))


def test_odd_documents(odd_docs, no_docs, spark):
    key = lambda r: (r[0] is None, -(r[0] or 0), r[1] is not None, r[1] or "")
    _check(sketch.edit_report(odd_docs), sorted(map(tuple, odd_docs.select("doc_id", "text").collect()), key=key))
    assert sketch.edit_report(no_docs).count() == 0
    _check(sketch.edit_report(spark.createDataFrame([(1, "a b c d e f g")], "doc_id long, text string")), [(1, "a b c d e f g")])
    assert sketch.fingerprints(odd_docs).count() == odd_docs.count()


def test_sketches_merge_and_estimate_containment():
    rng = np.random.default_rng(3)
    big, own = rng.integers(0, 2**64, 40_000, dtype=np.uint64), rng.integers(0, 2**64, 200, dtype=np.uint64)
    assert np.array_equal(sketch.merged(sketch.sketch(big), sketch.sketch(own)), sketch.sketch(np.concatenate([big, own])))
    part = sketch.sketch(np.concatenate([big[:1000], own]))
    assert sketch.containment(part, sketch.sketch(big)) == pytest.approx(1000 / 1200, abs=0.1)
    assert np.array_equal(sketch.read(sketch.written(part)), part)
    assert sketch.containment(part[:0], part[:0]) == 1.0 and sketch.containment(part, part[:0]) == 0.0


def test_the_fraction_is_kept():
    text = " ".join(f"w{i}" for i in range(20_000))
    assert len(sketch.sketches([text])[0]) == pytest.approx(20_000 / sketch.FRACTION, rel=0.1)
    assert len(sketch.sketches(["two words"])[0]) == 1 and len(sketch.sketches([" "])[0]) == 0


def _brute(a, b):
    sets = [{tuple(w[i : i + sketch.SIZE]) for i in range(max(1, len(w) - sketch.SIZE + 1))} for w in (a.split(), b.split())]
    return len(sets[0] & sets[1]) / min(map(len, sets))


def test_short_texts_against_brute_force(spark):
    long = " ".join(f"w{i}" for i in range(3000))
    pairs = [(" ".join(f"w{i}" for i in range(at, at + n)), long) for n in (2, 5, 6, 12, 40) for at in (3, 700, 2900)]
    pairs = [(a if len(a.split()) >= sketch.SIZE else "w0 w1 w2 w3 w4", b) for a, b in pairs]
    pairs += [("a b c d e f g h", "a b c d e f g x"), ("a b c d e f", "u v w x y z")]
    for a, b in pairs:
        own, other = sketch.sketches([a, b])
        assert sketch.containment(own, other) == sketch.containment(other, own)
        if long not in (a, b):
            assert sketch.containment(own, other) == _brute(a, b)
    # In the query the long texts are known by their fingerprints: short texts among themselves stay exact.
    short = [t for pair in pairs for t in pair if t != long]
    docs = spark.createDataFrame([(len(short) - i, t) for i, t in enumerate(short)], "doc_id long, text string")
    near = {r.doc_id: r.near_next for r in sketch.edit_report(docs).collect()}
    assert [near[len(short) - i] for i in range(len(short) - 1)] == [_brute(a, b) for a, b in zip(short, short[1:])]


def test_the_report_follows_from_its_fingerprints(docs):
    """near_edited and near_next can be computed from the columns that are returned; they are near the truth and in 0 to 1."""
    rows = sorted(sketch.edit_report(docs).collect(), key=lambda r: -r.doc_id)
    texts = {r.doc_id: r.text for r in docs.collect()}
    off = []
    for row, after in zip(rows, rows[1:]):
        own, edited, other = (sketch.read(f) for f in (row.fingerprint, row.edited_fingerprint, after.fingerprint))
        assert (row.near_edited, row.near_next) == (sketch.containment(own, edited), sketch.containment(own, other))
        assert 0 <= row.near_edited <= 1 and 0 <= row.near_next <= 1
        off.append(abs(row.near_edited - _brute(texts[row.doc_id], sketch.edited_text(texts[row.doc_id], texts[after.doc_id]))))
    assert np.mean(off) < 0.05
    same = {}
    for row in rows:
        assert same.setdefault(texts[row.doc_id], row.fingerprint) == row.fingerprint


def test_stored_sketches_compare_below_both_limits():
    long = " ".join(f"w{i}" for i in range(3000))
    read = lambda text: sketch.read(sketch.written(sketch.sketches([text])[0]))
    big = read(long)
    guesses = [sketch.containment(read(" ".join(f"w{i}" for i in range(at, at + 12))), big) for at in range(0, 2900, 50)]
    # A short text lies in the long one: so it is said wherever one of its hashes is known of both.
    assert set(guesses) <= {0.0, 1.0} and sum(guesses) > len(guesses) / 3
    assert sketch.containment(read("a b c d e f g h"), read("a b c d e f g x")) == 0.75
    # Parts that overlap by SIZE - 1 words merge to the whole.
    union = read(" ".join(f"w{i}" for i in range(50)))
    for at in range(46, 500, 46):
        union = sketch.merged(union, read(" ".join(f"w{i}" for i in range(at, at + 50))))
    assert np.array_equal(union, read(" ".join(f"w{i}" for i in range(at + 50))))
