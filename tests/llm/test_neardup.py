import random
import re

import numpy as np
import pytest

from surveyloom.llm import neardup
from surveyloom.llm.components import components

LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def _set(text, size):
    found = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    return {tuple(found[i : i + size]) for i in range(max(1, len(found) - size + 1))} if found else set()


def brute(texts, size, percent):
    sets = {i: _set(t, size) for i, t in texts.items()}
    root = {i: i for i in texts}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(texts)
    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((top(i), top(j)))
                root[y] = x
    return {(i, len(sets[i]), top(i), top(i) == i) for i in ids}


@pytest.mark.parametrize("size", [2, 5])
def test_matches_all_pairs(docs, texts, size):
    assert {tuple(r) for r in neardup.near_duplicates(docs, size, 80).collect()} == brute(texts, size, 80)


def test_families_with_chains_and_strays(spark):
    """Variants of one text around the threshold, and chains in which only neighbours are similar."""
    rng = random.Random(4)
    texts = {}
    for family in range(6):
        base = [f"f{family}w{i}" for i in range(120)]
        for _ in range(25):
            own = list(base)
            for at in rng.sample(range(120), rng.randrange(0, 12)):
                own[at] = f"v{rng.randrange(10**6)}"
            texts[len(texts)] = " ".join(own)
        for step in range(12):
            texts[len(texts)] = " ".join(base[step * 8 :] + [f"c{family}x{i}" for i in range(step * 8)])
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {tuple(r) for r in neardup.near_duplicates(frame, 2, 80).collect()} == brute(texts, 2, 80)


def test_odd_documents(odd_docs, no_docs):
    rows = sorted(map(tuple, neardup.near_duplicates(odd_docs, 2, 80).collect()), key=str)
    assert [r for r in rows if r[0] in (1, 2)] == [(1, 13, 1, True), (1, 13, 1, True), (2, 13, 1, False)]
    assert [r for r in rows if r[0] in (3, 4, 5)] == [(3, 0, 3, True), (4, 0, 4, True), (5, 0, 5, True)]
    assert [r[2:] for r in rows if r[0] is None] == [(None, True)] * 2
    assert neardup.near_duplicates(no_docs).count() == 0


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1100)] + [(5, 5), (None, 3)]
    root = {}

    def top(i):
        while root.setdefault(i, i) != i:
            i = root[i]
        return i

    for a, b in links:
        if a is not None and a != b:
            x, y = sorted((top(a), top(b)))
            root[y] = x
    found = components(spark.createDataFrame(links, "u long, v long"))
    assert dict(map(tuple, found.collect())) == {i: top(i) for i in root}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_ids_with_several_texts_tie_their_classes(spark):
    """A repeated id has the links of all its texts, its empty ones and copies of them under other ids included."""
    a, b, c = (" ".join(f"{k}{i}" for i in range(30)) for k in "abc")
    rows = [(9, a), (9, b), (9, ""), (4, a), (7, b), (3, c), (9, a), (None, a), (8, None), (6, b + " b30"), (5, " ")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted((r.doc_id or -1, r.n_shingles, r.component_id or -1, r.kept) for r in neardup.near_duplicates(frame, 2, 80).collect())
    assert found == [
        (-1, 29, -1, True), (3, 29, 3, True), (4, 29, 4, True), (5, 0, 5, True), (6, 30, 4, False), (7, 29, 4, False), (8, 0, 8, True),
        (9, 0, 4, False), (9, 29, 4, False), (9, 29, 4, False), (9, 29, 4, False),
    ]


def _family(rng, count, words, changed, name="t"):
    base = [f"{name}{i}" for i in range(words)]
    out = []
    for _ in range(count):
        own = list(base)
        for at in rng.sample(range(words), rng.choice(changed)):
            own[at] = f"{name}v{rng.randrange(10**9)}"
        out.append(" ".join(own))
    return out


@pytest.mark.parametrize("size", [1, 2, 5])
def test_strays_by_their_rarest_shingles(spark, monkeypatch, size):
    """Every bucket with a stray takes the way of crowded ones: families around the threshold, chains, sets of few shingles."""
    monkeypatch.setattr(neardup, "WIDE", 0)
    rng = random.Random(size)
    found = [t for f in range(5) for t in _family(rng, 30, 60, range(14), f"f{f}")]
    found += [" ".join(f"c{i}" for i in range(at, at + 50)) for at in range(0, 60, 3)]
    found += [" ".join(f"s{rng.randrange(6)}" for _ in range(rng.randrange(1, 9))) for _ in range(60)]
    texts = dict(enumerate(found))
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {tuple(r) for r in neardup.near_duplicates(frame, size, 80).collect()} == brute(texts, size, 80)


def test_documents_beyond_the_filter_are_joined(spark, monkeypatch):
    monkeypatch.setattr(neardup, "FILTER_IDS", 0)
    texts = dict(enumerate(_family(random.Random(3), 60, 80, range(12))))
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {tuple(r) for r in neardup.near_duplicates(frame, 2, 80).collect()} == brute(texts, 2, 80)


def test_similar_sets_share_a_rarest_shingle():
    """Whatever the counts: sets at the threshold or above have a rarest shingle in common under the same classes."""
    rng = np.random.default_rng(5)
    bounds = neardup.size_bounds()
    counts = rng.integers(0, 4, 1 << neardup.COUNT_BITS)
    met = 0
    for _ in range(400):
        n = int(rng.integers(1, 200))
        base = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        kept = base[rng.random(len(base)) > rng.choice([0, 0.05, 0.1, 0.15])]
        other = np.unique(np.concatenate([kept, rng.integers(0, 2**64, int(rng.integers(0, 1 + n // 8)), dtype=np.uint64)]))
        common, union = len(np.intersect1d(base, other)), len(np.union1d(base, other))
        if not len(other) or 100 * common < 80 * union:
            continue
        met += 1
        keys = [{(own, met, int(v)) for own, met, part in neardup.rarest(x, counts, bounds, 80) for v in part} for x in (base, other)]
        assert keys[0] & {(met, own, v) for own, met, v in keys[1]}
    assert met > 100
    assert not list(neardup.rarest(np.zeros(0, np.uint64), counts, bounds, 80))


def test_one_template_is_not_all_pairs(spark):
    """Texts of one template that are not similar: they share buckets, but only few pairs of them are made."""
    count = 1500
    texts = dict(enumerate(_family(random.Random(6), count, 100, [9], "t")))
    frame = spark.createDataFrame([(i, t, i, True) for i, t in texts.items()], "doc_id long, text string, component long, stray boolean")
    crowd = frame.select("doc_id", "component", "stray")
    assert neardup._rare_pairs(crowd, frame, 2, 80).count() < count
    assert all(r.kept for r in neardup.near_duplicates(frame, 2, 80).collect())
