import random
import re
import zlib
from collections import Counter, defaultdict
from functools import reduce

import numpy as np
import pytest

from surveyloom.llm import spelling


def _count(rows):
    """The contract's words, by plain Python."""
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run if h % 31 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    return {word: n for word, n in counts.items() if len(word) >= 7 and n >= 2}


def _near(a, b):
    """One code point inserted, deleted or replaced."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def _variants(words, factor=10):
    """All pairs, compared one by one within a length."""
    by_length = defaultdict(list)
    for word in words:
        by_length[len(word)].append(word)
    near = {w: [v for d in (-1, 0, 1) for v in by_length[len(w) + d] if _near(w, v)] for w in words}
    best = {w: min(near[w], key=lambda v: (-words[v], v)) for w in words if near[w]}
    form = {w: v for w, v in best.items() if words[v] >= factor * words[w]}
    root = lambda w: root(form[w]) if w in form else w
    return {(w, form.get(w), root(w), n, len(near[w]), words[form[w]] if w in form else None) for w, n in words.items()}


def _rows(frame):
    rows = frame.select("word", "form", "root", "n", "n_near", "form_n").collect()
    found = set(map(tuple, rows))
    assert len(found) == len(rows)
    return found


def _frame(spark, words):
    return spark.createDataFrame(list(words.items()), "word string, n long")


def _crowded(rng):
    """Many words with the same ends, chains of forms, accents, and one very long word."""
    words = {}
    for word in ("abcdefgh", "abcdefghijk", "straßenbahn", "élévation", "aaaaaaaaa", "abababababab"):
        for i in range(len(word)):
            for c in "abzéÿ":
                words[word[:i] + c + word[i + 1 :]] = rng.randint(2, 400)
                words[word[:i] + c + word[i:]] = rng.randint(2, 40)
            words[word[:i] + word[i + 1 :]] = 2
    words.update({"chainedword": 2, "chainedworda": 20, "chainedwordab": 200, "chainedwordabc": 2000, "chainedwordabcd": 20000})
    words.update({"x" * 30_000: 50, "x" * 29_999: 5, "x" * 15_000 + "y" + "x" * 14_999: 4})
    return {w: n for w, n in words.items() if len(w) >= 7}


def test_whole_documents_against_brute_force(docs):
    rows = docs.select("doc_id", "text").collect()
    words = _count(rows)
    assert _rows(spelling.document_variants(docs)) == _variants(words)
    assert any(form for _, form, *_ in _variants(words))


@pytest.mark.parametrize("longest", [2, 10_000])
def test_crowded_lists_and_chains(spark, monkeypatch, longest):
    monkeypatch.setattr(spelling, "LIST", longest)
    monkeypatch.setattr(spelling, "RARE", 3)
    words = _crowded(random.Random(5))
    found = _rows(spelling.variants(_frame(spark, words)))
    assert found == _variants(words)
    assert ("chainedword", "chainedworda", "chainedwordabcd", 2, 1, 20) in found


def test_ties_and_least_ratio(spark):
    words = {"wordsame": 2, "wordsamb": 20, "wordsama": 20, "wordsamz": 19, "otherone": 3, "otherona": 29}
    found = {row[0]: row for row in _rows(spelling.variants(_frame(spark, words)))}
    assert found["wordsame"] == ("wordsame", "wordsama", "wordsama", 2, 3, 20)
    assert found["otherone"] == ("otherone", None, "otherone", 3, 1, None)


def test_odd_documents(spark, odd_docs, no_docs):
    rows = odd_docs.select("doc_id", "text").collect()
    assert _rows(spelling.document_variants(odd_docs)) == _variants(_count(rows))
    assert spelling.document_variants(no_docs).count() == 0
    texts = [(1, "Straßenbahn ÉLÉVATION Élévation abcdefg×÷ abcdefg×÷"), (2, "straßenbahn Élévation x" + "y" * 50_000), (None, "NULLABLE nullable x" + "y" * 50_000)]
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    assert _rows(spelling.document_variants(frame)) == _variants(_count(texts))


def test_short_words_are_refused_by_the_bound(spark):
    # Two grams without a common place exist in every word that is long enough, whatever the dictionary says.
    for length in range(spelling.SHORTEST, 12):
        points = np.full((1, length), ord("a"), np.uint64)
        every = spelling.Dictionary(np.unique(np.concatenate([h.ravel() for h in spelling._gram_hashes(points)])), np.full(spelling.MOST - 1, 9))
        for known in (every, spelling.Dictionary(np.zeros(0, np.uint64), np.zeros(0, np.int64))):
            starts, ends = spelling.rarest(*spelling.decompose(points, known))
            assert np.flatnonzero(starts[0])[-1] >= np.flatnonzero(ends[0])[0]


def test_the_dictionary_is_bounded(spark, docs, monkeypatch):
    words = spelling.vocabulary(spelling.runs(docs).selectExpr("run AS word"))
    full = spelling.dictionary(words)
    monkeypatch.setattr(spelling, "DICTIONARY", 64)
    few = spelling.dictionary(words)
    assert 0 < len(few.grams) < 64 < len(full.grams)
    assert set(few.grams) <= set(full.grams)


def test_grams_are_read_while_they_are_frequent():
    points = np.array([[ord(c) for c in "abcdefg"]], np.uint64)
    hashes = spelling._gram_hashes(points)
    known = spelling.Dictionary(np.sort(np.array([hashes[0][0, 0], hashes[1][0, 0], hashes[0][0, 3]])), np.array([5, 5, 5]))
    size, _, _ = spelling.decompose(points, known)
    assert size.tolist() == [[4, 2, 2, 3, 2, 2]]


def test_no_gram_of_an_unaffected_place_is_lost():
    """The first gram an edit leaves alone is taken by both words, for random dictionaries."""
    rng = random.Random(11)
    alphabet = "ab"
    for _ in range(300):
        word = "".join(rng.choice(alphabet) for _ in range(rng.randint(7, 11)))
        at = rng.randrange(len(word))
        other = rng.choice([word[:at] + "c" + word[at + 1 :], word[:at] + word[at + 1 :], word[:at] + rng.choice("abc") + word[at:]])
        if len(other) < 7 or other == word:
            continue
        grams = np.unique(np.concatenate([h.ravel() for w in (word, other) for h in spelling._gram_hashes(np.array([[ord(c) for c in w]], np.uint64))]))
        kept = grams[np.array([rng.random() < 0.6 for _ in grams])]
        known = spelling.Dictionary(kept, np.array([rng.randint(1, 4) for _ in kept], np.int64))
        keys = []
        for w in (word, other):
            lists = spelling._list_keys(np.array([[ord(c) for c in w]], np.uint64), known)
            keys.append(reduce(set.union, (set(found.tolist()) for _, found, *_ in lists)))
        assert keys[0] & keys[1], (word, other)
