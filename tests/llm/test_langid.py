import re
import time

import numpy as np
import pyarrow as pa
import pytest

from surveyloom.llm import langid

PIECES = [b" ", b" a", b"ab", b"b", b"abc", b"c", b" ab", b"bc", "éb".encode(), b" abcabcabcabcabcabcabcabca", "日本".encode()] + [bytes([b]) for b in range(256)]


def _model(seed, floor=0.0):
    """A vocabulary of some pieces and all bytes, with random weights for two languages."""
    hashes = np.unique(np.array([langid._piece_hash(p) for p in PIECES], np.uint64))
    weights = np.random.default_rng(seed).random((len(hashes), 2)) / 4 * 10.0 ** -floor
    return langid.Model(["aa", "bb"], langid._vocabulary(hashes, max(map(len, PIECES))), weights)


@pytest.fixture(scope="module", params=[0, 15])
def tiny(request):
    return _model(2, request.param)


def _weight(piece, model, language):
    return model.weights[model.vocabulary.find(np.array([langid._piece_hash(piece)], np.uint64))[0], language]


def _log_sum(word, model, language):
    """All segmentations by all pieces, prefix by prefix in exact integers of the weights' fractions."""
    from fractions import Fraction

    sums = [Fraction(1)]
    for end in range(1, len(word) + 1):
        sums.append(sum((sums[end - len(p)] * Fraction(_weight(p, model, language)) for p in set(PIECES) if word[:end].endswith(p)), Fraction(0)))
    number = sums[-1]
    return np.log(2.0) * (number.numerator.bit_length() - number.denominator.bit_length()) + float(
        np.log(float(number / Fraction(2) ** (number.numerator.bit_length() - number.denominator.bit_length())))
    )


TEXTS = ["abc", "abcabc ab", "c a éb", "a-b,abc", "", "12 3", "abcabcabcabcabcabcabcabcabc x", "─" * 20, "😂" * 12 + " abc", "日本日本語" * 8, "ab" * 60, "—" * 20]


@pytest.mark.parametrize("text", TEXTS)
def test_forward_sums_all_segmentations(tiny, text):
    found = langid.log_likelihoods(pa.array([text, text], pa.string()), tiny)
    parts = [w.encode() for w in re.findall(r"[A-Za-z\u0080-\U0010ffff]+", text)]
    wanted = [sum(_log_sum(b" " + w, tiny, k) for w in parts) for k in range(2)]
    assert found == pytest.approx(np.array([wanted, wanted]), rel=1e-9, abs=1e-9)


@pytest.mark.parametrize("block", [7, 64])
def test_blocks_of_long_words_hang_together(monkeypatch, block):
    model, word = _model(3), b" " + b"abcabcabcabcabcabcabcabcabcc" * 9
    whole = langid._log_of_long(np.frombuffer(word, np.uint8), model)
    monkeypatch.setattr(langid, "BLOCK", block)
    assert langid._log_of_long(np.frombuffer(word, np.uint8), model) == pytest.approx(whole, rel=1e-12)
    assert whole == pytest.approx([_log_sum(word, model, k) for k in range(2)], rel=1e-9)


def _expected_uses(word, model, language):
    """Expected uses of each piece, over all segmentations one by one."""
    uses, total = {}, 0.0

    def walk(at, used, weight):
        nonlocal total
        if at == len(word):
            total += weight
            for piece in used:
                uses[piece] = uses.get(piece, 0.0) + weight
            return
        for piece in set(PIECES):
            if word.startswith(piece, at):
                walk(at + len(piece), [*used, piece], weight * _weight(piece, model, language))

    walk(0, [], 1.0)
    return {piece: n / total for piece, n in uses.items()}


@pytest.mark.parametrize("floor", [0, 60])
def test_expected_uses_with_and_without_logarithms(floor):
    model, words = _model(5, floor), [b" abcab", b" cab", b" " + "éb日本".encode()]
    runs, length = langid._padded(np.frombuffer(b"".join(w[1:] for w in words), np.uint8), np.cumsum([0, *(len(w) - 1 for w in words[:-1])]), np.cumsum([len(w) - 1 for w in words]))
    total = np.zeros((model.vocabulary.size, 2))
    langid._Expected(model.vocabulary, model.weights)(runs, length, np.array([[1.0, 2.0], [3.0, 0.0], [1.0, 1.0]]), total)
    wanted = np.zeros_like(total)
    for word, times in zip(words, [(1, 2), (3, 0), (1, 1)]):
        for language in range(2):
            for piece, n in _expected_uses(word, model, language).items():
                slot = model.vocabulary.find(np.array([langid._piece_hash(piece)], np.uint64))[0]
                wanted[slot, language] += n * times[language]
    assert total == pytest.approx(wanted, rel=1e-9, abs=1e-12)


def test_a_very_long_word_is_scored_whole_and_in_time():
    model = _model(2)
    start = time.perf_counter()
    logs = langid.log_likelihoods(pa.array(["abc" * 100_000, "abc"], pa.string()), model)
    assert np.isfinite(logs).all() and logs[0].max() < -100_000 < logs[1].min() < 0
    assert time.perf_counter() - start < 60


def test_all_pieces_of_letters_are_read():
    import public_tokenizers

    vocabulary = langid.load_vocabulary(public_tokenizers.path(langid.VOCABULARY))
    assert vocabulary.longest > 20
    for piece in (" government", " University", " b"):
        assert vocabulary.find(np.array([langid._piece_hash(piece.encode())], np.uint64))[0] >= 0


ODD_SIGNS = ["😂" * 20, "─" * 16, "—" * 20, "日本語のテキストを書く" * 30, "x" * 500, "ಠ" * 200]


def test_odd_signs_change_no_other_prediction(spark, docs):
    """Documents of emoji, box signs and text without spaces, learned from as English, leave all else as it was."""
    before = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(docs).collect()}
    odd = spark.createDataFrame([(10_000_000 + i, text, "en", "a", len(text)) for i, text in enumerate(ODD_SIGNS * 5)], docs.schema)
    after = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(docs.unionByName(odd)).collect()}
    assert all(0 <= score <= 1 for _, score in after.values())
    assert {d: after[d][0] for d in before} == {d: lang for d, (lang, _) in before.items()}


def test_weights_stay_finite(spark, docs):
    odd = spark.createDataFrame([(i, text, lang) for i, (text, lang) in enumerate(zip(ODD_SIGNS, "abcabc"))], "doc_id long, text string, lang string")
    model = langid.train(docs.select("doc_id", "text", "lang").unionByName(odd))
    assert np.isfinite(model.weights).all() and (model.weights > 0).all()
    assert model.weights.sum(axis=0) == pytest.approx(np.ones(len(model.languages)))


def test_held_out_accuracy(docs):
    rows = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == docs.count() and held
    assert sum(r.lang_pred == r.lang for r in held) / len(held) >= 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_odd_documents(odd_docs, no_docs):
    rows = langid.identify(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    kinds = {r.doc_id: (r.lang_pred, r.score) for r in rows if r.doc_id}
    assert all(kinds[i] == ("und", 0.0) for i in (3, 4, 5, 7)) and kinds[1][0] == "en"
    assert langid.identify(no_docs).count() == 0
    assert {r.lang_pred for r in langid.identify(odd_docs.withColumn("lang", odd_docs["lang"].substr(9, 9)).filter("false")).collect()} == set()
