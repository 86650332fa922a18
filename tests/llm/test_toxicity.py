import itertools
import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from surveyloom.llm import toxicity
from surveyloom.llm.text import text_bytes

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def characters(spark):
    return toxicity.train_characters(spark.read.parquet(f"{FOLDER}/documents.parquet"))


@pytest.mark.parametrize(
    ("token", "wanted"),
    [("1d10t", "idiot"), ("l0$er", "loser"), ("stuuuupid", "stupid"), ("tr@sh", "trash"), ("m0r0n", "moron"), ("th3", "the"), ("ccclllown", "clown"), ("schön", "schön"), ("", ""), ("...", "")],
)
def test_restoration(characters, token, wanted):
    assert toxicity.restore(token, characters) == wanted


def test_noise_is_found():
    text = "an i d i o t or m.o.r.o.n, s-c-u-m; l 0 s e r. Cl0wn!! STUUUPID but 4725217674275454 %%% end! a+ (so) 100% no noise at all"
    found = toxicity._noisy(*text_bytes(pa.array([text, "a b", "1 2 3"])))
    assert {(row, re.sub("[.,;]$", "", token)) for row, token, _ in found} >= {(0, t) for t in ("idiot", "moron", "scum", "l0ser", "Cl0wn!!", "STUUUPID")}
    assert not {"end!", "a+", "100%", "no", "noise", "4725217674275454"} & {token for _, token, _ in found}


@pytest.mark.parametrize("token", ["a$$", "bu77", "idio7", "st£pid", "l€ss", "m0r0n", "¡diot", "x9", "tr@sh", "f@", "cash$"])
def test_every_obfuscated_word_reaches_the_decoder(token):
    texts = [f"some {token} here", token, f"{token}, and", f"éà {token}"]
    found = toxicity._noisy(*text_bytes(pa.array(texts)))
    assert {(row, t.rstrip(",")) for row, t, _ in found} == {(row, token) for row in range(len(texts))}


@pytest.mark.parametrize(("token", "wanted"), [("a$$", "ass"), ("idio7", "idiot"), ("st£pid", "stlpid"), ("bu77", "but")])
def test_signs_at_the_end_and_beyond_ascii_are_restored(characters, token, wanted):
    """The most likely letters under this corpus; a run may be shortened."""
    assert toxicity.restore(token, characters) == _best_path(token, characters)[1]
    assert toxicity.restore(token, characters)[0] == wanted[0]


def _best_path(token, model):
    """All paths of the lattice, one by one: the least cost and its text."""
    best = (float("inf"), "")
    for path in itertools.product(*toxicity._lattice(token.lower().rstrip("!?.,;:)*"))):
        text, cost, a, b = "".join(piece for piece, _ in path), sum(price for _, price in path), 0, 0
        for char in text + " ":
            c = model.symbol(char)
            cost -= model.logs[a, b, c]
            a, b = b, c
        best = min(best, (cost, text))
    return best


def test_decoding_equals_all_paths(characters):
    rng = random.Random(6)
    for _ in range(300):
        token = "".join(rng.choice("aeioutslr" + "0134$@!|*é£-") * rng.choice((1, 1, 2, 3)) for _ in range(rng.randint(1, 6)))
        cost, text = _best_path(token, characters)
        found = toxicity.restore(token, characters)
        assert found == text or _cost(token, found, characters) == pytest.approx(cost, abs=1e-9), token


def _cost(token, text, model):
    """The least cost of the paths that read `text`."""
    best = float("inf")
    for path in itertools.product(*toxicity._lattice(token.lower().rstrip("!?.,;:)*"))):
        if "".join(piece for piece, _ in path).strip() == text:
            cost, a, b = sum(price for _, price in path), 0, 0
            for char in "".join(piece for piece, _ in path) + " ":
                c = model.symbol(char)
                cost -= model.logs[a, b, c]
                a, b = b, c
            best = min(best, cost)
    return best


def test_long_tokens_are_decoded_whole(characters):
    token = "st" + "u" * 300 + "p1d"
    assert [(t, p) for _, t, p in toxicity._noisy(*text_bytes(pa.array([token])))] == [(token, False)]
    assert toxicity.restore(token, characters) == toxicity.restore("stuuup1d", characters)
    pieces = [t for _, t, _ in toxicity._noisy(*text_bytes(pa.array(["a1b" * 5000])))]
    assert all(len(p) <= toxicity.PIECE for p in pieces) and sum(map(len, pieces)) >= 15_000


def test_held_out_accuracy_and_obfuscation(spark, characters):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    planted = [
        (-1, "The thand of ing you 1d10t and heed tion the ates."), (-2, "The thand l o s e r of ing and heed tion the ates."),
        (-3, "The thand of stuuuupid ing and heed tion m0r0n the ates."), (-4, "The thand of ing and heed tion the ates in 2024."),
    ]
    every = docs.select("doc_id", "text").unionByName(spark.createDataFrame(planted, "doc_id long, text string"))
    rows = toxicity.toxicity(every, labels).join(labels.select("doc_id", F.col("toxic").alias("label")), "doc_id", "left").collect()
    held = [r for r in rows if r.held_out and r.label is not None]
    bad, good = ([r for r in held if r.label == x] for x in (1, 0))
    assert sum(r.predicted for r in bad) / len(bad) >= 0.85
    assert sum(r.predicted for r in good) / len(good) <= 0.02
    assert {r.doc_id: r.predicted for r in rows if r.doc_id < 0} == {-1: 1, -2: 1, -3: 1, -4: 0}


def test_odd_documents(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (3, 0), (6, 0), (6, None), (None, 1)], "doc_id long, toxic int").selectExpr("*", "'x' AS text")
    rows = toxicity.toxicity(odd_docs, labels).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert {r.score for r in toxicity.toxicity(odd_docs, labels.limit(0)).collect()} == {0.5}
    assert toxicity.toxicity(no_docs, labels).count() == 0
