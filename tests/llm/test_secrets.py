import hashlib
import math
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from surveyloom.llm import secrets

ASSIGN = re.compile(r"""((?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)


def base_spans(text):
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def digest(spans):
    return hashlib.sha256(",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in spans).encode()).hexdigest()


PLANTED = [
    "token=token:abcdefgh", "Password : 'hunter22' passwd=abc secret=abcdef", "ä𝒳 api_key=ÄBC apikey='abcdef.-_/+=' é", "AKIA" + "A" * 15,
    "AKIAAKIA" + "B" * 16, "x" + "0123456789abcdef" * 2 + "g", "SECRET\"=\"abcdefg\"", "token token = = abcdef", "kEy api-key=abcdefg", None, "",
]


def test_base_spans_match_brute_force(spark, docs):
    planted = spark.createDataFrame(list(enumerate(PLANTED)), "doc_id long, text string")
    for frame in (planted, docs.select("doc_id", "text")):
        texts = dict(map(tuple, frame.collect()))
        rows = secrets.report(secrets.scan(frame)).collect()
        assert len(rows) == len(texts)
        for row in rows:
            spans = base_spans(texts[row.doc_id])
            counts = tuple(sum(k == kind for _, k, _ in spans) for kind in range(3))
            assert ((row.n_assign, row.n_access, row.n_hex), row.base_sha256) == (counts, digest(spans)), texts[row.doc_id]
            every = [s for s in row.spans.split(",") if s]
            assert [s for s in every if not s.startswith("entropy")] == [f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in spans]


@pytest.mark.parametrize("value", ["a" * 40, "abcdefghijklmnopqrst", "aB3dE6gH9jK2mN5pQ8sT1vW4yZ7", "ab" * 15 + "Zx9Q", "short"])
def test_window_entropy(spark, value):
    def entropy(part):
        return -sum(part.count(c) / len(part) * math.log2(part.count(c) / len(part)) for c in set(part))

    wanted = max([0.0, *(entropy(value[i : i + 20]) for i in range(len(value) - 19))])
    found = spark.createDataFrame([(value,)], "v string").select(secrets.best_window_entropy(F.col("v"))).first()[0]
    assert found == pytest.approx(wanted, abs=1e-9)


def test_entropy_spans_and_allow_list(spark):
    rows = [(1, "key Zx8Qp3LmN7vB2kRt9WyH5cDa end"), (2, "key example8Qp3LmN7vB2kRt9WyH5cDa"), (3, "internationalisationalities1and"), (4, "4725217674275454472521767427")]
    found = {r.doc_id: r.spans for r in secrets.report(secrets.scan(spark.createDataFrame(rows, "doc_id long, text string"))).collect()}
    assert found == {1: "entropy:4:28", 2: "", 3: "", 4: "hex:0:28"}


def test_redaction(spark, odd_docs, no_docs):
    rows = secrets.redact(odd_docs)
    assert rows.columns == [c for c in odd_docs.columns if c != "secret_spans"]
    found = [(r.text, r.n_chars) for r in rows.collect() if r.text and "SECRET" in r.text]
    assert found == [("[SECRET] and [SECRET] here", 26)]
    before, after = ({(r.doc_id, r.text, r.n_chars) for r in f.filter("doc_id IS NOT NULL").collect()} for f in (odd_docs, rows))
    assert before == after
    assert rows.count() == odd_docs.count() and secrets.redact(no_docs).count() == 0


def test_no_python_in_the_plan(docs):
    plan = secrets.report(secrets.scan(docs))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)


@pytest.mark.parametrize("size", [0, 1, 255, 256, 257, 1000])
def test_running_sums_and_maxima(spark, size):
    values = [random.Random(size + i).randint(0, 50) for i in range(size)]
    frame = spark.createDataFrame([(values,)], "v array<int>")
    row = frame.select(secrets.running(F.col("v"), lambda a, b: a + b), secrets.running(F.col("v"), lambda a, b: F.greatest(a, b))).first()
    assert row[0] == [sum(values[: i + 1]) for i in range(size)]
    assert row[1] == [max(values[: i + 1]) for i in range(size)]


def _redacted(text, spans):
    out, at = [], 0
    for start, end in sorted(spans):
        if start >= at:
            out += [text[at:start], "[SECRET]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def test_long_candidates_and_many_secrets_take_linear_time(spark):
    rng = random.Random(1)
    signs = "BCDFGHJKLMNPQRSTVWZbcdfghjkmnpqrstvwz23456789+"  # spells no word of the allow-list
    image = "".join(rng.choice(signs) for _ in range(1_000_000))
    many = " ".join(f"é token={rng.getrandbits(64):016x} {rng.getrandbits(128):032x}" for _ in range(50_000))
    frame = spark.createDataFrame([(1, f"data:{image}"), (2, many), (3, "AKIA" * 300_000)], "doc_id long, text string")
    start = time.perf_counter()
    rows = {r.doc_id: r for r in secrets.report(secrets.scan(frame)).collect()}
    clean = {r.doc_id: r.text for r in secrets.redact(frame).collect()}
    assert time.perf_counter() - start < 150
    assert rows[1].spans == f"entropy:5:{5 + len(image)}" and clean[1] == "data:[SECRET]"
    spans = base_spans(many)
    assert rows[2].n_assign == 50_000 and rows[2].base_sha256 == digest(spans)
    assert clean[2] == _redacted(many, [(a, b) for a, _, b in spans])
    assert rows[3].n_access == 1


def test_random_texts_with_overlapping_spans(spark):
    rng = random.Random(8)
    bits = ["token=", "AKIA", "ABCDEFGH1234", "0123456789abcdef", "deadbeef12", " ", "é", "𝒳", "\n", "xY7", "q9Zr-", "'"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(1, 400))) for _ in range(200)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in secrets.report(secrets.scan(frame)).collect()}
    clean = {r.doc_id: r.text for r in secrets.redact(frame).collect()}
    for i, text in enumerate(texts):
        assert rows[i].base_sha256 == digest(base_spans(text))
        spans = [tuple(map(int, s.split(":")[1:])) for s in rows[i].spans.split(",") if s]
        added = [s for s in rows[i].spans.split(",") if s.startswith("entropy")]
        for span in added:
            a, b = map(int, span.split(":")[1:])
            assert not any(x <= a and b <= y for x, _, y in base_spans(text))
        assert clean[i] == _redacted(text, spans)
