import glob
import random
import zlib

import numpy as np
import pytest
from pyarrow import orc
from pyspark.sql import functions as F

from surveyloom.llm import token_files


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(token_files.vocabulary_path())


def _wanted(tokenizer, pairs):
    """(doc_id, start, n_tokens, crc32) of (doc_id, text) in order, each text encoded in one piece."""
    rows, at = [], 0
    for doc_id, text in pairs:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, token_files.END]
        rows.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return rows


def _rows(frame):
    return sorted(map(tuple, frame.collect()), key=lambda r: r[1])


def test_whole_documents_against_the_library(docs, texts, tokenizer):
    assert _rows(token_files.round_trip(docs.repartition(3))) == _wanted(tokenizer, sorted(texts.items()))


def test_odd_documents(odd_docs, no_docs, tokenizer):
    found = _rows(token_files.round_trip(odd_docs))
    rows = [tuple(r) for r in odd_docs.select("doc_id", "text").collect()]
    key = lambda r: (r[0] is None, r[0] or 0)
    assert [r[0] for r in found] == [r[0] for r in sorted(rows, key=key)]
    known = [r for r in rows if r[0] is not None]
    assert found[: len(known)] == _wanted(tokenizer, sorted(known, key=key))
    assert sorted(r[3] for r in found) == sorted(r[3] for r in _wanted(tokenizer, rows))
    assert [r[1] for r in found] == np.cumsum([0, *(r[2] for r in found)])[:-1].tolist()
    assert token_files.round_trip(no_docs).count() == 0


def test_texts_in_which_words_are_hard_to_part(spark, tokenizer):
    texts = [
        "a b c　d\x1ce\x85f",
        "don't I'LL we've o'clock 's",
        "é ́a Å ǅ İi ΣΑΣ ΣΑΣ. ß",
        "<|endoftext|> <|startoftext|>x <|endof text|> a<|endoftext|>b",
        "İ‍👩‍👧 12 345\t\n\x0b\x0c\r 6.7",
        "w" * 3000 + " " + "9" * 500,
        "한국어 텍스트 日本語のテキスト ไทย",
        "﻿x ퟿ \U0010ffff",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert _rows(token_files.round_trip(docs)) == _wanted(tokenizer, list(enumerate(texts)))


def test_forgetting_words_changes_nothing(spark, docs, texts, tokenizer, monkeypatch):
    monkeypatch.setattr(token_files, "KEPT_PARTS", 50)
    monkeypatch.setattr(token_files, "GROUP_BYTES", 3000)
    assert _rows(token_files.round_trip(docs)) == _wanted(tokenizer, sorted(texts.items()))


def test_vocabularies_that_look_across_white_space(spark, docs, texts, tmp_path):
    from tokenizers import Tokenizer

    path = token_files.vocabulary_path("byte_bpe_50k.json")
    token_files.write_tokens(docs, f"{tmp_path}/whole", path, whole=True)
    found = _rows(token_files.digests(token_files.read_tokens(spark, f"{tmp_path}/whole")))
    assert found == _wanted(Tokenizer.from_file(path), sorted(texts.items()))


@pytest.fixture(scope="module")
def written(spark, docs, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tokens"))
    many = docs.select((F.col("doc_id") * 3).alias("doc_id"), F.substring("text", 1, 40).alias("text"))
    many = many.crossJoin(spark.range(60).withColumnRenamed("id", "k")).select((F.col("doc_id") * 100 + F.col("k")).alias("doc_id"), "text")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    token_files.write_tokens(many, path)
    spark.conf.set("spark.sql.shuffle.partitions", before)
    return path


def test_files_follow_each_other(spark, written):
    sums = token_files.files(spark, written).orderBy("file").collect()
    assert len(sums) == 2
    for one, two in zip(sums, sums[1:]):
        assert one.most < two.least and two.start == one.start + one.tokens
    assert sum(s.documents for s in sums) == spark.read.orc(f"{written}/rows").count() == 200 * 60


def test_a_span_of_ids_is_what_the_documents_hold(spark, written):
    rows = token_files.read_tokens(spark, written).orderBy("start").collect()
    ids = [i for row in rows for i in row.ids]
    middle = token_files.files(spark, written).filter("file = 1").first().start
    for low, high in ((0, 7), (middle - 5, middle + 5), (len(ids) - 3, len(ids) + 3), (5, 5)):
        found = token_files.read_span(spark, written, low, high).orderBy("place").collect()
        assert [r.id for r in found] == ids[low:high] and [r.place for r in found] == list(range(low, min(high, len(ids)))) [: len(found)]


def _scanned(frame):
    """Rows that leave the scan."""
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan()
    text, todo, total = "", [plan], 0
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
            continue
        if "FileSourceScan" in name:
            total += node.metrics().apply("numOutputRows").value()
            text += node.toString()
        todo.extend(node.children().apply(i) for i in range(node.children().size()))
    return total, text


def test_metadata_leaves_out_rows(spark, written):
    rows = spark.read.orc(f"{written}/rows")
    ids = [r.doc_id for r in rows.select("doc_id").orderBy("doc_id").collect()]
    everything, _ = _scanned(rows.select("doc_id", "n_tokens"))
    one, plan = _scanned(rows.select("doc_id", "n_tokens").filter(F.col("doc_id") == ids[5000]))
    assert everything == len(ids) and "PushedFilters: [IsNotNull(doc_id), EqualTo" in plan
    # The row index alone leaves one group of rows.
    assert 0 < one <= token_files.INDEX_ROWS
    # An id between two others lies within a group's range; only the Bloom filter can tell that it is not there.
    gap = ids[5000] + 70
    assert gap not in set(ids)
    assert _scanned(rows.select("doc_id").filter(F.col("doc_id") == gap))[0] == 0


def test_files_have_stripes_that_tasks_can_share(spark, tmp_path, monkeypatch):
    """Many documents in one file: several stripes, which several tasks read without one losing its place."""
    monkeypatch.setattr(token_files, "STRIPE_BYTES", 1 << 16)
    rng = np.random.default_rng(2)
    texts = [" ".join(f"w{i}" for i in rng.integers(0, 5000, 60)) for _ in range(12_000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    settings = {"spark.sql.shuffle.partitions": "1", "spark.sql.files.maxPartitionBytes": str(1 << 18)}
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        token_files.write_tokens(docs, f"{tmp_path}/t")
        (file,) = glob.glob(f"{tmp_path}/t/rows/*.orc")
        assert orc.ORCFile(file).nstripes > 1
        read = token_files.read_tokens(spark, f"{tmp_path}/t")
        assert read.rdd.getNumPartitions() > 1
        rows = sorted((r.start, r.n_tokens, r.doc_id) for r in read.select("start", "n_tokens", "doc_id").collect())
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    assert [r[2] for r in rows] == list(range(12_000))
    assert [r[0] for r in rows] == np.cumsum([0, *(r[1] for r in rows)])[:-1].tolist()


def test_words_are_parted_as_the_vocabulary_parts_them(tokenizer):
    """Random texts of hard characters, in groups, against the library on each whole text."""
    rng = random.Random(4)
    some = "abZ É ß é İ ' s t 1 , . … \u0301 ’ \u00a0 \u2003 \n ﬁ ½ × 日 <|endoftext|> \x85 \u200b ẞ µ À \x1c re".split(" ") + [" ", " "]
    texts = ["".join(rng.choice(some) for _ in range(rng.randint(0, 40))) for _ in range(4000)]
    with open(token_files.vocabulary_path(), encoding="utf-8") as file:
        encode = token_files.Encoder(file.read())
    for low in range(0, len(texts), 500):
        ids, counts = encode([t.encode() for t in texts[low : low + 500]])
        wanted = [e.ids for e in tokenizer.encode_batch(texts[low : low + 500], add_special_tokens=False)]
        assert [p.tolist() for p in np.split(ids, np.cumsum(counts)[:-1])] == wanted
