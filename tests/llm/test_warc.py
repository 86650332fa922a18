import hashlib
import io

import pytest

from surveyloom.llm import queries, warc


def test_matches_sql(spark, small, database, same_rows):
    same_rows(queries.op1_warc(spark, small), database.sql(queries.ORACLE["op1_warc"]))


def test_odd_pages(spark):
    big = "ä" * 600
    pages = spark.createDataFrame(
        [(1, "u", big), (2, "u\r\nX: y", big), (2, None, big), (3, "u", "small"), (4, "u", "small"), (5, "u", None), (None, None, big), (None, "u", "")],
        "page_id long, url string, html string",
    ).selectExpr("*", "'x' AS payload_digest", "1 AS last")
    rows = sorted(map(tuple, warc.round_trip(spark, pages).select("page_id", "record_type", "refers_to", "payload_bytes", "digest_ok").collect()), key=str)
    expected = [
        (1, "revisit", 2, 1200, True), (2, "response", None, 1200, True), (2, "response", None, 1200, True), (3, "response", None, 5, True),
        (4, "response", None, 5, True), (5, "response", None, 0, True), (None, "revisit", 2, 1200, True), (None, "response", None, 0, True),
    ]
    assert rows == sorted(expected, key=str)
    assert warc.round_trip(spark, pages.limit(0)).count() == 0


def _archive():
    digest = hashlib.sha1(b"<p>hi</p>").hexdigest()
    return warc.page_record(1, "u", b"<p>hi</p>", 9, digest, None), warc.page_record(2, "u", None, 9, digest, 1)


@pytest.mark.parametrize("chunk", [1, 7, 1 << 16])
def test_members_are_read_one_by_one(chunk):
    first, second = _archive()
    records = list(warc.read_records(io.BytesIO(first + second), chunk))
    assert [r.headers["warc-type"] for r in records] == ["response", "revisit"]
    assert records[0].block.endswith(b"\r\n\r\n<p>hi</p>") and all(r.block_ok for r in records)


def test_truncated_and_misframed_archives_fail():
    first, _ = _archive()
    with pytest.raises(ValueError, match="truncated"):
        list(warc.read_records(io.BytesIO(first[:-9])))
    import gzip

    wrong = gzip.compress(gzip.decompress(first).replace(b"<p>hi</p>", b"<p>hi you</p>"))
    with pytest.raises(ValueError, match="Content-Length"):
        list(warc.read_records(io.BytesIO(wrong)))
    changed = gzip.compress(gzip.decompress(first).replace(b"<p>hi</p>", b"<p>ho</p>"))
    assert not next(warc.read_records(io.BytesIO(changed))).block_ok
    assert not next(warc._pages(warc.read_records(io.BytesIO(changed))))[-1]


def test_a_damaged_archive_gives_no_right_looking_rows(spark, tmp_path):
    """A payload that was changed after it was written: its own digest is returned and marked, or the read fails."""
    import gzip

    first, second = _archive()
    changed = gzip.compress(gzip.decompress(first).replace(b"<p>hi</p>", b"<p>ho</p>"))
    (tmp_path / "a.warc.gz").write_bytes(changed + second)
    files = spark.createDataFrame([(f"file://{tmp_path}/a.warc.gz",)], "path string")
    rows = {r.page_id: r for r in warc.read_archives(files).collect()}
    assert not rows[1].digest_ok and rows[1].payload_digest == hashlib.sha1(b"<p>ho</p>").hexdigest() and rows[2].digest_ok
    with pytest.raises(Exception, match="DamagedRecord"):
        warc.read_archives(files, strict=True).collect()
