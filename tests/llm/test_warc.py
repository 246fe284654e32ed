import gzip
import hashlib
import io
import random
import zlib

import pytest

from hazardline.llm import warc
from hazardline.session import shared_folder

SCHEMA = "page_id long, url string, html string, payload string, id_ long"


def pages(spark):
    rng = random.Random(2)
    big = ["é" * 700, "x" * 1000, "<p>\r\n\r\nWARC/1.1\r\n" * 80, "y" * 999, "😀" * 250]
    rows = [(k, f"http://a/{k} b\r\nX: y", rng.choice([*big, None, "", "small"]), "z", 1) for k in range(120)]
    rows += [(200, None, "x" * 1000, None, None), (200, "u", "x" * 1000, None, None), (None, "n", "x" * 1000, None, None)]
    rows += [(None, "m", "only null " * 200, "", 2), (None, "m", "only null " * 200, "", 2), (300, "long", "long text " * 300_000, "", 3)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3), rows


def test_round_trip_equals_sql(spark, against_sql):
    df, _ = pages(spark)
    against_sql(warc.round_trip(df), warc.ROUND_TRIP_SQL, pages=df)


def test_payloads_come_back(spark):
    df, rows = pages(spark)
    folder = shared_folder(spark, "warc-test")
    warc.write_archives(df, f"{folder}/whole", file_records=25)
    files = warc.normalise(spark, f"{folder}/whole", f"{folder}/members").collect()
    assert sum(f["records"] for f in files) == len(rows) and len(files) > 3
    index = warc.read_index(spark, f"{folder}/members")
    assert index.count() == len(rows)
    got = warc.read_archives(index, f"{folder}/members").collect()
    stored = {r["page_id"]: bytes(r["payload"]) for r in got if r["record_type"] == "response" and r["page_id"] is not None}
    html = {k: (h or "").encode() for k, _, h, *_ in rows if k is not None}
    assert all(stored[k] == html[k] for k in stored)
    assert all(stored[r["refers_to"]] == html[r["page_id"]] for r in got if r["record_type"] == "revisit" and r["page_id"] is not None)
    one = warc.read_archives(index.where("page_id = '300'"), f"{folder}/members").collect()
    assert len(one) == 1 and one[0]["url"] == "long" and len(one[0]["payload"]) == 3_000_000
    # by the index alone, with nothing but gzip
    place = index.where("page_id = '300'").first()
    with open(f"{folder}/members/{place['archive']}", "rb") as f:
        f.seek(place["offset"])
        record = gzip.decompress(f.read(place["length"]))
    assert record.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and record.endswith(b"long text \r\n\r\n")


def record(payload, digest=None, kind="response"):
    block = warc.HTTP_HEADER.encode() + payload
    digest = digest or hashlib.sha1(payload).hexdigest()
    return f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Payload-Digest: sha1:{digest}\r\nContent-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def test_members_and_streams_read_the_same(tmp_path):
    made = [record(b"a" * n) for n in (0, 1, 300_000, 5)]
    (tmp_path / "one.gz").write_bytes(gzip.compress(b"".join(made)))
    (tmp_path / "many.gz").write_bytes(b"".join(map(gzip.compress, made)))
    (tmp_path / "odd.gz").write_bytes(gzip.compress(b"".join(made)[:150]) + gzip.compress(b"".join(made)[150:]))
    for name in ("one", "many", "odd"):
        assert warc.normalise_file(f"{tmp_path}/{name}.gz", f"{tmp_path}/{name}.warc.gz")[0] == 4
    assert len({(tmp_path / f"{n}.warc.gz").read_bytes() for n in ("one", "many", "odd")}) == 1
    at = 0
    whole = (tmp_path / "one.warc.gz").read_bytes()
    for line, want in zip((tmp_path / "one.warc.gz.idx").read_text().splitlines(), made, strict=True):
        offset, length = map(int, line.split("\t")[1:3])
        assert offset == at and zlib.decompress(whole[offset : offset + length], 31) == want
        at += length
    assert at == len(whole)


@pytest.mark.parametrize(
    ("content", "message"),
    [
        (gzip.compress(record(b"abc"))[:-12], "breaks off"),
        (gzip.compress(record(b"abc")[:-6]), "breaks off"),
        (gzip.compress(record(b"abc")[:-4] + b"xxxx"), "not closed"),
        (gzip.compress(record(b"abc", "0" * 40)), "has payload"),
        (gzip.compress(b"HTTP/1.1\r\n\r\n"), "begins with"),
        (b"plain text", "not a gzip"),
    ],
)
def test_broken_files_are_errors(tmp_path, content, message):
    (tmp_path / "x.gz").write_bytes(content)
    with pytest.raises(ValueError, match=message):
        warc.normalise_file(f"{tmp_path}/x.gz", f"{tmp_path}/x.warc.gz")
    assert not (tmp_path / "x.warc.gz").exists()


def test_memory_does_not_grow_with_a_record():
    packed = gzip.compress(record(b"\0" * 30_000_000))
    stream = warc.Inflated(io.BytesIO(packed), "x")
    head = warc.parse_header(stream.until(b"\r\n\r\n", 1000), "x")
    most = 0
    for _ in stream.take(int(head["content-length"])):
        most = max(most, len(stream.ready))
    assert most <= 2 * warc.CHUNK


def test_empty_table(spark):
    assert warc.round_trip(spark.createDataFrame([], SCHEMA)).collect() == []


def test_text_ids(spark):
    df = spark.createDataFrame([("a/b c\n", "u", "x" * 2000), ("é+", "u", "x" * 2000)], "page_id string, url string, html string")
    got = {r["page_id"]: (r["record_type"], r["refers_to"]) for r in warc.round_trip(df).collect()}
    assert got == {"a/b c\n": ("revisit", "é+"), "é+": ("response", None)}
