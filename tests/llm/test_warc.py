"""Archives read back against the pages they were written from."""

import base64
import gzip
import hashlib
import io

import pytest

from tarnwork.llm import warc


def pages():
    big = "ü" * 300_000 + "end"
    rows = [(1, "http://a/1", "same"), (2, "http://a/2", "same"), (9, None, "same"), (3, "u", None), (4, "u", ""), (5, "bad\r\nWARC-Type: x y", "five")]
    rows += [(6, "u", big), (7, "u", big), (8, "u", big + "!"), (None, "u", "same"), (None, "u", "alone"), (10, "u", "WARC/1.1\r\n\r\n\r\nWARC/1.1\n")]
    return rows + [(11, "u", "twin"), (11, "u", "twin"), *[(100 + i, "u", "crowd") for i in range(300)]]


def by_hand(rows, least):
    best = {}
    for page, _, text in rows:
        if len((text or "").encode()) >= least:
            best[text or ""] = max(best.get(text or "", -1), -1 if page is None else page)
    out, used = [], set()
    for page, _, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        body = (text or "").encode()
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        chief = best.get(text or "")
        first = chief is None or (chief == (-1 if page is None else page) and body not in used)
        if chief is not None and first:
            used.add(body)
        out.append((page, len(body), digest, "response" if first else "revisit", None if first or chief < 0 else chief))
    return out


key = lambda r: tuple((x is not None, x) for x in r)


@pytest.mark.parametrize("least,chunk", [(0, 256 << 10), (5, 1000)])
def test_round_trip(spark, least, chunk):
    rows = pages()
    table = spark.createDataFrame([(*r, "x", 5) for r in rows], "page_id long, url string, html string, record string, bytes int").repartition(3)
    folder = warc.write_archives(table, spark, least=least, chunk=chunk, roll=2000)
    read = warc.read_archives(spark, folder, chunk=chunk).collect()
    heads = [(r["page_id"], r["seen"], r["sha1"], r["record_type"], r["refers_to"]) for r in read if r["last"]]
    assert sorted(heads, key=key) == sorted(by_hand(rows, least), key=key)
    bodies = {}
    for r in sorted(read, key=lambda r: r["chunk"]):
        assert r["body"] is None or len(r["body"]) <= chunk
        if r["record_type"] == "response":
            bodies[r["record"]] = bodies.get(r["record"], b"") + r["body"]
    texts = {(t or "").encode() for _, _, t in rows}
    assert set(bodies.values()) == texts
    brief = warc.read_archives(spark, folder, bodies=False).collect()
    assert sorted([(r["page_id"], r["seen"], r["sha1"], r["record_type"], r["refers_to"]) for r in brief], key=key) == sorted(heads, key=key)


def test_files_are_gzip_members_with_whole_records(spark):
    table = spark.createDataFrame(pages(), "page_id long, url string, html string").coalesce(1)
    folder = warc.write_archives(table, spark)
    name = spark.read.parquet(f"{folder}/archives").first()["file"]
    from tarnwork.llm import files

    raw = bytes(files.mapped(f"{folder}/{name}"))
    assert raw[:2] == b"\x1f\x8b"
    text = gzip.decompress(raw)
    assert text.startswith(b"WARC/1.1\r\n") and text.endswith(b"\r\n\r\n") and b"WARC-Type: x" not in text


def test_damage_is_noticed():
    head = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:uuid:1>\r\nWARC-Payload-Digest: sha1:AAAA\r\nContent-Length: 24\r\n\r\n"
    with pytest.raises(ValueError, match="digest"):
        list(warc.parse_archive(io.BytesIO(head + b"HTTP/1.1 200 OK\r\n\r\nhello\r\n\r\n")))
    with pytest.raises(ValueError, match="early"):
        list(warc.parse_archive(io.BytesIO(head + b"HTTP/1.1 200 OK\r\n\r\nhe")))


def test_empty_table(spark):
    table = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_archives(spark, warc.write_archives(table, spark)).count() == 0
