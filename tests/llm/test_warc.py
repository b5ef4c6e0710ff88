from __future__ import annotations

import gzip
import hashlib
import io
import random
import zlib

import pytest

from perishables.llm import warc as W

PAGES = "page_id long, url string, html string, payload string, digest string, first string"
BIG = "<p>" + "same " * 40 + "</p>"
ROWS = [(1, "http://a.example/x y\r\n", "<p>é</p>"), (2, "http://b.example", BIG), (3, None, BIG), (2, "http://b.example", BIG),
        (4, "http://c.example", None), (5, "", ""), (6, "u", "small"), (7, "u", "small"), (None, "u", BIG), (None, "v", "no id"),
        (8, "u", "\r\n\r\nWARC/1.1\r\n" * 50), (9, "u", "x" * 300_000)]


def pages(spark, rows=ROWS):
    return spark.createDataFrame([(i, u, h, "clash", "clash", "clash") for i, u, h in rows], PAGES)


def expected(rows):
    first: dict[str, int] = {}
    for i, _, h in rows:
        if i is not None and len((h or "").encode()) >= 100:
            first[h] = min(i, first.get(h, i))
    for i, _, h in rows:
        body = (h or "").encode()
        to = first.get(h) if len(body) >= 100 else None
        revisit = to is not None and to != i
        yield (None if i is None else str(i), len(body), hashlib.sha256(body).hexdigest(), "revisit" if revisit else "response",
               str(to) if revisit else None)


@pytest.mark.parametrize("split", [64, 1000, 1 << 24])
def test_every_record_comes_back_once_whatever_the_ranges(spark, split, monkeypatch):
    monkeypatch.setattr(W, "FILE_BYTES", 600)
    manifest = W.archive_pages(pages(spark))
    assert manifest.count() > 1
    rows = W.read_warc(spark, manifest, split).collect()
    got = sorted(((r["record_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in rows), key=repr)
    assert got == sorted(expected(ROWS), key=repr)
    assert all(r["payload"] is None or len(r["payload"]) == r["payload_bytes"] for r in rows)


def test_archives_are_standard(spark):
    row = W.archive_pages(pages(spark, ROWS[:2]).coalesce(1)).first()
    with gzip.open(row["file"].removeprefix("file:").replace("///", "/")) as f:
        text = f.read()
    assert text.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and text.count(b"WARC/1.1") == row["records"] == 2
    assert b"WARC-Target-URI: http://a.example/x%20y%0D%0A\r\n" in text


def test_empty_table(spark):
    assert W.read_warc(spark, W.archive_pages(pages(spark).limit(0))).count() == 0


def members():
    return [W.build_record(str(i), "u", b"<html>" * i * 30, "d", None, False) for i in range(12)]


def starts(raw, step):
    return [at for lo in range(0, len(raw), step) for at, _ in W.RangeReader(io.BytesIO(raw), lo, min(lo + step, len(raw)))]


@pytest.mark.parametrize("step", [1, 7, 100, 10**6])
def test_ranges_own_the_records_that_start_in_them(step):
    parts = members()
    want = [sum(map(len, parts[:i])) for i in range(len(parts))]
    assert starts(b"".join(parts), step) == want


def test_magic_that_is_no_record_and_damage_are_passed_over():
    parts = members()
    parts[3] = parts[3][:-9] + b"\x00" + parts[3][-8:]              # damaged
    other = gzip.compress(b"no archive") + W.MAGIC + b"junk" + W.MAGIC
    stored = zlib.compressobj(0, zlib.DEFLATED, 31)                   # a record inside another's stored block
    inner = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:z>\r\nContent-Length: 0\r\n"
    parts.insert(5, other + stored.compress(inner) + stored.flush())  # ends inside its header
    raw = b"".join(parts)
    ids = [W._from_urn(r.head["warc-record-id"]) for _, r in W.RangeReader(io.BytesIO(raw), 0, len(raw))]
    assert ids == [str(i) for i in range(12) if i != 3]


def test_headers_of_any_length(spark):
    rng = random.Random(2)
    urls = ["data:text/plain," + "a b" * 70_000, "http://d.example/?" + "".join(rng.choices("abcdefghij0123456789", k=200_000))]
    rows = [(i, urls[i % 2] if i < 4 else "u", BIG if i < 3 else f"page {i}") for i in range(8)]
    manifest = W.archive_pages(pages(spark, rows))
    got = W.read_warc(spark, manifest, 1000).collect()
    assert len(got) == sum(r["records"] for r in manifest.collect()) == len(rows)
    assert {(r["record_id"], r["url"]) for r in got} == {(str(i), u.replace(" ", "%20")) for i, u, _ in rows}
    assert {r["record_id"] for r in got if r["record_type"] == "response"} >= {r["refers_to"] for r in got if r["refers_to"]} == {"0"}


def test_damage_is_told_and_fails_the_whole(spark, tmp_path):
    manifest = W.archive_pages(pages(spark).coalesce(1))
    assert W.read_whole(spark, manifest).count() == len(ROWS)
    row = manifest.first()
    path = row["file"].removeprefix("file:").replace("///", "/")
    with open(path, "rb") as f:
        raw = bytearray(f.read())
    places = [at for at, _ in W.RangeReader(io.BytesIO(bytes(raw)), 0, len(raw))]
    raw[places[3] - 5] ^= 1                                            # the checksum of the third member
    broken = tmp_path / "broken.warc.gz"
    broken.write_bytes(raw)
    files = spark.createDataFrame([(str(broken), len(raw), row["records"])], W.MANIFEST)
    rows = W.read_warc(spark, files, 1000, damaged=True).collect()
    assert [(r["start"], r["record_id"]) for r in rows if r["record_type"] == W.DAMAGED] == [(places[2], None)]
    assert len(rows) == len(ROWS) and W.read_warc(spark, files, 1000).count() == len(ROWS) - 1
    with pytest.raises(ValueError, match="1 records lost, 1 damaged"):
        W.read_whole(spark, files)
    # a file cut short, and one that is not read at all
    cut = tmp_path / "cut.warc.gz"
    cut.write_bytes(bytes(raw[:places[2]]))
    with pytest.raises(ValueError, match="records lost, 0 damaged"):
        W.read_whole(spark, spark.createDataFrame([(str(cut), places[2], row["records"])], W.MANIFEST))
    assert W.read_whole(spark, W.archive_pages(pages(spark).limit(0))).count() == 0
