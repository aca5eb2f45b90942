"""Archives written, indexed and read back."""

from __future__ import annotations

import base64
import hashlib

import pytest
from tables import plain_rows

from tallygate.llm import warc

SCHEMA = "page_id bigint, url string, html string, sha1 string, size int, first string, file int"
EXTRA = ("s", 3, "f", 4)
PAGES = [
    (5, "http://a.example/x", "<p>one</p>"),
    (2, "http://a.example/y", "<p>one</p>"),
    (9, "http://b.example/", "<p>one</p>"),
    (1, None, None),
    (4, "", ""),
    (7, "http://c.example/\r\nWARC-Type: spam\u00e9 %20", "\r\n\r\nWARC/1.1\r\n\r\n"),
    (8, "no address", "é😀" * 40_000),
    (8, "no address", "é😀" * 40_000),
    (None, "http://d.example", "<p>one</p>"),
    (None, "http://e.example", "only without an id"),
]


def page_table(spark, rows):
    return spark.createDataFrame([(*row, *EXTRA) for row in rows], SCHEMA).repartition(3)


def wanted(rows, least):
    out = []
    for page_id, _, html in rows:
        payload = (html or "").encode()
        alike = [i for i, _, h in rows if (h or "").encode() == payload and i is not None]
        first = min(alike, default=None)
        response = page_id == first or len(payload) < least
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        kind = "response" if response else "revisit"
        out.append((page_id, len(payload), digest, kind, None if response else first))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 1, 11, 10**9])
def test_round_trip(spark, tmp_path, least):
    index = warc.write(page_table(spark, PAGES), str(tmp_path), least)
    found = warc.read(index, str(tmp_path)).drop("url")
    assert plain_rows(found) == wanted(PAGES, least)


def test_payloads_and_urls_come_back(spark, tmp_path):
    index = warc.write(page_table(spark, PAGES), str(tmp_path))
    rows = {r.page_id: r for r in warc.read(index, str(tmp_path), with_payload=True).collect()}
    assert bytes(rows[8].payload).decode() == PAGES[6][2]
    assert bytes(rows[7].payload).decode() == PAGES[5][2]
    assert rows[9].payload is None and rows[9].refers_to == 2
    assert rows[1].url is None and rows[4].url == "" and rows[5].url == PAGES[0][1]
    assert "\n" not in rows[7].url


def test_a_selection_reads_only_its_records(spark, tmp_path):
    index = warc.write(page_table(spark, PAGES), str(tmp_path))
    some = warc.read(index.where("page_id IN (2, 7)"), str(tmp_path))
    assert sorted(r.page_id for r in some.collect()) == [2, 7]


def test_index_rows_are_gzip_members(spark, tmp_path):
    import zlib

    for row in warc.write(page_table(spark, PAGES), str(tmp_path)).collect():
        with open(tmp_path / row.file, "rb") as archive:
            archive.seek(row.offset)
            headers, _ = warc.parse(zlib.decompress(archive.read(row.length), wbits=31))
        assert headers["WARC-Payload-Digest"] == f"sha1:{row.digest}"


def test_a_changed_payload_is_an_error():
    plain = warc.record(1, "u", b"abc", 3, warc.base32_sha1(b"abd"), None)
    with pytest.raises(ValueError):
        warc._fields(plain)


def test_ranges_are_coalesced(monkeypatch):
    monkeypatch.setattr(warc, "SKIP_BYTES", 10)
    monkeypatch.setattr(warc, "READ_BYTES", 100)
    rows = [("a", 0, 30), ("a", 30, 30), ("a", 65, 30), ("a", 95, 30), ("a", 500, 200), ("b", 0, 5)]
    assert [(f, s, e, len(o)) for f, s, e, o in warc.ranges(rows)] == [
        ("a", 0, 95, 3), ("a", 95, 125, 1), ("a", 500, 700, 1), ("b", 0, 5, 1),
    ]
    assert list(warc.ranges([])) == []


def test_no_pages(spark, tmp_path):
    index = warc.write(page_table(spark, []), str(tmp_path / "none"))
    assert plain_rows(warc.read(index, str(tmp_path / "none"))) == []
