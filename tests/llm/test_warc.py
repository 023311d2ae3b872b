"""The archive: exact round trip, one response per payload, damage found."""

from __future__ import annotations

import hashlib
import re

import pytest

from wavebook.llm.queries import op3_content_addressed_warc
from wavebook.llm.warc import export_warc, read_archive, record_bytes, write_archive

PAGES = [
    (1, "http://a.example/", "x" * 1000),
    (2, "http://b.example/ä b", "x" * 1000),
    (5, None, "x" * 1000),
    (6, "", "short"),
    (7, "http://c.example/\r\nX-Evil: 1", "short"),
    (8, "u", None),
    (9, "u", ""),
    (10, "u", "é" * 600),
    (11, "u", "é" * 600),
    (12, "u", "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n" * 40),
    (13, "u", "y" * 2000),
    (13, "u", "y" * 2000),
    (3, "u", "y" * 2000),
    (None, "u", "z" * 1500),
    (4, "u", "z" * 1500),
    (14, "u", "x" * 999),
    (15, "u", "x" * 999),
]


@pytest.fixture
def pages(spark):
    rows = [(*p, "extra", "extra") for p in PAGES]
    return spark.createDataFrame(rows, "page_id long, url string, html string, sha256 string, keeper string").repartition(4)


def expected():
    best = {}
    for page, _, html in PAGES:
        if page is not None and len((html or "").encode()) >= 1000:
            best[html] = max(best.get(html, page), page)
    out = []
    for page, _, html in PAGES:
        payload = (html or "").encode()
        keeper = best.get(html)
        again = keeper is not None and page != keeper
        out.append(
            (page, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if again else "response", keeper if again else None)
        )
    return sorted(out, key=str)


def test_query(spark, pages, tmp_path):
    pages.write.parquet(f"{tmp_path}/pages.parquet")
    rows = op3_content_addressed_warc(spark, str(tmp_path)).collect()
    assert sorted((tuple(r) for r in rows), key=str) == expected()


def test_records_are_exact(spark, pages, tmp_path):
    write_archive(pages, f"{tmp_path}/a")
    records = read_archive(spark, f"{tmp_path}/a")
    payloads = {p: (h or "").encode() for p, _, h in PAGES}
    for r in records.collect():
        if r.page_id is not None:
            assert bytes(r.payload) == payloads[r.page_id]
        header = bytes(r.warc_header).decode()
        assert header.startswith("WARC/1.1\r\n") and header.endswith("\r\n\r\n")
        assert "\r\nX-Evil" not in header
        length = int(re.search(r"\r\nContent-Length: (\d+)\r\n", header).group(1))
        assert length == len(bytes(r.block))
        http, _, body = bytes(r.block).partition(b"\r\n\r\n")
        assert body == (b"" if r.record_type == "revisit" else bytes(r.payload))
    ids = [re.search(r"WARC-Record-ID: (\S+)", bytes(r.warc_header).decode()).group(1) for r in records.collect()]
    assert len(set(ids)) == len(PAGES) - 1
    assert spark.read.parquet(f"{tmp_path}/a/payloads").count() == len({h or "" for *_, h in PAGES})
    export_warc(records, f"{tmp_path}/files")
    data = b"".join(p.read_bytes() for p in sorted((tmp_path / "files").glob("part-*")))
    made = [bytes(r.record) for r in record_bytes(records).collect()]
    assert len(data) == sum(map(len, made)) and all(m in data for m in made)


def test_damage_is_an_error(spark, pages, tmp_path):
    write_archive(pages, f"{tmp_path}/a")
    payloads = spark.read.parquet(f"{tmp_path}/a/payloads")
    whole = payloads.collect()
    changed = [(r.sha256, r.payload_bytes, bytes(r.payload)[:-1] + b"!") for r in whole if r.payload_bytes]
    spark.createDataFrame(changed, payloads.schema).write.mode("overwrite").parquet(f"{tmp_path}/a/payloads")
    with pytest.raises(Exception, match="no sound payload"):
        read_archive(spark, f"{tmp_path}/a").collect()


def test_empty(spark, pages, tmp_path):
    write_archive(pages.limit(0), f"{tmp_path}/a")
    assert read_archive(spark, f"{tmp_path}/a").count() == 0
