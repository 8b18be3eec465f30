import hashlib
import re
from collections import Counter

import pytest

from tarnlab.llm import warc

BIG, OTHER, SMALL = "<p>é</p>" * 200, "x" * 1000, "y" * 999


@pytest.fixture(scope="module")
def pages(spark):
    rows = [
        (1, "http://a/1", BIG), (2, "http://a/2", BIG), (9, "http://a/ 9\r\nX: y", BIG), (3, None, SMALL), (4, "", SMALL), (5, "u", OTHER), (5, "u", OTHER),
        (6, "v", OTHER), (7, "n", None), (8, "n", ""), (None, "w", BIG), (None, "w", "z" * 2000), (None, "w", "z" * 2000),
    ]
    df = spark.createDataFrame([(*r, "d", "k", 1) for r in rows], "page_id long, url string, html string, digest string, kept string, payload_bytes int")
    return df.repartition(4), rows


def test_records(spark, pages):
    df, rows = pages
    archive = warc.write_archive(df)
    got = warc.read_archive(spark, archive).collect()
    top = {}
    for i, _, h in rows:
        top[h or ""] = max(top.get(h or "", -1), -1 if i is None else i)
    expected = Counter()
    for i, _, h in rows:
        body = (h or "").encode()
        revisit = len(body) >= 1000 and (-1 if i is None else i) != top[h or ""]
        expected[i, len(body), hashlib.sha1(body).hexdigest(), "revisit" if revisit else "response", top[h or ""] if revisit else None] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == expected
    assert warc.read_payloads(spark, archive).count() == len({h or "" for _, _, h in rows})


def test_exact_bytes(spark, pages):
    df, _ = pages
    for r in warc.read_archive(spark, warc.write_archive(df)).collect():
        head, http, rest = bytes(r.record).split(b"\r\n\r\n", 2)
        assert head.startswith(b"WARC/1.1\r\n") and http.startswith(b"HTTP/1.1 200 OK")
        length = int(re.search(rb"Content-Length: (\d+)$", head)[1])
        block = bytes(r.record)[len(head) + 4 :]
        assert block[length:] == b"\r\n\r\n"
        body = block[:length].split(b"\r\n\r\n", 1)[1]
        assert body == (b"" if r.record_type == "revisit" else bytes(r.payload))
        assert head.count(b"WARC-Type") == 1 and rest is not None


def test_damage_stops_the_read(spark, pages):
    df, _ = pages
    archive = warc.write_archive(df)
    rows = spark.read.parquet(archive.payloads).replace("nothing", "none")
    bad = f"{archive.payloads}-bad"
    rows.selectExpr("digest", "concat(payload, X'00') AS payload").write.parquet(bad)
    with pytest.raises(Exception, match="damaged payload"):
        warc.read_archive(spark, warc.Archive(archive.headers, bad)).collect()


def test_empty(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_archive(spark, warc.write_archive(df)).count() == 0
