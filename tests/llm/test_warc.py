import base64
import gzip
import hashlib
import io
import random

import pytest

from tablewarden.llm.records import read_records, record
from tablewarden.llm.warc import page_of, read_archives, write_archives


def digest(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def expected(pages, least=0):
    groups = {}
    for page, html in pages:
        groups.setdefault(html or "", []).append(page)
    out = []
    for page, html in pages:
        data = (html or "").encode()
        known = [p for p in groups[html or ""] if p is not None]
        first = max(known) if known and len(data) >= least else page
        out.append((page, len(data), digest(data), "response" if page == first else "revisit",
                    None if page == first else first))
    return sorted(out, key=repr)


def found(records):
    rows = records.select(page_of("record_id"), "payload_bytes", "payload_digest", "record_type",
                          page_of("refers_to"), "intact").collect()
    assert all(r[5] for r in rows)
    return sorted((tuple(r)[:5] for r in rows), key=repr)


PAGES = [(1, "<p>a</p>"), (2, "<p>a</p>"), (3, "<p>b\r\n\r\nc</p>"), (4, None), (5, ""), (6, "é" * 5), (None, "<p>a</p>"),
         (7, "<p>a</p>"), (7, "<p>a</p>"), (None, "only"), (None, "only"), (8, "long " * 100_000), (9, "WARC/1.1\r\n\r\n")]


def test_pages_come_back(spark):
    df = spark.createDataFrame([(p, f"http://x.example/ {p}\n", h, "z") for p, h in PAGES],
                               "page_id bigint, url string, html string, _digest string").repartition(3)
    archives = write_archives(df)
    records = read_archives(archives)
    assert found(records) == expected(PAGES)
    payloads = {(r["payload"].decode()) for r in records.where("record_type = 'response'").collect()}
    assert payloads == {h or "" for _, h in PAGES}
    assert records.where("record_type = 'revisit' AND payload IS NOT NULL").count() == 0
    assert archives.agg({"records": "sum"}).first()[0] == len(PAGES)
    assert found(read_archives(write_archives(df, least_bytes=6))) == expected(PAGES, 6)
    assert found(read_archives(write_archives(df.limit(0)))) == []


def test_members_are_read_one_by_one():
    rng = random.Random(2)
    pages = [(i, "".join(rng.choices("ab<\n\r é", k=rng.choice([0, 1, 50, 400_000])))) for i in range(12)]
    data = b"".join(record(i, None, h.encode(), 3 if i % 4 == 1 else None, i % 4 == 1) for i, h in pages)
    assert gzip.decompress(data).count(b"WARC/1.1\r\n") == 12
    records = list(read_records(io.BytesIO(data)))
    assert [r.payload.decode() for r in records] == ["" if i % 4 == 1 else h for i, h in pages]
    assert [r.payload_bytes for r in records] == [len(h.encode()) for _, h in pages]
    assert all(r.intact for r in records)


def test_damage_is_seen():
    whole = record(1, "http://x.example/", b"payload", None, False)
    text = gzip.decompress(whole)
    changed = gzip.compress(text.replace(b"payload", b"payl0ad"))
    assert [r.intact for r in read_records(io.BytesIO(changed))] == [False]
    for bad in (whole[:-9], gzip.compress(text[:-6]), gzip.compress(text + b"x"), gzip.compress(b"HTTP/1.1 200\r\n\r\n")):
        with pytest.raises(ValueError):
            list(read_records(io.BytesIO(bad)))


def test_a_very_long_url_comes_back():
    url = "https://example.org/" + "a" * 3_000_000
    rows = list(read_records(io.BytesIO(record(1, url, b"x", None, False) + record(2, "u", b"y", None, False))))
    assert [r.fields["warc-target-uri"] for r in rows] == [url, "u"] and all(r.intact for r in rows)
