import gzip
import hashlib
import io
import json
import zlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm import warc
from tidemark.session import scratch_path

PAGES = "page_id long, url string, html string, digest string, same int"


def brute(rows):
    last = {}
    for n, (p, _, h) in enumerate(rows):
        h = (h or "").encode()
        if len(h) >= 1000:
            last.setdefault(h, []).append((p is not None, p or 0, n))
    out = []
    for n, (p, u, h) in enumerate(rows):
        h = (h or "").encode()
        tops = [x for x in last.get(h, []) if x[:2] == max(last[h])[:2]]
        first = min(tops, key=lambda x: x[2]) if tops else None  # rows of one page_id: any of them
        revisit = first is not None and first[2] != n
        out.append((p, len(h), hashlib.sha1(h).hexdigest(), "revisit" if revisit else "response",
                    first[1] if revisit and first[0] else None))
    return out


def key(r):
    return tuple((x is None, x) if not isinstance(x, tuple) else x for x in r)


def test_pages_equal_brute_force(spark):
    big, other = "é" * 700, "WARC/1.1\r\n\r\nContent-Length: 5\r\n\r\n" * 60
    rows = [(1, "http://a", big), (2, "http://b", big), (3, None, "short"), (4, "http://c", "short"), (5, "", None), (None, "x", big),
            (7, "http://d\r\nWARC-Type: evil", other), (9, "http://日本/ü", other), (8, "u", other), (10, "u", "x" * 999), (11, "u", "x" * 999),
            (12, "u", "y" * 1000), (12, "u", "y" * 1000), (None, "n", "z" * 2000), (None, "n", "z" * 2000)]
    rows += [(100 + i, f"h{i}", big) for i in range(300)]
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], PAGES).repartition(4)
    got = warc.archive_pages(docs).collect()
    assert sorted(key((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)) for r in got) == sorted(map(key, brute(rows)))
    uris = {r.page_id: r.target_uri for r in got}
    assert uris[7] == "http://d%0D%0AWARC-Type: evil" and uris[9] == "http://日本/ü" and uris[3] is None


def test_groups_beyond_the_broadcast_ones(spark, monkeypatch):
    monkeypatch.setattr(warc, "HOT_GROUPS", 2)
    rows = [(i, f"u{i}", f"{i % 7}" * 1200) for i in range(80)]
    got = warc.archive_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted(key(tuple(r)[:5]) for r in got) == sorted(map(key, brute(rows)))


def test_archives_are_normalised_member_by_member(spark):
    rows = [(i, f"u{i}", f"page {i} " * (i % 9)) for i in range(60)]
    docs = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
    listing = warc.write_monolithic(warc.equal_payloads(docs), scratch_path(spark, "w"), roll=4000)
    files = [r.path.removeprefix("file://") for r in listing.collect()]
    assert len(files) > 2 and sum(r.records for r in listing.collect()) == 60
    for f in files:  # one member a file
        d = zlib.decompressobj(31)
        d.decompress(open(f, "rb").read())
        assert d.eof and not d.unused_data
    index = warc.normalise(listing, scratch_path(spark, "n"))
    entries = index.orderBy("path", "offset").collect()
    assert len(entries) == 60
    for path in {e.path for e in entries}:
        raw = open(path.removeprefix("file://"), "rb").read()
        own = [e for e in entries if e.path == path]
        assert [e.offset for e in own] == [sum(x.length for x in own[:i]) for i in range(len(own))]
        assert sum(e.length for e in own) == len(raw)
        for e in own:  # every member inflates alone, to one record
            ((head, whole),) = warc.records_of(iter([gzip.decompress(raw[e.offset:e.offset + e.length])]))
            assert head["warc-record-id"] == e.record_id
        lines = [json.loads(x) for x in open(path.removeprefix("file://") + ".idx")]
        assert [(x["offset"], x["length"], x["record_id"]) for x in lines] == [(e.offset, e.length, e.record_id) for e in own]
    few = index.where(F.col("record_id") == entries[5].record_id)
    assert [r.page_id for r in warc.read_records(few).collect()] == [warc.page_of(entries[5].record_id)]


def test_streams_are_inflated_in_small_steps_and_cut_ones_raise():
    raw = b"".join(warc.build_record(f"<urn:page:{i}:{i}>", "response", None, "d", b"x" * i * 50, hashlib.sha1(b"x" * i * 50).hexdigest())
                   for i in range(40))
    packed = gzip.compress(raw[:3000]) + gzip.compress(raw[3000:])
    for step in (7, 100, 1 << 20):
        got = [r for _, r in warc.records_of(warc.inflated(io.BytesIO(packed), step))]
        assert b"".join(got) == raw and len(got) == 40
    with pytest.raises(EOFError):
        list(warc.records_of(warc.inflated(io.BytesIO(packed[:-30]))))
    with pytest.raises(EOFError):
        list(warc.records_of(iter([raw[:-5]])))


def test_a_changed_payload_is_found(spark):
    docs = spark.createDataFrame([(1, "u", "p" * 50)], "page_id long, url string, html string")
    records = warc.equal_payloads(docs).withColumn("digest", F.sha1(F.lit("other")))
    index = warc.normalise(warc.write_monolithic(records, scratch_path(spark, "w")), scratch_path(spark, "n"))
    with pytest.raises(Exception, match="differs from its digest"):
        warc.read_records(index).collect()


def test_empty_table(spark):
    assert warc.archive_pages(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []
