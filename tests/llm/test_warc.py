"""Exact round trips through archives cut at every kind of place."""

import gzip
import hashlib

from pyarrow import fs

from folkmoot.llm import common, warc


def test_round_trip(spark):
    big = "<p>über " + "x" * 5000 + "</p>"
    rows = [(5, "http://a/1", big, "k"), (2, "http://a/2", big, "k"), (9, None, big, "k"), (1, "u\r\nEvil: 1", None, "k"), (3, "s", "tiny", "k"), (4, "s", "tiny", "k"), (None, "n", "z" * 200, "k"), (7, "e", "", "k")]
    rows += [(100 + i, f"http://b/{i}", f"page {i} " * (i % 50), "k") for i in range(300)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest string").repartition(3)
    manifest = warc.write(pages, common.new_path(spark, "warc"))
    assert sum(r.records for r in manifest.collect()) == len(rows)
    whole = warc.read(manifest).collect()
    assert len(whole) == len(rows)
    key = lambda r: (r.page_id is not None, r.page_id)
    for split in (37, 1000, 40_001):
        assert sorted(warc.read(manifest, split).collect(), key=key) == sorted(whole, key=key)
    html = {i: (h or "").encode() for i, _, h, _ in rows}
    first = {}
    for i, h in html.items():
        if len(h) >= 100 and i is not None:
            first[h] = min(first.get(h, i), i)
    for r in whole:
        h = html[r.page_id]
        assert (r.payload_bytes, r.payload_digest) == (len(h), hashlib.sha256(h).hexdigest())
        refers = first.get(h) if len(h) >= 100 and first.get(h) != r.page_id else None
        assert (r.refers_to, r.record_type) == (refers, "response" if refers is None else "revisit")
        assert r.payload == (h if refers is None else b"")
    system, path = fs.FileSystem.from_uri(manifest.first().file)
    with system.open_input_stream(path, compression=None) as f:
        assert gzip.decompress(f.read()).startswith(b"WARC/1.1\r\n")


def test_empty(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.round_trip(pages).count() == 0


def test_magic_inside_a_payload_is_no_record(spark):
    inner = gzip.compress(b"not a record") + b"\x1f\x8b\x08junk"
    pages = spark.createDataFrame([(i, "u", bytearray(inner * 50 + bytes([i]))) for i in range(20)], "page_id long, url string, html binary").repartition(1)
    manifest = warc.write(pages, common.new_path(spark, "warc"))
    assert sorted(r.page_id for r in warc.read(manifest, 50).collect()) == list(range(20))
