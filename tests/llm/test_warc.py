import base64
import hashlib

import zstandard
from pyarrow import fs

from tidemark.llm import warc

PAGES = "page_id long, url string, html string, digest string, first string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], PAGES)


def sha(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def test_round_trip(spark):
    same = "<p>same</p>" * 50
    rows = [(i, f"http://h/{i}\r\nX: y", same if i % 3 == 0 else f"<p>{i} äß€😀\r\n\r\nWARC/1.1</p>" * (i + 1)) for i in range(1, 40)]
    rows += [(50, None, None), (51, "http://h/51", ""), (52, "u", "z" * 3_000_000), (53, "u", "z" * 3_000_000)]
    first = {}
    for i, _, html in rows:
        first.setdefault(html or "", i)
    got = {r["page_id"]: r for r in warc.round_trip(pages(spark, rows)).collect()}
    assert len(got) == len(rows)
    for i, _, html in rows:
        owner = first[html or ""]
        assert got[i].asDict() == {"page_id": i, "payload_bytes": len((html or "").encode()), "payload_digest": sha(html),
                                   "record_type": "response" if owner == i else "revisit", "refers_to": None if owner == i else owner}


def test_short_payloads_null_and_repeated_ids_and_no_pages(spark):
    rows = [(2, "u", "abc"), (1, "u", "abc"), (3, "u", "abcdef"), (4, "u", "abcdef"), (4, "u", "abcdef"), (None, "u", "abcdef")]
    got = sorted((r["page_id"] or 0, r["record_type"], r["refers_to"]) for r in warc.round_trip(pages(spark, rows), dedup_from=4).collect())
    assert got == [(0, "response", None), (1, "response", None), (2, "response", None), (3, "response", None), (4, "revisit", 3), (4, "revisit", 3)]
    again = sorted(tuple(r) for r in warc.round_trip(pages(spark, [(1, "u", "x"), (1, "u", "x"), (1, "u", "other")])).select("page_id", "record_type", "payload_bytes").collect())
    assert again == [(1, "response", 1), (1, "response", 1), (1, "response", 5)]
    assert warc.round_trip(pages(spark, [])).collect() == []


def test_files_seek_and_decompress_whole(spark, tmp_path):
    rows = [(i, "u", f"{i} " * 60_000) for i in range(12)]
    index = warc.write_archives(pages(spark, rows).coalesce(1), f"file://{tmp_path}/a")
    one = index.where("page_id = 7")
    assert one.first()["frame"] > 0 and [r["page_id"] for r in warc.read_archives(one).collect()] == [7]
    for uri in {r["file"] for r in index.collect()}:
        store, path = fs.FileSystem.from_uri(uri)
        with store.open_input_file(path) as f:
            table = warc.seek_table(f)
            assert sum(size for _, size in table) == table[-1][0] + table[-1][1]
            f.seek(0)
            data = zstandard.ZstdDecompressor().stream_reader(f, read_across_frames=True).read()  # skips the seek table
            assert data.startswith(b"WARC/1.1\r\n") and data.count(b"WARC-Record-ID") == data.count(b"WARC-Type")
