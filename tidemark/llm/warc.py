"""Web archives as seekable Zstandard bundles.

Records are grouped into frames that decompress by themselves. After a file's last frame follows a skippable
frame with the compressed and decompressed size of every frame (the seek table), found from the file's end.
The index maps a record's id to file, frame and the record's offset in the decompressed frame, so one record
costs one frame. A payload that an earlier record holds is written as a revisit of that record.

Tasks write under names of their own and report them only when done: what a lost attempt left is in no index.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyarrow import fs as files
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import cut, utf8, written
from tidemark.session import scratch_path

FRAME_BYTES = 1 << 20  # decompressed, beyond which a frame is closed
RUNS = 4  # of 16 frames, that a reading task gets on average
FILE_BYTES = 64 << 20  # compressed, beyond which a file is closed
# Fixed values of the seekable format: skippable frame, footer
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
# Fixed value of the archive format: the profile of a revisit
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EPOCH = "1970-01-01T00:00:00Z"

INDEX = "page_id long, file string, frame long, offset long, length long"
RECORDS = "page_id long, record_type string, refers_to long, digest string, payload binary"


def _uri(page) -> str:
    return f"<urn:x-page:{'' if page is None else page}>"


def _page(uri: str) -> int | None:
    number = uri.removeprefix("<urn:x-page:").removesuffix(">")
    return int(number) if number else None


def record(page, url: str | None, payload: bytes, digest: str, refers_to, date: str = EPOCH) -> bytes:
    """One record. A revisit (``refers_to`` is a page) has the response's head but not its payload."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_uri(page)}",
             f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response"]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if refers_to is None:
        block += payload
    else:
        lines += [f"WARC-Refers-To: {_uri(refers_to)}", f"WARC-Profile: {SAME_PAYLOAD}"]
    return utf8("\r\n".join([*lines, f"Content-Length: {len(block)}", "", ""])) + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple:
    """page id, type, page referred to, digest of the head, payload (empty for a revisit)."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode("utf-8", "surrogatepass").split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    refers = fields.get("WARC-Refers-To")
    return (_page(fields["WARC-Record-ID"]), fields["WARC-Type"], _page(refers) if refers else None,
            fields["WARC-Payload-Digest"].removeprefix("sha1:"), block.partition(b"\r\n\r\n")[2])


class Bundle:
    """Writes one seekable file."""

    def __init__(self, folder: str) -> None:
        self.uri = f"{folder}/{uuid.uuid4().hex}.warc.zst"
        store, path = files.FileSystem.from_uri(self.uri)
        self.out = store.open_output_stream(path, compression=None)
        self.packer = zstandard.ZstdCompressor(level=3)
        self.held, self.size, self.done, self.table, self.index = [], 0, 0, [], []

    def add(self, page, data: bytes) -> None:
        self.index.append((page, self.uri, len(self.table), self.size, len(data)))
        self.held.append(data)
        self.size += len(data)
        if self.size >= FRAME_BYTES:
            self.flush()

    def flush(self) -> None:
        if self.held:
            packed = self.packer.compress(b"".join(self.held))
            self.out.write(packed)
            self.table.append((len(packed), self.size))
            self.done += len(packed)
            self.held, self.size = [], 0

    def close(self) -> pd.DataFrame:
        self.flush()
        entries = b"".join(struct.pack("<II", *x) for x in self.table)
        self.out.write(struct.pack("<II", SKIPPABLE, len(entries) + 9) + entries + struct.pack("<IBI", len(self.table), 0, SEEKABLE))
        self.out.close()
        out = pd.DataFrame(self.index, columns=["page_id", "file", "frame", "offset", "length"])
        return out.astype({"page_id": "Int64"})


def seek_table(source) -> list[tuple[int, int]]:
    """(start, compressed size) of every frame, read from the end of an open file."""
    end = source.size()
    source.seek(end - 9)
    count, _, magic = struct.unpack("<IBI", source.read(9))
    if magic != SEEKABLE:
        raise ValueError("no seek table at the end of the file")
    source.seek(end - 9 - 8 * count)
    sizes = [x[0] for x in struct.iter_unpack("<II", source.read(8 * count))]
    starts = [0]
    for x in sizes:
        starts.append(starts[-1] + x)
    return list(zip(starts, sizes))


def _frames(uri: str, wanted: list[int]) -> Iterator[tuple[int, bytes]]:
    store, path = files.FileSystem.from_uri(uri)
    with store.open_input_file(path) as source:
        table = seek_table(source)
        for n in wanted:
            source.seek(table[n][0])
            yield n, zstandard.ZstdDecompressor().decompress(source.read(table[n][1]))


def write_archives(pages: DataFrame, folder: str, dedup_from: int = 0) -> DataFrame:
    """Write one record per row of ``pages`` (page_id, url, html) below ``folder``; returns the index.

    A null html is an empty payload. Of equal payloads of at least ``dedup_from`` bytes the record of the
    smallest page_id is the response and the others revisit it; shorter ones are all responses. Rows that
    repeat an id and a payload are responses alike; a row without id is a response nobody refers to.
    """
    body = pages.select("page_id", "url", F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
    body = body.withColumns({"bytes": F.length("payload"), "digest": F.sha1("payload"), "check": F.xxhash64("payload")})
    first = body.where(F.col("bytes") >= dedup_from).groupBy("digest", "bytes", "check")
    first = first.agg(F.min("page_id").alias("first"), F.count("*").alias("c")).where("c > 1").drop("c")
    body = body.join(first, ["digest", "bytes", "check"], "left")
    body = body.select("page_id", "url", "payload", "digest", F.when(F.col("page_id") != F.col("first"), F.col("first")).alias("refers_to"))

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, path = files.FileSystem.from_uri(folder)
        store.create_dir(path, recursive=True)
        bundle = None
        for frame in frames:
            for page, url, payload, digest, refers in frame.itertuples(index=False):
                bundle = bundle or Bundle(folder)
                page, refers = (None if pd.isna(x) else int(x) for x in (page, refers))
                b32 = base64.b32encode(bytes.fromhex(digest)).decode()
                bundle.add(page, record(page, url if isinstance(url, str) else None, bytes(payload), b32, refers))
                if bundle.done >= FILE_BYTES:
                    yield bundle.close()
                    bundle = None
        if bundle:
            yield bundle.close()

    # ids travel as text: a column with nulls would become floating point on its way
    body = body.withColumns({"page_id": F.col("page_id").cast("string"), "refers_to": F.col("refers_to").cast("string")})
    return written(body.mapInPandas(write, INDEX), "warc-index")


def read_archives(index: DataFrame) -> DataFrame:
    """Every record of the index (or of the part of it that is given), read from its frame and parsed."""
    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for uri, entries in zip(frame["file"], frame["entries"]):
                places: dict[int, list] = {}
                for e in entries:
                    places.setdefault(e["frame"], []).append((e["offset"], e["length"]))
                for n, data in _frames(uri, sorted(places)):
                    rows = [parse(data[o:o + size]) for o, size in places[n]]
                    out = pd.DataFrame(rows, columns=["page_id", "record_type", "refers_to", "digest", "payload"])
                    yield out.astype({"page_id": "Int64", "refers_to": "Int64"})

    # the frames of a file are dealt out in runs of 16, so that a task holds a bounded list of places; the
    # number of tasks is given, since the index is far smaller than what its rows make a task read
    placed = index.withColumn("run", F.floor(F.col("frame") / 16))
    tasks = max(1, placed.select("file", "run").distinct().count() // RUNS)
    runs = placed.groupBy("file", "run").agg(F.collect_list(F.struct("frame", "offset", "length")).alias("entries"))
    return runs.select("file", "entries").repartition(tasks).mapInPandas(read, RECORDS)


def _base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def round_trip(pages: DataFrame, folder: str | None = None, dedup_from: int = 0) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) per page, from the archives alone.

    Sizes and digests of responses are computed from the payload that was read; a revisit has those of the
    record it refers to. A digest that differs from the record's head fails the read.
    """
    folder = folder or scratch_path(pages.sparkSession, "warc")
    records = read_archives(write_archives(pages, folder, dedup_from))

    def measure(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            sums = [_base32(bytes(p)) for p in frame["payload"]]
            for kind, want, got in zip(frame["record_type"], frame["digest"], sums):
                if kind == "response" and want != got:
                    raise ValueError(f"payload digest {got} where the record says {want}")
            yield frame[["page_id", "record_type", "refers_to", "digest"]].assign(payload_bytes=[len(p) for p in frame["payload"]])

    texts = records.withColumns({c: F.col(c).cast("string") for c in ("page_id", "refers_to")})
    found = texts.mapInPandas(measure, "page_id string, record_type string, refers_to string, digest string, payload_bytes long")
    found = cut(found.withColumns({c: F.col(c).cast("long") for c in ("page_id", "refers_to")}))
    responses = found.where("record_type = 'response'").groupBy(F.col("page_id").alias("r_id"), F.col("digest").alias("r_digest"))
    responses = responses.agg(F.max("payload_bytes").alias("r_bytes"))
    revisits = found.where("record_type = 'revisit'").join(
        responses, (F.col("refers_to") == F.col("r_id")) & (F.col("digest") == F.col("r_digest")), "left")
    rows = found.where("record_type = 'response'").select("page_id", "payload_bytes", "digest", "record_type", "refers_to")
    rows = rows.unionByName(revisits.select("page_id", F.col("r_bytes").alias("payload_bytes"), "digest", "record_type", "refers_to"))
    return rows.withColumnRenamed("digest", "payload_digest")
