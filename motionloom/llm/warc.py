"""Deterministic sharded WARC writer and its reader.

Pages are sorted by (page_id, content hash) and cut into shards of equal numbers at bounds that depend on the
pages alone: quantiles of a sample that is fixed by hash.  A task writes whole shards, each page as one gzip member with
regenerated headers and digests, and starts a new file of the shard when the compressed size passes the limit.  Files
are first written under names of the task attempt; the manifest, a table of the files of the attempts that counted,
is what a second job renames by.  A task or executor lost in between leaves temporary files that no manifest lists.

Equal payloads are found by their digest, with counts combined before the shuffle: the page with the largest id
holds the payload, all others are revisit records that refer to it.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import filesystem, ratio, shared_folder, small_batches, stored

PAGES_PER_SHARD = 4_000
ROLL_BYTES = 64 << 20
SAMPLE_PER_SHARD = 200
FILES_PER_TASK = 2
DATE = "2000-01-01T00:00:00Z"
# Names of the format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = pa.schema([("temporary", pa.string()), ("path", pa.string()), ("shard", pa.int32()), ("part", pa.int32()), ("records", pa.int64()),
                      ("bytes", pa.int64()), ("sha256", pa.string())])
RECORDS = pa.schema([("page_id", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_digest", pa.string()),
                     ("payload_bytes", pa.int64()), ("url", pa.string()), ("payload", pa.binary())])
RECORDS_DDL = "page_id long, record_type string, refers_to long, payload_digest string, payload_bytes long, url string, payload binary"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def _safe(url: str | None) -> str:
    """A URL fit for a header line: control characters, blanks and what is not ASCII are percent-encoded."""
    return "".join(chr(b) if 0x20 < b < 0x7F else f"%{b:02X}" for b in (url or "urn:none").encode())


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One record, uncompressed: a response with its payload, or a revisit with the HTTP headers of the payload."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if not revisit:
        block += payload
    headers = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(page_id, digest)), ("WARC-Date", DATE),
               ("WARC-Target-URI", _safe(url)), ("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}")]
    if page_id is not None:
        headers.append(("X-Page-ID", str(page_id)))
    if revisit:
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to, digest)), ("X-Refers-To-Page-ID", str(refers_to))]
    headers += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers).encode() + b"\r\n"
    return head + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """The fields of RECORDS of one uncompressed record, lengths and digests checked."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.split(b"\r\n")
    headers = dict(line.decode().split(": ", 1) for line in lines)
    length = int(headers["Content-Length"])
    block = rest[:length]
    if version != VERSION or rest[length:] != b"\r\n\r\n" or headers["WARC-Block-Digest"] != f"sha1:{base32_sha1(block)}":
        raise ValueError(f"damaged record {headers.get('WARC-Record-ID')}")
    http, _, payload = block.partition(b"\r\n\r\n")
    promised = int(dict(line.decode().split(": ", 1) for line in http.split(b"\r\n")[1:])["Content-Length"])
    digest, revisit = headers["WARC-Payload-Digest"].removeprefix("sha1:"), headers["WARC-Type"] == "revisit"
    if not revisit and (len(payload) != promised or base32_sha1(payload) != digest):
        raise ValueError(f"damaged payload {headers['WARC-Record-ID']}")
    refers, page = headers.get("X-Refers-To-Page-ID"), headers.get("X-Page-ID")
    return {"page_id": page and int(page), "record_type": headers["WARC-Type"], "refers_to": refers and int(refers), "payload_digest": digest,
            "payload_bytes": promised, "url": headers["WARC-Target-URI"], "payload": None if revisit else payload}


class _Roller:
    """Files of one shard under temporary names."""

    def __init__(self, folder: str, shard: int, attempt: int, roll: int):
        self.folder, self.shard, self.attempt, self.roll = folder, shard, attempt, roll
        self.part, self.out = -1, None

    def add(self, data: bytes) -> dict | None:
        """Write a record; the finished file if this one filled it."""
        if self.out is None:
            self.part += 1
            self.records = self.bytes = 0
            self.digest = hashlib.sha256()
            self.temporary = f"{self.folder}/_temporary/{self.attempt}/{self.shard:06d}-{self.part:04d}.warc.gz"
            fs, place = filesystem(self.temporary)
            fs.create_dir(place.rpartition("/")[0], recursive=True)
            self.out = fs.open_output_stream(place, compression=None)
        member = gzip.compress(data, mtime=0)
        self.out.write(member)
        self.digest.update(member)
        self.records, self.bytes = self.records + 1, self.bytes + len(member)
        return self.close() if self.bytes >= self.roll else None

    def close(self) -> dict | None:
        if self.out is None:
            return None
        self.out.close()
        self.out = None
        return {"temporary": self.temporary, "path": f"{self.folder}/{self.shard:06d}-{self.part:04d}.warc.gz", "shard": self.shard, "part": self.part,
                "records": self.records, "bytes": self.bytes, "sha256": self.digest.hexdigest()}


def described(pages: DataFrame, revisit_from: int = 0) -> DataFrame:
    """``pages`` (page_id, url, html) with payload, hex SHA-1, and for payloads of at least ``revisit_from`` bytes the holder's page_id."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload")).withColumn("sha1", F.sha1("payload"))
    holders = (rows.filter(F.octet_length("payload") >= revisit_from).groupBy("sha1").agg(F.max("page_id").alias("holder"), F.count("*").alias("pages"))
               .filter("pages > 1").select("sha1", "holder"))
    # Written first, so that the planner knows their size and moves payloads for this join only if they are many.
    return rows.join(stored(holders, "holders"), "sha1", "left")


def write(pages: DataFrame, folder: str, roll: int = ROLL_BYTES, per_shard: int = PAGES_PER_SHARD, revisit_from: int = 0) -> DataFrame:
    """Write ``pages`` to ``folder`` and return the manifest, which is also written there.

    A NULL html is an empty payload, a NULL url is written as ``urn:none``.  The holder among equal payloads is the page
    with the largest id; of several rows with that id all are responses.  Pages without an id come first, and are
    responses unless another page holds their payload.  The same pages give the same bytes in files of the same names.
    An empty table gives an empty manifest.
    """
    rows = described(pages, revisit_from).withColumn("tie", F.xxhash64("url", "sha1"))
    shards = ratio(pages.count(), per_shard)
    sample = (pages.select(F.coalesce(F.col("page_id").cast("long"), F.lit(-(1 << 63))).alias("page_id")).distinct()
              .orderBy(F.xxhash64("page_id")).limit(shards * SAMPLE_PER_SHARD).toArrow().column("page_id").to_numpy())
    ordered = np.sort(sample)
    bounds = [int(ordered[len(ordered) * k // shards]) for k in range(1, shards)] if len(ordered) else []

    @F.pandas_udf("int")
    def shard_of(page_id):
        return page_id.map(lambda x: int(np.searchsorted(bounds, x, side="right")) if bounds else 0).astype("int32")

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt, roller = TaskContext.get().taskAttemptId(), None
        for batch in batches:
            done = []
            for row in batch.to_pylist():
                if roller is None or roller.shard != row["shard"]:
                    done.append(roller and roller.close())
                    roller = _Roller(folder, row["shard"], attempt, roll)
                digest = base64.b32encode(bytes.fromhex(row["sha1"])).decode()
                revisit = row["holder"] is not None and row["holder"] != row["page_id"]
                done.append(roller.add(record(row["page_id"], row["url"], row["payload"], digest, row["holder"], revisit)))
            yield pa.RecordBatch.from_pylist([d for d in done if d], schema=MANIFEST)
        last = roller and roller.close()
        yield pa.RecordBatch.from_pylist([last] if last else [], schema=MANIFEST)

    def commit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.select(["temporary", "path"]).to_pylist():
                fs, source = filesystem(row["temporary"])
                if fs.get_file_info(source).is_file:  # a repeated task finds it moved
                    fs.move(source, filesystem(row["path"])[1])
            yield batch

    ddl = "temporary string, path string, shard int, part int, records long, bytes long, sha256 string"
    placed = rows.withColumn("shard", shard_of(F.coalesce("page_id", F.lit(-(1 << 63)))))
    dealt = placed.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "page_id", "tie")
    written = stored(small_batches(dealt.select("shard", "page_id", "url", "payload", "sha1", "holder")).mapInArrow(put, ddl), "written")
    written.repartition(ratio(shards, 4)).mapInArrow(commit, ddl).select("path", "shard", "part", "records", "bytes", "sha256").write.parquet(f"{folder}/manifest")
    return pages.sparkSession.read.parquet(f"{folder}/manifest")


def members(stream) -> Iterator[bytes]:
    """Contents of the gzip members of a stream, holding one at a time."""
    rest, unzip, parts = b"", None, []
    while True:
        rest = rest or stream.read(1 << 20)
        if not rest:
            if unzip is not None:
                raise ValueError("truncated archive")
            return
        unzip = unzip or zlib.decompressobj(31)
        parts.append(unzip.decompress(rest))
        rest = unzip.unused_data
        if unzip.eof:
            yield b"".join(parts)
            unzip, parts = None, []


def read(manifest: DataFrame) -> DataFrame:
    """All records of the files that ``manifest`` lists; a revisit has a NULL payload and the digest and length of the full one."""
    def get(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                fs, place = filesystem(path)
                held, size = [], 0
                with fs.open_input_stream(place, compression=None) as stream:
                    for data in members(stream):
                        held.append(parse(data))
                        size += len(data)
                        if size > 1 << 22:
                            yield pa.RecordBatch.from_pylist(held, schema=RECORDS)
                            held, size = [], 0
                yield pa.RecordBatch.from_pylist(held, schema=RECORDS)

    files = manifest.select("path")
    files = files.repartition(ratio(files.count(), FILES_PER_TASK), "path")  # a number that is given is kept, so even few files are read side by side
    return small_batches(files).mapInArrow(get, RECORDS_DDL)


def written_and_read(pages: DataFrame) -> DataFrame:
    """``pages`` written to archives in the shared folder and read back."""
    return read(write(pages, shared_folder(pages.sparkSession, "warc")))
