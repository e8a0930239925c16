"""WARC archives of pages and their capture index.

write: payload digests decide which record is the response and which revisit it; every task writes
gzip-per-record WARC 1.1 files into the shared folder, named by task attempt, and a stored manifest
names the files of the attempts that counted, so lost executors and retries do no harm.
read: each file is parsed from its first byte to its last; a task leaves one locally sorted run of captures.
merge: the stored runs are dealt by ranges of (URL key, timestamp, page) - ranges of all three, so one
hot URL is split as well - and in each range a loser tree merges the k runs into capture histories.

Null html: empty payload. Null url: no target header, key "". Null page ids get no record id and always
are responses. Rows of one page id and payload repeat their record type. No pages: no rows. Extra columns
are not read. A payload of any length is one record, held whole by one task. Pages bear no capture time: it is page_id seconds after EPOCH.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime, timedelta

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, shared_dir

EPOCH = datetime(2024, 1, 1, tzinfo=UTC)
FILE_BYTES = 32 << 20
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CAPTURE = "url_key string, captured string, page_id long, record_type string, payload_bytes long, payload_digest string, refers_to long, file string, place long, length long"


def filesystem(path: str) -> tuple[fs.FileSystem, str]:
    if re.match(r"file:/|/", path):
        return fs.LocalFileSystem(), re.sub(r"^file:/*", "/", path)
    return fs.FileSystem.from_uri(path)


def url_key(url: str | None) -> str:
    """Host parts reversed, then path and query: keys of one site sort together."""
    m = re.match(r"(?s)(?:[A-Za-z][A-Za-z0-9+.-]*://)?(?:[^/@?#]*@)?([^/:?#]*)(:[0-9]*)?([^#]*)", url or "")
    host, port, rest = m[1].lower(), m[2] or "", m[3]
    if not host:
        return rest
    return ",".join(reversed(host.split("."))) + ("" if port in ("", ":", ":80", ":443") else port) + ")" + (rest or "/")


def _captured(page_id: int | None) -> str:
    return (EPOCH + timedelta(seconds=(page_id or 0) % (1 << 35))).strftime("%Y-%m-%dT%H:%M:%SZ")


def _record_id(page_id: int) -> str:
    return f"<urn:uuid:{uuid.UUID(int=page_id & (1 << 64) - 1)}>"


def _page_id(record_id: str | None) -> int | None:
    if not record_id:
        return None
    n = uuid.UUID(record_id[10:-1]).int
    return n - (1 << 64) if n >> 63 else n


def _safe(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, refers_url: str | None) -> bytes:
    """One record, uncompressed. A revisit keeps the HTTP header and leaves the payload out."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}"]
    if page_id is not None:
        head.append(f"WARC-Record-ID: {_record_id(page_id)}")
    head += [f"WARC-Date: {_captured(page_id)}", f"WARC-Payload-Digest: sha1:{digest}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_safe(url)}")
    if refers_to is not None:
        head += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: {_record_id(refers_to)}", f"WARC-Refers-To-Date: {_captured(refers_to)}"]
        if refers_url is not None:
            head.append(f"WARC-Refers-To-Target-URI: {_safe(refers_url)}")
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def write(pages: DataFrame, smallest: int = 0, key: str = "page_id") -> DataFrame:
    """Write the archives; returns their stored manifest (file, records, bytes)."""
    spark = pages.sparkSession
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col(key).cast("long").alias("page_id"), "url", payload.cast("binary").alias("payload"), F.sha1(payload.cast("binary")).alias("sha1"))
    ids = materialise(rows.where((F.length("payload") >= smallest) & F.col("page_id").isNotNull()).select("page_id", "sha1", "url"))
    least = ids.groupBy("sha1").agg(F.min(F.struct("page_id", "url")).alias("first"))
    again = ids.select("page_id", "sha1").distinct().join(least, "sha1").where(F.col("page_id") > F.col("first.page_id"))
    again = materialise(again.select("page_id", "sha1", F.col("first.page_id").alias("refers_to"), F.col("first.url").alias("refers_url")))
    root = shared_dir(spark)

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        system, base = filesystem(root)
        system.create_dir(base, recursive=True)
        out, done, size, records = None, [], 0, 0
        for batch in batches:
            for r in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if out is None:
                    name = f"{base}/part-{task.partitionId():06d}-{task.taskAttemptId()}-{len(done):04d}.warc.gz"
                    out, size, records = system.open_output_stream(name, compression=None), 0, 0
                page_id, url, content, sha1, refers_to, refers_url = r
                packer = zlib.compressobj(4, zlib.DEFLATED, 31)
                digest = base64.b32encode(bytes.fromhex(sha1)).decode()
                member = packer.compress(record(page_id, url, content, digest, refers_to, refers_url)) + packer.flush()
                out.write(member)
                size, records = size + len(member), records + 1
                if size >= FILE_BYTES:
                    out.close()
                    out = None
                    done.append((name, records, size))
        if out is not None:
            out.close()
            done.append((name, records, size))
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*done, strict=True) if done else ([], [], []), (pa.string(), pa.int64(), pa.int64()), strict=True)], names=["file", "records", "bytes"])

    dealt = rows.join(again, ["page_id", "sha1"], "left").select("page_id", "url", "payload", "sha1", "refers_to", "refers_url")
    return materialise(dealt.mapInArrow(store, "file string, records long, bytes long"))


def members(system: fs.FileSystem, path: str) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, content) of each gzip member, read in pieces."""
    with system.open_input_stream(path, compression=None) as stream:
        rest, offset = b"", 0
        while True:
            unpack, out, used = zlib.decompressobj(31), [], 0
            while not unpack.eof:
                piece = rest or stream.read(1 << 20)
                if not piece:
                    if out or used:
                        raise ValueError(f"{path} ends inside a record")
                    return
                out.append(unpack.decompress(piece))
                used, rest = used + len(piece), unpack.unused_data
            used -= len(rest)
            yield offset, used, b"".join(out)
            offset += used


def parse(content: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = content.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    return fields, rest[: int(fields["Content-Length"])]


def _captures(root_file: str) -> Iterator[tuple]:
    system, path = filesystem(root_file)
    for offset, length, content in members(system, path):
        fields, block = parse(content)
        http, _, payload = block.partition(b"\r\n\r\n")
        kind = fields["WARC-Type"]
        size = int(re.search(rb"(?i)\r\nContent-Length: ([0-9]+)", http)[1])
        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
        if kind == "response" and (size != len(payload) or sha1_base32(payload) != digest):
            raise ValueError(f"{root_file}: the payload at {offset} does not match its digest")
        yield url_key(fields.get("WARC-Target-URI")), fields["WARC-Date"], _page_id(fields.get("WARC-Record-ID")), kind, size, digest, _page_id(fields.get("WARC-Refers-To")), root_file, offset, length


def read(manifest: DataFrame) -> DataFrame:
    """Captures of all files, stored as locally sorted runs, one per archive file."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [f.split()[0] for f in CAPTURE.split(", ")]
        for batch in batches:
            for file in batch["file"]:
                found = sorted(_captures(file), key=_order)
                out = pd.DataFrame(found, columns=names)
                yield out.astype({"page_id": "Int64", "refers_to": "Int64"})

    files = max(1, manifest.count())
    return materialise(manifest.select("file").repartition(min(files, 10_000)).mapInPandas(run, CAPTURE))


def _order(capture: tuple) -> tuple:
    return capture[0], capture[1], capture[2] is not None, capture[2] or 0


def loser_tree(runs: list[list], order) -> Iterator:
    """k sorted runs as one: the tree's inner nodes hold the losers of their matches, so each item costs one path."""
    k = len(runs)
    if not k:
        return
    sources = [iter(r) for r in runs]
    heads = [next(s, None) for s in sources]
    keys = [(h is None, () if h is None else order(h)) for h in heads]
    losers = [-1] * k

    def play(leaf: int) -> int:
        winner, node = leaf, (leaf + k) // 2
        while node:
            if losers[node] == -1:
                losers[node] = winner
                return -1
            if keys[losers[node]] < keys[winner]:
                losers[node], winner = winner, losers[node]
            node //= 2
        return winner

    winner = max(map(play, range(k)))  # all but one leaf wait in a node, as -1 says
    while heads[winner] is not None:
        yield heads[winner]
        heads[winner] = next(sources[winner], None)
        keys[winner] = (heads[winner] is None, () if heads[winner] is None else order(heads[winner]))
        winner = play(winner)


def merge(captures: DataFrame, partitions: int) -> DataFrame:
    """The captures in global order: by partition, and in each by (url_key, captured, page_id).

    The shuffle breaks runs into blocks; Spark's own sort, which can spill, puts them together again. A range's share of the
    runs, `per_range` captures or so, is then merged in memory.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs: list[list] = []
        schema = None
        for batch in batches:
            schema = batch.schema
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if not runs or runs[-1][-1][7] != row[7]:
                    runs.append([])
                runs[-1].append(row)
        if schema is None:
            return
        part: list = []
        for row in loser_tree(runs, _order):
            part.append(row)
            if len(part) == 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part, strict=True), schema, strict=True)], schema=schema)
                part = []
        if part:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part, strict=True), schema, strict=True)], schema=schema)

    dealt = captures.repartitionByRange(partitions, "url_key", "captured", "page_id")
    return dealt.sortWithinPartitions("file", "url_key", "captured", "page_id").mapInArrow(run, CAPTURE)


def archive(pages: DataFrame, smallest: int = 0, per_range: int = 100_000) -> DataFrame:
    """Write the pages' archives, read them back and merge their captures into one ordered index."""
    manifest = write(pages, smallest)
    total = manifest.agg(F.sum("records")).first()[0] or 0
    return merge(read(manifest), max(1, -(-total // per_range)))
