"""WARC archives: a deterministic sharded writer and a reader.

Records are range-sorted by key. Range bounds come from keys picked by hash, so the same rows give the same shards on
any cluster. Each task writes its shard as gzip members, one a record, into files under temporary names and starts a new
file when the compressed size reaches ``roll_bytes``. A manifest lists the files of the attempts that succeeded; files are then
moved to their final names and the manifest is written last, so a reader of the manifest never sees half a write and a
lost or repeated task leaves nothing behind. Headers, lengths and digests are made anew from the payload.

Copies: of equal payloads the one with the least key is a ``response``, the others are ``revisit`` records without payload.
The decision is made on (key, digest) rows alone and meets the payload in the sort, which is the one shuffle of payloads.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm import storage

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Keys looked at for each bound between shards.
KEYS_PER_SHARD = 32


def base32_sha1(column) -> F.Column:
    """Bare upper-case base32 of the SHA-1 of a binary column: 4 groups of 40 bits, 8 characters each."""
    digits = F.sha1(column)
    groups = [F.lpad(F.conv(F.substring(digits, at, 10), 16, 32), 8, "0") for at in (1, 11, 21, 31)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record_id(key, digest: str, copy: int = 0) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{key}:{digest}:{copy}')}>"


def _member(headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + f"Content-Length: {len(block)}\r\n\r\n"
    press = zlib.compressobj(6, zlib.DEFLATED, 31)
    return press.compress(head.encode() + block + b"\r\n\r\n") + press.flush()


def _address(url: str | None, key) -> str:
    return re.sub(r"[\x00-\x20\x7f-\x9f]", lambda m: f"%{ord(m[0]):02X}", url) if url else f"urn:page:{key}"


class _Files:
    """The files of one shard, opened one after another."""

    def __init__(self, folder: str, shard: int, roll_bytes: int, date: str):
        self.fs, self.root = pafs.FileSystem.from_uri(folder)
        self.folder, self.shard, self.roll, self.date = folder, shard, roll_bytes, date
        self.seq, self.out, self.done = 0, None, []

    def write(self, member: bytes, key) -> None:
        if self.out is None:
            self.temporary = f"_temporary/{self.shard:06d}-{self.seq:05d}-{uuid.uuid4().hex}"
            self.fs.create_dir(f"{self.root}/_temporary", recursive=True)
            self.out, self.bytes, self.records, self.hash, self.first = self.fs.open_output_stream(f"{self.root}/{self.temporary}", compression=None), 0, 0, hashlib.sha1(), key
            name = f"part-{self.shard:06d}-{self.seq:05d}.warc.gz"
            info = b"software: riskloom\r\nformat: WARC File Format 1.1\r\n"
            self._put(_member([("WARC-Type", "warcinfo"), ("WARC-Record-ID", _record_id(name, "warcinfo")), ("WARC-Date", self.date), ("WARC-Filename", name), ("Content-Type", "application/warc-fields")], info))
        self._put(member)
        self.records, self.last = self.records + 1, key
        if self.bytes >= self.roll:
            self.close()

    def _put(self, member: bytes) -> None:
        self.out.write(member)
        self.hash.update(member)
        self.bytes += len(member)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.done.append((f"part-{self.shard:06d}-{self.seq:05d}.warc.gz", self.temporary, self.records, self.bytes, self.hash.hexdigest(), self.first, self.last))
            self.seq, self.out = self.seq + 1, None


MANIFEST = "name string, temporary string, records long, bytes long, sha1 string, first_key long, last_key long"
_ARROW = pa.schema([("name", pa.string()), ("temporary", pa.string()), ("records", pa.int64()), ("bytes", pa.int64()), ("sha1", pa.string()), ("first_key", pa.int64()), ("last_key", pa.int64())])


def write_warc(pages: DataFrame, folder: str, shard_bytes: int = 64 << 20, roll_bytes: int = 8 << 20, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write ``pages`` (page_id, url, html; other columns are not looked at) to ``folder`` and return the manifest.

    A null html is an empty payload, a null url becomes ``urn:page:<id>``, control characters in it are escaped. A null page_id
    sorts first; such a record is never what others refer to. Repeated rows are records of their own: the first is the
    response, the others revisit it. An empty table writes no file and gives an empty manifest.
    """
    spark = pages.sparkSession
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"),
    )
    total = rows.agg(F.count("*").alias("n"), F.sum(F.octet_length("payload")).alias("bytes")).first()
    shards = max(1, -(-(total.bytes or 0) // shard_bytes))
    every = max(1, total.n // (shards * KEYS_PER_SHARD))
    picked = rows.select("page_id").where(F.col("page_id").isNotNull() & (F.pmod(F.xxhash64("page_id"), F.lit(every)) == 0)).toPandas()
    keys = np.sort(picked["page_id"].to_numpy(np.int64))
    bounds = keys[np.arange(1, shards) * len(keys) // shards] if len(keys) else np.zeros(0, np.int64)
    shared = spark.sparkContext.broadcast(bounds)

    @F.pandas_udf("int")
    def shard_of(key: pd.Series) -> pd.Series:
        at = np.searchsorted(shared.value, key.fillna(-(1 << 63)).to_numpy(np.int64), "right")
        return pd.Series(at.astype(np.int32))

    rows = rows.withColumn("digest", base32_sha1(F.col("payload")))
    narrow = rows.select("page_id", "digest")
    first = narrow.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1 AND refers_to IS NOT NULL")
    marks = narrow.join(first.select("digest", "refers_to"), "digest").select("page_id", "digest", F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload"), "refers_to")
    both = rows.select("page_id", "digest", "url", "payload", F.lit(None).cast("long").alias("refers_to")).union(marks)
    placed = both.withColumn("shard", shard_of("page_id")).repartitionById(shards, "shard")
    placed = placed.sortWithinPartitions("shard", "page_id", "digest", F.col("payload").isNotNull(), "url")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, same, refers, copy = None, None, None, 0
        for batch in batches:
            for key, digest, url, payload, mark, shard in zip(*(batch.column(c) for c in ("page_id", "digest", "url", "payload", "refers_to", "shard"))):
                key, digest, shard = key.as_py(), digest.as_py(), shard.as_py()
                if files is None or files.shard != shard:
                    if files is not None:
                        files.close()
                        yield _manifest(files)
                    files = _Files(folder, shard, roll_bytes, date)
                if same != (key, digest):
                    same, refers, copy = (key, digest), None, 0
                if mark.is_valid:
                    refers = mark.as_py()
                    continue
                files.write(_record(key, digest, url.as_py(), payload.as_py(), None if refers == key and not copy else refers, copy, date), key)
                copy += 1
        if files is not None:
            files.close()
            yield _manifest(files)

    made = storage.stored(placed.select("page_id", "digest", "url", "payload", "refers_to", "shard").mapInArrow(run, MANIFEST), "warc-manifest")
    final = f"{folder}/_manifest"
    made.repartition(max(1, min(shards, 200)), "name").mapInArrow(lambda b: _move(b, folder), MANIFEST).write.parquet(final)
    return spark.read.schema(made.schema).parquet(final)


def _manifest(files: _Files) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([dict(zip(_ARROW.names, x)) for x in files.done], schema=_ARROW)


def _record(key, digest: str, url, payload: bytes, refers_to, copy: int, date: str) -> bytes:
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    kind = "revisit" if refers_to is not None else "response"
    headers = [("WARC-Type", kind), ("WARC-Record-ID", _record_id(key, digest, copy)), ("WARC-Date", date), ("WARC-Target-URI", _address(url, key))]
    if refers_to is not None:
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _record_id(refers_to, digest)), ("X-Refers-To-Page", str(refers_to))]
    if key is not None:
        headers.append(("X-Page", str(key)))
    headers += [("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Block-Digest", f"sha1:{_digest(block)}"), ("Content-Type", "application/http;msgtype=response")]
    return _member(headers, block)


def _move(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    """Final names for the files of a manifest. A repeated task finds some moved already."""
    fs, root = pafs.FileSystem.from_uri(folder)
    for batch in batches:
        for row in batch.to_pylist():
            if fs.get_file_info(f"{root}/{row['temporary']}").type != pafs.FileType.NotFound:
                fs.move(f"{root}/{row['temporary']}", f"{root}/{row['name']}")
            elif fs.get_file_info(f"{root}/{row['name']}").size != row["bytes"]:
                raise OSError(f"{row['name']} is missing or not whole")
        yield batch


def _records(stream, step: int = 1 << 20) -> Iterator[bytes]:
    """The gzip members of a stream, one at a time."""
    data = stream.read(step)
    while data:
        member, parts = zlib.decompressobj(31), []
        while not member.eof:
            parts.append(member.decompress(data))
            data = member.unused_data if member.eof else stream.read(step)
            if not member.eof and not data:
                raise EOFError("an archive ends within a record")
        data = data or stream.read(step)
        yield b"".join(parts)


RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary"


def read_warc(manifest: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """The response and revisit records of the files of a manifest; a wrong digest raises.

    ``payload_bytes`` and ``payload_digest`` are those of the full payload, for a revisit as its headers carry them; its ``payload`` is null.
    """
    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()), ("payload", pa.binary())])

    def run(batches):
        fs, root = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch.column("name").to_pylist():
                rows, held = [], 0
                with fs.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    for record in _records(stream):
                        row = _parsed(record, payloads)
                        if row:
                            rows.append(row)
                            held += len(row["payload"] or b"")
                        if len(rows) >= 2000 or held > 8 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    n = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return manifest.select("name").repartition(n, "name").mapInArrow(run, RECORD)


def _parsed(record: bytes, payloads: bool) -> dict | None:
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    if fields["WARC-Type"] == "warcinfo":
        return None
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest, kind = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"]
    if _digest(block) != fields["WARC-Block-Digest"].removeprefix("sha1:") or kind == "response" and (_digest(payload) != digest or len(payload) != length):
        raise ValueError(f"digest of record {fields['WARC-Record-ID']} is wrong")
    number = lambda k: int(fields[k]) if k in fields else None
    return {
        "page_id": number("X-Page"), "payload_bytes": length, "payload_digest": digest, "record_type": kind, "refers_to": number("X-Refers-To-Page"),
        "url": fields["WARC-Target-URI"], "payload": payload if payloads and kind == "response" else None,
    }
