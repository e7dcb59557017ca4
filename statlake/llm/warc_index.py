"""WARC archives with a two-level capture index.

*Archives*: every record is a gzip member of its own in a ``.warc.gz`` file in
the shared folder, so a byte range is a readable record.  Of equal payloads
the smallest id is a response and the others are revisits that refer to it.

*Index*: captures are range-partitioned and sorted by (reversed-host key, id).
Each partition is one file of compressed blocks of ``BLOCK`` captures followed
by a sparse directory, the first capture of every block.  Lookups are sorted
the same way: a task finds the index file among the first captures of all
files (one row per index partition), binary-searches that file's directory,
range-reads one block, binary-searches it, and the record is range-read last.

Files carry a random name per task attempt and are used only if the attempt's
rows were committed, so retried and speculative tasks leave no trace in the
result.

Defined cases: null html is an empty payload; null urls have the key '';
repeated rows of one id are separate records, all responses if that id is the
smallest of its payload; null ids are responses; an empty table gives none.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import json
import uuid
import zlib
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statlake.llm.frames import materialise
from statlake.llm.text import by_slice
from statlake.session import scratch_path

BLOCK = 512
ROLL_BYTES = 1 << 30
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def file_system(uri: str):
    """(file system, path) of a shared folder or file, usable in tasks."""
    from pyarrow import fs

    if uri.startswith(("s3a:", "s3n:")):
        uri = "s3:" + uri.split(":", 1)[1]
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return fs.FileSystem.from_uri(uri)


def surt(url: str | None) -> str:
    """Reversed-host key: http://Blog.example.com/x -> com,example,blog)/x."""
    if not url:
        return ""
    try:
        u = urlsplit(url.strip())
        host, port = (u.hostname or "").lower(), u.port
    except ValueError:
        return url
    tail = f":{port}" if port and port not in (80, 443) else ""
    return ",".join(reversed(host.split("."))) + tail + ")" + (u.path or "/") + (f"?{u.query}" if u.query else "")


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record; ``refers_to`` makes it a revisit without a payload."""
    kind, block = ("response", payload) if refers_to is None else ("revisit", b"")
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
            ("WARC-Target-URI", "".join((url or "").splitlines())), ("WARC-Date", "1970-01-01T00:00:00Z"),
            ("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Payload-Length", str(len(payload)))]
    if refers_to is not None:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    head += [("Content-Type", "text/html"), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    size = int(fields["Content-Length"])
    if rest[size:] != b"\r\n\r\n":
        raise ValueError("record length does not match")
    return fields, rest[:size]


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _packed(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Payloads compressed for the way to the writer, with their digests."""
    payloads = [(h or "").encode("utf-8") for h in batch.column("text").to_pylist()]
    return pa.RecordBatch.from_arrays(
        [batch.column("page_id"), batch.column("url"), pa.array([sha1_base32(p) for p in payloads], pa.string()),
         pa.array([hashlib.sha256(p).digest() for p in payloads], pa.binary()),
         pa.array([len(p) for p in payloads], pa.int64()),
         pa.array([zlib.compress(p, 1) for p in payloads], pa.binary())],
        ["page_id", "url", "digest", "content", "size", "packed"])


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0, id_col: str = "page_id",
                   url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write all records below ``folder``; the captures: key, page_id, file, offset, length."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.col(html_col).cast("string").alias("text"))
    packed = rows.mapInArrow(by_slice(_packed), "page_id long, url string, digest string, content binary, "
                                                "size long, packed binary")
    # payload identity on small rows only; hot payloads combine before the shuffle
    light = rows.select("page_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("content"),
                        F.octet_length(F.coalesce("text", F.lit(""))).alias("size")).where(f"size >= {int(min_bytes)}")
    first = (light.groupBy("content").agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
             .where("n > 1").drop("n"))
    # a page id may come with several payloads: each has its own verdict
    revisits = (light.join(first, "content").where("page_id > refers_to")
                .select("page_id", F.unhex("content").alias("content"), "refers_to").distinct())
    revisits = materialise(revisits, "revisits")

    def write(batches):
        fs, root = file_system(folder)
        fs.create_dir(root, recursive=True)
        out, name, at = None, None, 0
        for b in batches:
            done = []
            for r in b.to_pylist():
                if out is None or at >= ROLL_BYTES:
                    if out is not None:
                        out.close()
                    name, at = f"records-{uuid.uuid4().hex}.warc.gz", 0
                    out = fs.open_output_stream(f"{root}/{name}", compression=None)
                member = gzip.compress(record(r["page_id"], r["url"], zlib.decompress(r["packed"]), r["digest"],
                                              r["refers_to"]), 6, mtime=0)
                out.write(member)
                done.append((surt(r["url"]), r["page_id"], name, at, len(member)))
                at += len(member)
            if done:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*done), (pa.string(), pa.int64(), pa.string(), pa.int64(),
                                                                 pa.int64()))],
                    ["key", "page_id", "file", "offset", "length"])
        if out is not None:
            out.close()

    captures = (packed.select("page_id", "url", "digest", "content", "packed").join(revisits, ["page_id", "content"], "left")
                .mapInArrow(write, "key string, page_id long, file string, offset long, length long"))
    return materialise(captures, "captures")


def _order(key: str, page_id: int | None) -> tuple[bytes, int]:
    return key.encode("utf-8"), -2**63 if page_id is None else page_id


def _by_key(df: DataFrame) -> DataFrame:
    # Spark orders strings by their UTF-8 bytes and nulls first, as _order does
    return df.repartitionByRange("key", "page_id").sortWithinPartitions("key", "page_id")


def write_index(captures: DataFrame, folder: str) -> DataFrame:
    """Index files below ``folder``; one row per file: first_key, first_id, file,
    directory_at, directory_length, captures."""
    def write(batches):
        fs, root = file_system(folder)
        fs.create_dir(root, recursive=True)
        name, out, at, n, directory, block = f"captures-{uuid.uuid4().hex}.cdx", None, 0, 0, [], []

        def flush():
            nonlocal at, out, n
            if out is None:
                out = fs.open_output_stream(f"{root}/{name}", compression=None)
            raw = zlib.compress(json.dumps(block).encode())
            out.write(raw)
            directory.append([*block[0][:2], at, len(raw)])
            at, n = at + len(raw), n + len(block)
            block.clear()

        for b in batches:
            for r in b.to_pylist():
                block.append([r["key"], r["page_id"], r["file"], r["offset"], r["length"]])
                if len(block) == BLOCK:
                    flush()
        if block:
            flush()
        if out is not None:
            raw = zlib.compress(json.dumps(directory).encode())
            out.write(raw)
            out.close()
            yield pa.RecordBatch.from_pylist(
                [{"first_key": directory[0][0], "first_id": directory[0][1], "file": name, "directory_at": at,
                  "directory_length": len(raw), "captures": n}],
                schema=pa.schema([("first_key", pa.string()), ("first_id", pa.int64()), ("file", pa.string()),
                                  ("directory_at", pa.int64()), ("directory_length", pa.int64()),
                                  ("captures", pa.int64())]))

    return materialise(_by_key(captures.select("key", "page_id", "file", "offset", "length"))
                       .mapInArrow(write, "first_key string, first_id long, file string, directory_at long, "
                                          "directory_length long, captures long"), "index-files")


class IndexFile:
    """An open index file: its directory, and one block at a time."""

    def __init__(self, fs, path: str, directory_at: int, directory_length: int):
        self.source, self.place = fs.open_input_file(path), None
        self.directory = self.read(directory_at, directory_length)
        self.starts = [_order(d[0], d[1]) for d in self.directory]

    def read(self, at: int, length: int) -> list:
        self.source.seek(at)
        return json.loads(zlib.decompress(self.source.read(length)))

    def find(self, this: tuple[bytes, int]) -> list[tuple[str, int, int]]:
        """Places (file, offset, length) of the captures with exactly this key and id."""
        out, j = [], max(0, bisect.bisect_left(self.starts, this) - 1)
        while j < len(self.starts) and self.starts[j] <= this:
            if self.place != j:
                self.rows, self.place = self.read(*self.directory[j][2:]), j
                self.keys = [_order(x[0], x[1]) for x in self.rows]
            at = bisect.bisect_left(self.keys, this), bisect.bisect_right(self.keys, this)
            out += [tuple(x[2:]) for x in self.rows[slice(*at)]]
            j += 1
        return out


def locate(wanted: DataFrame, index: DataFrame, folder: str) -> DataFrame:
    """``wanted`` (key, page_id) with the places of all its captures: file, offset, length."""
    files = sorted(((_order(r.first_key, r.first_id), r.file, r.directory_at, r.directory_length)
                    for r in index.collect()))   # one row per index partition
    shared = wanted.sparkSession.sparkContext.broadcast(files)

    def search(batches):
        fs, root = file_system(folder)
        files, at, opened = shared.value, None, None
        firsts = [f[0] for f in files]
        for b in batches:
            out = []
            for key, page_id in zip(b.column("key").to_pylist(), b.column("page_id").to_pylist()):
                this = _order(key, page_id)
                k = max(0, bisect.bisect_left(firsts, this) - 1)
                while k < len(files) and firsts[k] <= this:
                    if at != k:
                        if opened is not None:
                            opened.source.close()
                        at, opened = k, IndexFile(fs, f"{root}/{files[k][1]}", *files[k][2:])
                    out += [(key, page_id, *place) for place in opened.find(this)]
                    k += 1
            if out:
                kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)],
                                                 ["key", "page_id", "file", "offset", "length"])

    return _by_key(wanted.select("key", "page_id").distinct()).mapInArrow(
        search, "key string, page_id long, file string, offset long, length long")


def read_records(places: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """Range-read the records: page_id, url, payload_bytes, payload_digest,
    record_type, refers_to and, if asked for, payload."""
    def read(batches):
        fs, root = file_system(folder)
        name, source = None, None
        for b in batches:
            out = []
            for r in b.select(["file", "offset", "length"]).to_pylist():
                if r["file"] != name:
                    if source is not None:
                        source.close()
                    name, source = r["file"], fs.open_input_file(f"{root}/{r['file']}")
                source.seek(r["offset"])
                fields, block = parse(gzip.decompress(source.read(r["length"])))
                kind, target = fields["WARC-Type"], fields.get("WARC-Refers-To")
                own = fields["WARC-Record-ID"][len("<urn:page:"):-1]
                if kind == "response":
                    digest, size = sha1_base32(block), len(block)
                    if f"sha1:{digest}" != fields["WARC-Payload-Digest"]:
                        raise ValueError(f"payload digest of {own} does not match")
                else:
                    digest, size = fields["WARC-Payload-Digest"][5:], int(fields["X-Payload-Length"])
                out.append((int(own) if own else None, fields["WARC-Target-URI"], size, digest, kind,
                            int(target[len("<urn:page:"):-1]) if target else None, block))
            if out:
                cols = [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.string(), pa.int64(), pa.string(),
                                                                   pa.string(), pa.int64(), pa.binary()))]
                names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
                yield pa.RecordBatch.from_arrays(cols[:None if with_payload else -1],
                                                 names[:None if with_payload else -1])

    return (places.repartitionByRange("file", "offset").sortWithinPartitions("file", "offset")
            .mapInArrow(read, "page_id long, url string, payload_bytes long, payload_digest string, "
                              "record_type string, refers_to long" + (", payload binary" if with_payload else "")))


def archive_and_read(pages: DataFrame, min_bytes: int = 0, folder: str | None = None) -> DataFrame:
    """Write the archives and their index, then look every capture up and read it back."""
    folder = folder or scratch_path(pages.sparkSession, "warc")
    captures = write_archives(pages, folder, min_bytes)
    index = write_index(captures, folder)
    return read_records(locate(captures, index, folder), folder)
