"""WARC archives with a two-level capture index.

Writing: every record becomes one gzip member of a ``.warc.gz`` file; a task
writes one file under a name of its own attempt, and only names returned by
successful tasks are used, so a lost or repeated task can't be read by mistake.
Of records with equal payloads the smallest id is a ``response``, the others are
``revisit`` records without payload that name it.

Index (level two): captures sorted by reversed-host URL key (``com,example)/path``)
and id, in compressed blocks of ``BLOCK`` entries. Directory (level one): the
first key, place and length of each block, beside the range's bounds. A lookup
binary-searches the ranges' bounds, then a range's directory, reads that one
block by its byte range, binary-searches it, and reads the record by its range.

Files are reached through Arrow file systems by URI, so the folder may be any
shared store that Arrow can open.

Defined cases: null html = empty payload; null url = the empty key; payloads
below ``min_payload`` bytes are never revisits; repeated ids (and null ids) are
told apart by row; equal urls are ordered by id; an empty table gives none.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import re
import uuid
import zlib
from functools import lru_cache
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlake.llm.text import saved, scratch

BLOCK = 256
CRLF = b"\r\n"


def url_key(url: str | None) -> str:
    """Reversed-host key: host labels from the top, ``)``, path and query; the
    scheme, a leading ``www.``, the default port and the fragment don't count. Tabs and
    line feeds are escaped here, before keys are sorted, as index lines hold them so."""
    return _key(url).replace("\t", "%09").replace("\n", "%0A") if url else ""


def _key(url: str) -> str:
    try:
        parts = urlsplit(url.strip())
        host, port = (parts.hostname or "").rstrip("."), parts.port
    except ValueError:
        return url
    if not host:
        return url
    host = re.sub(r"^www\d*\.", "", host)
    key = ",".join(reversed(host.split(".")))
    if port and port != {"http": 80, "https": 443}.get(parts.scheme):
        key += f":{port}"
    return key + ")" + (parts.path or "/").lower() + ("?" + parts.query.lower() if parts.query else "")


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload, usedforsecurity=False).digest()).decode()


def _store(uri: str) -> tuple[pafs.FileSystem, str]:
    uri = re.sub(r"^file:/(?!/)", "file:///", uri)
    return pafs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}")


def record_id(page_id: int | None, digest: str) -> str:
    """Id of the record of a page with that payload (rows that repeat both share it)."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {digest}')}>"


def record_bytes(page_id, url: str | None, payload: bytes, digest: str, size: int, refers_to: int | None,
                 revisit: bool) -> bytes:
    """One WARC/1.1 record (not compressed); ``digest`` and ``size`` are the full
    payload's, which a revisit doesn't hold."""
    uri = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "urn:none")
    block = b"" if revisit else b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + payload
    head = [("WARC-Type", "revisit" if revisit else "response"),
            ("WARC-Record-ID", record_id(page_id, digest)),
            ("WARC-Date", "2024-01-01T00:00:00Z"), ("WARC-Target-URI", uri),
            ("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Payload-Length", str(size)),
            ("X-Page-ID", "" if page_id is None else str(page_id)),
            ("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    if revisit:
        head += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                 ("WARC-Refers-To", record_id(refers_to, digest)), ("X-Refers-To-Page-ID", str(refers_to))]
    lines = "".join(f"{k}: {v}\r\n" for k, v in head).encode()
    return b"WARC/1.1" + CRLF + lines + CRLF + block + CRLF + CRLF


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """(headers, block) of one uncompressed record."""
    head, _, rest = raw.partition(CRLF + CRLF)
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    return fields, rest[: int(fields["Content-Length"])]


ENTRY = "key string, page_id long, file string, offset long, length long"


def write_archives(df: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   min_payload: int = 0) -> DataFrame:
    """Write one WARC file per task; the capture entries (key, page_id, file,
    offset, length), kept as a table so that they are written once."""
    pages = df.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").alias("url"),
                      F.col(f"`{html_col}`").alias("html"))
    payload = F.coalesce("html", F.lit("")).cast("binary")
    pages = pages.withColumn("digest", F.sha1(payload)).withColumn("size", F.octet_length(payload).cast("long"))
    first = pages.select("page_id", "digest", "size").groupBy("digest", "size").agg(F.min("page_id").alias("first_id"))
    again = F.coalesce((F.col("size") >= min_payload) & (F.col("page_id") > F.col("first_id")), F.lit(False))
    rows = pages.join(first, ["digest", "size"]).select("page_id", "url", "digest", "size", again.alias("again"),
                       F.when(again, F.col("first_id")).alias("refers_to"), F.when(~again, F.col("html")).alias("html"))

    def write(it):
        task = TaskContext.get()
        name = f"part-{task.partitionId():05d}-{uuid.uuid4().hex[:12]}.warc.gz"
        store, base = _store(folder)
        out, at = None, 0
        for b in it:
            if not b.num_rows:
                continue
            if out is None:
                store.create_dir(base, recursive=True)
                out = store.open_output_stream(f"{base}/{name}", compression=None)
            entries = []
            for r in b.to_pylist():
                payload = (r["html"] or "").encode("utf-8", "surrogatepass")
                digest = base64.b32encode(bytes.fromhex(r["digest"])).decode()
                member = gzip.compress(record_bytes(r["page_id"], r["url"], payload, digest, r["size"], r["refers_to"],
                                                    r["again"]), 6, mtime=0)
                out.write(member)
                entries.append((url_key(r["url"]), r["page_id"], name, at, len(member)))
                at += len(member)
            cols = zip(*entries, strict=True)
            kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)],
                                             ["key", "page_id", "file", "offset", "length"])
        if out is not None:
            out.close()

    return saved(rows.mapInArrow(write, ENTRY), "captures")


# --- index ------------------------------------------------------------------

def _line(key, page_id, file, offset, length) -> str:
    return "\t".join((key, "" if page_id is None else str(page_id), file,
                      str(offset), str(length)))


def _sort_key(key: str, page_id, file: str, offset: int) -> tuple:
    return key, page_id is not None, page_id or 0, file, offset


def build_index(entries: DataFrame, folder: str, block: int = BLOCK) -> list[tuple[tuple, str, int, int]]:
    """Sort the captures by key into compressed blocks and write each range's
    directory. Returns the ranges (first sort key, name, directory offset and
    length): one row per task, whatever the number of captures."""
    parts = int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = entries.repartitionByRange(parts, "key", "page_id", "file", "offset") \
        .sortWithinPartitions("key", "page_id", "file", "offset")

    def write(it):
        name = f"range-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex[:12]}.cdxz"
        store, base = _store(folder)
        out, at, waiting, directory = None, 0, [], []

        def flush():
            nonlocal at, waiting
            raw = zlib.compress("\n".join(_line(*w) for w in waiting).encode("utf-8", "surrogatepass"), 6)
            out.write(raw)
            directory.append((_sort_key(*waiting[0][:4]), at, len(raw)))
            at += len(raw)
            waiting = []

        for b in it:
            for w in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if out is None:
                    store.create_dir(base, recursive=True)
                    out = store.open_output_stream(f"{base}/{name}", compression=None)
                waiting.append(w)
                if len(waiting) == block:
                    flush()
        if out is None:
            return
        if waiting:
            flush()
        lines = "\n".join("\t".join((_line(k[0], k[2] if k[1] else None, k[3], k[4], 0), str(o), str(n)))
                          for k, o, n in directory)
        raw = zlib.compress(lines.encode("utf-8", "surrogatepass"), 6)
        out.write(raw)
        out.close()
        k = directory[0][0]
        yield pa.RecordBatch.from_pydict({"key": [k[0]], "page_id": [k[2] if k[1] else None], "file": [k[3]],
                                          "offset": [k[4]], "name": [name], "at": [at], "size": [len(raw)]},
                                         schema=pa.schema([("key", pa.string()), ("page_id", pa.int64()), ("file", pa.string()),
                                                           ("offset", pa.int64()), ("name", pa.string()), ("at", pa.int64()),
                                                           ("size", pa.int64())]))
    made = rows.mapInArrow(write, "key string, page_id long, file string, offset long, name string, at long, size long")
    return sorted((_sort_key(r.key, r.page_id, r.file, r.offset), r.name, r.at, r["size"]) for r in saved(made, "ranges").collect())


class Reader:
    """Lookups against the index and range reads of records, inside a task."""

    def __init__(self, archives: str, index: str, ranges: list):
        self.store, self.archives = _store(archives)
        self.index = _store(index)[1]
        self.ranges, self.starts = ranges, [r[0] for r in ranges]
        self._directory = lru_cache(64)(self._directory)
        self._block = lru_cache(256)(self._block)
        self._open = lru_cache(64)(self._open)

    def _open(self, path: str):
        return self.store.open_input_file(path)

    def _read(self, path: str, at: int, size: int) -> bytes:
        return self._open(path).read_at(size, at)

    def _directory(self, i: int):
        _, name, at, size = self.ranges[i]
        rows = [x.split("\t") for x in zlib.decompress(self._read(f"{self.index}/{name}", at, size)).decode("utf-8", "surrogatepass").split("\n")]
        keys = [_sort_key(r[0], int(r[1]) if r[1] else None, r[2], int(r[3])) for r in rows]
        return keys, [(f"{self.index}/{name}", int(r[5]), int(r[6])) for r in rows]

    def _block(self, path: str, at: int, size: int):
        rows = [x.split("\t") for x in zlib.decompress(self._read(path, at, size)).decode("utf-8", "surrogatepass").split("\n")]
        keys = [_sort_key(r[0], int(r[1]) if r[1] else None, r[2], int(r[3])) for r in rows]
        return keys, rows

    def lookup(self, key: str, page_id: int | None) -> list[tuple[str, int, int]]:
        """(file, offset, length) of all captures of a url key and id."""
        low = (key, page_id is not None, page_id or 0)
        found: list[tuple[str, int, int]] = []
        i = max(0, bisect.bisect_right(self.starts, low) - 1)
        while i < len(self.ranges) and self.starts[i][:3] <= low:
            keys, places = self._directory(i)
            j = max(0, bisect.bisect_right(keys, low) - 1)
            while j < len(keys) and keys[j][:3] <= low:
                entries, rows = self._block(*places[j])
                n = bisect.bisect_left(entries, low)
                while n < len(entries) and entries[n][:3] == low:
                    found.append((rows[n][2], int(rows[n][3]), int(rows[n][4])))
                    n += 1
                j += 1
            i += 1
        return found

    def record(self, file: str, offset: int, length: int) -> tuple[dict[str, str], bytes]:
        return parse_record(gzip.decompress(self._read(f"{self.archives}/{file}", offset, length)))


def read_captures(wanted: DataFrame, archives: str, index: str, ranges: list, strict: bool = False) -> DataFrame:
    """Look up every (key, page_id) of ``wanted`` through the index and read its
    records: (page_id, url, payload_bytes, payload_digest, record_type, refers_to,
    file, offset). Repeated requests are answered once; one without a capture gives
    no row, ``strict`` makes it an error."""
    parts = int(wanted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = wanted.select("key", "page_id").distinct().repartitionByRange(parts, "key", "page_id") \
        .sortWithinPartitions("key", "page_id")
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
                        ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                        ("file", pa.string()), ("offset", pa.int64())])

    def run(it):
        reader = Reader(archives, index, ranges)
        for b in it:
            out = []
            for key, page_id in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                places = reader.lookup(key, page_id)
                if strict and not places:
                    raise KeyError(f"no capture of {key!r}, page {page_id}")
                for file, offset, length in places:
                    head, block = reader.record(file, offset, length)
                    digest, size = head["WARC-Payload-Digest"].removeprefix("sha1:"), int(head["X-Payload-Length"])
                    if head["WARC-Type"] == "response":
                        payload = block.partition(CRLF + CRLF)[2]
                        if payload_digest(payload) != digest or len(payload) != size:
                            raise ValueError(f"damaged record at {file}:{offset}")
                    refers = head.get("X-Refers-To-Page-ID")
                    out.append((int(head["X-Page-ID"]) if head["X-Page-ID"] else None, head["WARC-Target-URI"], size, digest,
                                head["WARC-Type"], int(refers) if refers else None, file, offset))
            cols = list(zip(*out, strict=True)) or [[]] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, schema.types, strict=True)], schema=schema)

    return keys.mapInArrow(run, "page_id long, url string, payload_bytes long, payload_digest string, "
                                "record_type string, refers_to long, file string, offset long")


def round_trip(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
               min_payload: int = 0) -> DataFrame:
    """Write the archives and the index, then read every capture back through it."""
    spark = df.sparkSession
    archives, index = scratch(spark, "warc"), scratch(spark, "warc-index")
    entries = write_archives(df, archives, id_col, url_col, html_col, min_payload)
    ranges = build_index(entries, index)
    return read_captures(entries, archives, index, ranges, strict=True)

