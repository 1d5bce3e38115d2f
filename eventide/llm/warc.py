"""Web archives (WARC) with a two-level capture index.

Pages are range-partitioned by (reversed-host URL key, page_id) and sorted;
each task writes one WARC file, one gzip member per record, and one index
file: its captures' lines, sorted by key, in blocks of ``BLOCK_LINES`` lines,
each block a gzip member.  The sparse directory holds one entry per block
(first key, file, offset, length).  A lookup finds the file by binary search
over the files' first keys, the block by binary search over the directory,
reads that block, and range-reads the record.

Payloads equal to each other and of at least ``min_revisit`` bytes are stored
once: the capture with the largest page_id is the response, the others are
revisit records that refer to it.  Equality is that of SHA-256 digests.

Defined results
    null payload        empty, 0 bytes
    null or empty url   key ")/" ; the record has an empty target URI
    null page_id        written with an empty record name; a numbered page with the same payload is the
                        response, without one each such row is a response
    repeated rows       each gets a record of its own, of the same type
    empty table         no file, an empty result
    extra columns       ignored
    very long payloads  stored whole
"""

from __future__ import annotations

import bisect
import gzip
import hashlib
import json
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import publish, reading_tasks, store, text_or_empty, written
from eventide.session import shared_path

BLOCK_LINES = 300
MIN_REVISIT = 1_000
#: A task closes its archive at the first record past so many bytes.
ARCHIVE_BYTES = 256 << 20
#: Records that one task reads back.
READ_RECORDS = 500_000

_MANIFEST = "warc string, index string, first string, last string, captures long"


def url_key(url: str | None) -> str:
    """Reversed-host key: ``http://www.a.example/x?q`` -> ``example,a,www)/x?q``."""
    try:
        parts = urlsplit((url or "").strip())
        host = parts.hostname or ""
        port = f":{parts.port}" if parts.port and parts.port not in (80, 443) else ""
    except ValueError:
        return f"{(url or '').strip()})/"
    path = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    return f"{','.join(reversed(host.split('.')))}{port}){path}"


def record(page_id: int | None, url: str | None, payload: bytes, kind: str, refers_to: int | None,
           digest: str) -> bytes:
    """One WARC/1.1 record."""
    body = payload if kind == "response" else b""
    head = ["WARC/1.1", f"WARC-Type: {'resource' if kind == 'response' else 'revisit'}",
            f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
            "WARC-Date: 1970-01-01T00:00:00Z",
            "WARC-Target-URI: " + (url or "").replace("\r", "%0D").replace("\n", "%0A"),
            f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: text/html; charset=utf-8",
            f"X-Payload-Length: {len(payload)}", f"X-Capture-Type: {kind}"]
    if refers_to is not None:
        head.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    head.append(f"Content-Length: {len(body)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """(headers, payload) of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    headers = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    return headers, rest[:int(headers["Content-Length"])]


def _line(key: str, page_id: int | None, offset: int, length: int) -> str:
    return json.dumps([key, page_id, offset, length], ensure_ascii=False, separators=(",", ":"))


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
                   payload_col: str = "html", min_revisit: int = MIN_REVISIT,
                   archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write all pages; return the manifest of archives (a written table)."""
    base = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"),
                        text_or_empty(payload_col).alias("html"))
    keyed = base.withColumn("sha", F.sha2("html", 256)).withColumn("n", F.octet_length("html"))
    # Only payloads that occur more than once need a join; counts are combined before the shuffle.
    again = (keyed.where(F.col("n") >= min_revisit).groupBy("sha")
             .agg(F.max("id").alias("response"), F.count(F.lit(1)).alias("seen")).where("seen > 1").drop("seen"))
    again = written(again, "warc-repeats")
    full = keyed.join(again, "sha", "left").withColumn("key", _key_udf()("url"))
    full = full.select("key", "id", "url", "html", "response")
    ordered = (full.repartitionByRange("key", F.col("id").asc_nulls_first())
               .sortWithinPartitions("key", F.col("id").asc_nulls_first()))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        # Records go straight to the archive's file; only index lines are held.  Readers know archives
        # by the manifest, which names those of the attempt that succeeds.
        name, out = "", None
        lines: list[str] = []
        keys: list[str] = []
        at = 0

        def close() -> pa.RecordBatch:
            out.close()
            blocks, directory, off = [], [], 0
            for i in range(0, len(lines), BLOCK_LINES):
                block = gzip.compress("\n".join(lines[i:i + BLOCK_LINES]).encode(), 6, mtime=0)
                directory.append([keys[i], off, len(block)])
                blocks.append(block)
                off += len(block)
            # The directory follows the blocks; the last 8 bytes say where it starts.
            publish(f"{name}.idx", b"".join([*blocks, json.dumps(directory).encode(), off.to_bytes(8, "little")]))
            return pa.RecordBatch.from_pydict({"warc": [f"{name}.warc.gz"], "index": [f"{name}.idx"],
                                               "first": [keys[0]], "last": [keys[-1]], "captures": [len(keys)]})

        for batch in batches:
            for r in zip(*(batch[c].to_pylist() for c in ("key", "id", "url", "html", "response"))):
                key, page, url, html, response = r
                payload = html.encode()
                revisit = response is not None and page != response
                sha1 = hashlib.sha1(payload).hexdigest()
                member = gzip.compress(record(page, url, payload, "revisit" if revisit else "response",
                                              response if revisit else None, sha1), 6, mtime=0)
                if out is None:
                    name = f"{folder}/{uuid.uuid4().hex}"
                    files, place = store(f"{name}.warc.gz")
                    files.create_dir(place.rsplit("/", 1)[0], recursive=True)
                    out = files.open_output_stream(place, compression=None)  # members are compressed already
                out.write(member)
                lines.append(_line(key, page, at, len(member)))
                keys.append(key)
                at += len(member)
                if at >= archive_bytes:
                    yield close()
                    out, lines, keys, at = None, [], [], 0
        if keys:
            yield close()

    return written(ordered.mapInArrow(write, _MANIFEST), "warc-manifest")


def _key_udf():
    @F.pandas_udf("string")
    def key(url: pd.Series) -> pd.Series:
        return url.map(lambda u: url_key(u if isinstance(u, str) else None))

    return key


class Index:
    """One index file: binary search over its block directory, range reads of blocks."""

    def __init__(self, path: str):
        files, at = store(path)
        self.f = files.open_input_file(at)
        size = self.f.size()
        start = int.from_bytes(self.f.read_at(8, size - 8), "little")
        self.directory = json.loads(self.f.read_at(size - 8 - start, start))
        self.firsts = [d[0] for d in self.directory]
        self.held: tuple[int, list] = (-1, [])

    def block(self, i: int) -> list:
        if self.held[0] != i:
            _, off, length = self.directory[i]
            text = gzip.decompress(self.f.read_at(length, off)).decode()
            self.held = (i, [json.loads(x) for x in text.split("\n")])
        return self.held[1]

    def captures(self, key: str, page_id: int | None) -> list[tuple[int, int]]:
        """(offset, length) of the records of this key and page."""
        i = max(0, bisect.bisect_left(self.firsts, key) - 1)
        found = []
        while i < len(self.firsts) and self.firsts[i] <= key:
            lines = self.block(i)
            rank = lambda x: (x[0], x[1] is not None, x[1] or 0)
            at = bisect.bisect_left(lines, rank([key, page_id]), key=rank)
            while at < len(lines) and lines[at][:2] == [key, page_id]:
                found.append((lines[at][2], lines[at][3]))
                at += 1
            i += 1
        return found


def lookup(manifest: DataFrame, asked: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Captures of the asked (url, page) pairs, read through the index.

    Returns page_id, url, payload_bytes, payload_digest, record_type,
    refers_to, payload (null for revisits), one row per stored record.
    """
    # First level: one (first, last) key range per archive, as bounded as a file listing.
    tops = sorted((r["first"], r["last"], r["index"], r["warc"]) for r in manifest.drop("captures").collect())
    spark = asked.sparkSession
    level = spark.sparkContext.broadcast(([t[0] for t in tops], [t[1] for t in tops], [t[2:] for t in tops]))
    keyed = (asked.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"))
             .distinct().withColumn("key", _key_udf()("url")))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts, lasts, _ = level.value
        for batch in batches:
            out: dict[str, list] = {"archive": [], "key": [], "id": []}
            for key, page in zip(batch["key"].to_pylist(), batch["id"].to_pylist()):
                i = bisect.bisect_left(lasts, key)
                while i < len(firsts) and firsts[i] <= key:  # a key may run over several archives
                    out["archive"].append(i)
                    out["key"].append(key)
                    out["id"].append(page)
                    i += 1
            yield pa.RecordBatch.from_pydict({"archive": pa.array(out["archive"], pa.int32()),
                                              "key": pa.array(out["key"], pa.string()),
                                              "id": pa.array(out["id"], pa.int64())})

    placed = written(keyed.mapInArrow(place, "archive int, key string, id long").distinct(), "warc-placed")
    # Salted by key, so that one archive's lookups need not be one task's.
    tasks = reading_tasks(spark, placed.count(), READ_RECORDS)
    dealt = (placed.repartition(tasks, "archive", F.pmod(F.xxhash64("key", "id"), F.lit(8)))
             .sortWithinPartitions("archive", "key", "id"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, index, warc = None, None, None
        for batch in batches:
            rows = []
            for archive, key, page in zip(*(batch[c].to_pylist() for c in ("archive", "key", "id"))):
                if archive != held:
                    held, index = archive, Index(level.value[2][archive][0])
                    files, at = store(level.value[2][archive][1])
                    warc = files.open_input_file(at)
                for off, length in index.captures(key, page):
                    headers, payload = parse(zlib.decompress(warc.read_at(length, off), 31))
                    kind, ref = headers["X-Capture-Type"], headers.get("WARC-Refers-To", "")
                    stored = hashlib.sha1(payload).hexdigest()
                    said = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                    if kind == "response" and stored != said:
                        raise ValueError(f"record of page {page}: payload digest {stored}, header {said}")
                    rows.append({"page_id": page, "url": headers["WARC-Target-URI"],
                                 "payload_bytes": int(headers["X-Payload-Length"]), "payload_digest": said,
                                 "record_type": kind, "refers_to": int(ref[10:-1]) if ref else None,
                                 "payload": payload if kind == "response" else None})
                    if len(rows) >= 256:
                        yield pa.RecordBatch.from_pylist(rows, _READ)
                        rows = []
            yield pa.RecordBatch.from_pylist(rows, _READ)

    return dealt.mapInArrow(read, "page_id long, url string, payload_bytes long, payload_digest string, "
                                  "record_type string, refers_to long, payload binary")


_READ = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
                   ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                   ("payload", pa.binary())])


def archive_round_trip(pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """Write all pages, then look every page up through the index and read its record."""
    manifest = write_archives(pages, shared_path(pages.sparkSession, "warc"), min_revisit=min_revisit)
    return lookup(manifest, pages).drop("url", "payload")
