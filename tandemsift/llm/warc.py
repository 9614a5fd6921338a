"""Web archives with a two-level capture index: compressed blocks of sorted keys and a sparse directory."""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common, files

#: Lines of an index block; a directory holds one entry for each block of its part of the keys.
BLOCK = 512
#: Index lines and lookups that a task works on.
LINES, LOOKUPS = 1 << 16, 1 << 12
#: Revisits are broadcast up to so many rows of two numbers, else joined by a shuffle.
BROADCAST_ROWS = 1 << 17
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def url_key(url: Column) -> Column:
    """Reversed host, then the rest: org,example,www)/path?query."""
    rest = F.regexp_replace(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    authority = F.regexp_extract(rest, r"^[^/?#]*", 0)
    host = F.lower(F.regexp_replace(F.regexp_replace(authority, "^.*@", ""), ":[0-9]*$", ""))
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), F.substring(rest, F.length(authority) + 1, F.length(rest)))


def page_key(page_id: int | None) -> tuple[bool, int]:
    """Orders pages of one url: those without an id first, apart from every id."""
    return page_id is not None, page_id or 0


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def record(page_id: int | None, url: str, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC record as a gzip member of its own."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {quote(url, safe=chr(33) + '#$&()*+,/:;=?@[]~%')}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Page-Id: {'' if page_id is None else page_id}",
    ]
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}", f"X-Refers-To-Page-Id: {refers_to}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return gzip.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", 6, mtime=0)


def parsed(member: bytes) -> tuple[dict[str, str], int, bytes]:
    """Headers, payload length and payload of a record; digests of responses are checked."""
    head, _, block = gzip.decompress(member).partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = block[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(line[16:]) for line in http.split(b"\r\n") if line.startswith(b"Content-Length: "))
    if fields["WARC-Type"] == "response":
        if len(payload) != size or "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode() != fields["WARC-Payload-Digest"]:
            raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    return fields, size, payload


def revisits(pages: DataFrame, least_bytes: int) -> DataFrame:
    """page_id, digest -> refers_to for the pages that repeat the payload of a smaller page_id."""
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    digests = common.stored(pages.filter(F.octet_length(payload) >= least_bytes).select("page_id", F.sha1(payload).alias("digest")), "digests")
    firsts = digests.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n")).filter("n > 1").drop("n")
    return digests.distinct().join(firsts, "digest").filter("NOT page_id <=> refers_to AND refers_to IS NOT NULL")


def write(pages: DataFrame, folder: str, least_bytes: int = 0) -> DataFrame:
    """Writes a record for each row of pages[page_id, url, html]; returns the captures.

    Of records with equal payloads of at least least_bytes, the smallest page_id is the response and the
    others revisit it. Every task writes archives of its own under new names and a repeated task writes
    new ones, so captures, stored when this returns, name whole files only. Payload bytes aren't shuffled
    unless there are more than BROADCAST_ROWS revisits. Null html is an empty payload, a null url has the
    empty host, a null page_id refers to the smallest that isn't; rows repeated with page_id and payload
    are responses all; an empty table writes nothing; other columns are ignored.
    The session then sends 1,000 rows at most to a worker at once.
    """
    common.small_batches(pages.sparkSession)
    pages = pages.select("page_id", "url", "html")
    again = common.stored(revisits(pages, least_bytes), "revisits")
    few = again.count() <= BROADCAST_ROWS
    right = again.select(F.col("page_id").alias("_p"), F.col("digest").alias("_d"), "refers_to")
    keyed = pages.withColumn("_digest", F.sha1(F.encode(F.coalesce("html", F.lit("")), "UTF-8")))
    rows = keyed.join(F.broadcast(right) if few else right, F.col("page_id").eqNullSafe(F.col("_p")) & (F.col("_digest") == F.col("_d")), "left")

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, out, at = f"{uuid.uuid4().hex}.warc.gz", None, 0
        for batch in batches:
            lines = []
            for page_id, url, html, refers_to, key in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    system, path = files.opened(folder)
                    system.create_dir(path, recursive=True)
                    out = system.open_output_stream(f"{path}/{name}", compression=None)
                member = record(page_id, url or "", (html or "").encode(), refers_to)
                out.write(member)
                lines.append((key, page_id, name, at, len(member)))
                at += len(member)
            if lines:
                columns = list(zip(*lines, strict=True))
                types = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["key", "page_id", "file", "at", "size"])
        if out is not None:
            out.close()

    chosen = rows.select(F.col("page_id").cast("long"), "url", "html", F.col("refers_to").cast("long"), url_key(F.col("url")).alias("key"))
    captures = common.stored(chosen.mapInArrow(written, "key string, page_id long, file string, at long, size long"), "captures")
    common.remove(again, pages.sparkSession)
    return captures


def index(captures: DataFrame, folder: str) -> list[tuple]:
    """Writes the index: each task sorts a range of the keys into compressed blocks and, behind them, their directory.

    A range holds about LINES captures. Captures without a page id come first among those of their url; captures
    that repeat a key are lines of their own; of an empty table there is no index file. Returns one entry for each
    range: its first key, file, and where its directory lies; these few rows are what the driver holds.
    """

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, at, directory, lines, out, first = f"{uuid.uuid4().hex}.idx", 0, [], [], None, None

        def put(data: bytes) -> int:
            nonlocal at
            out.write(data)
            at += len(data)
            return at - len(data)

        def flush():
            data = zlib.compress("\n".join(lines).encode(), 6)
            directory.append((json.loads(lines[0])[:3], put(data), len(data)))
            lines.clear()

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    system, path = files.opened(folder)
                    out, first = system.open_output_stream(f"{path}/{name}", compression=None), (row[0], *page_key(row[1]))
                lines.append(json.dumps([row[0], *page_key(row[1]), *row[2:]]))
                if len(lines) == BLOCK:
                    flush()
        if out is not None:
            if lines:
                flush()
            data = zlib.compress(json.dumps(directory).encode(), 6)
            start = put(data)
            out.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([x]) for x in (first[0], first[1])] + [pa.array([first[2]], pa.int64()), pa.array([name]), pa.array([start]), pa.array([len(data)])],
                names=["key", "known", "page_id", "file", "at", "size"],
            )

    order = [F.col("key"), F.col("page_id").asc_nulls_first()]
    parts = captures.select("key", "page_id", "file", "at", "size").repartitionByRange(max(1, -(-captures.count() // LINES)), *order).sortWithinPartitions(*order)
    rows = parts.mapInArrow(blocks, "key string, known boolean, page_id long, file string, at long, size long").collect()  # one for each task
    return sorted(tuple(r) for r in rows)


class Reader:
    """Finds captures by binary search in the directories and blocks, and reads records by range."""

    def __init__(self, folder: str, top: list[tuple], kept: int = 8) -> None:
        self.system, self.path = files.opened(folder)
        self.top, self.kept = top, kept
        self.starts = [t[:3] for t in top]
        self.open: dict[str, pa.NativeFile] = {}
        self.loaded: dict[tuple, tuple] = {}

    def range(self, name: str, at: int, size: int) -> bytes:
        if name not in self.open:
            while len(self.open) >= 16 * self.kept:
                self.open.pop(next(iter(self.open))).close()
            self.open[name] = self.system.open_input_file(f"{self.path}/{name}")
        return self.open[name].read_at(size, at)

    def load(self, name: str, at: int, size: int, whole: bool) -> tuple[list, list]:
        """Sorted keys and entries of a block, or of a directory."""
        if (name, at) not in self.loaded:
            while len(self.loaded) >= self.kept:
                self.loaded.pop(next(iter(self.loaded)))
            text = zlib.decompress(self.range(name, at, size)).decode()
            rows = json.loads(text) if whole else [json.loads(x) for x in text.split("\n")]
            self.loaded[name, at] = [tuple(r[0]) if whole else tuple(r[:3]) for r in rows], rows
        return self.loaded[name, at]

    def captures(self, key: str, page_id: int | None) -> list:
        """File, place and size of all captures of a key and page (of rows that repeat both, more than one)."""
        wanted, found = (key, *page_key(page_id)), []
        shard = max(0, bisect.bisect_left(self.starts, wanted) - 1)
        while shard < len(self.top) and self.starts[shard] <= wanted:
            name, at, size = self.top[shard][3:]
            keys, entries = self.load(name, at, size, True)
            block = max(0, bisect.bisect_left(keys, wanted) - 1)
            while block < len(keys) and keys[block] <= wanted:
                own, lines = self.load(name, entries[block][1], entries[block][2], False)
                low = bisect.bisect_left(own, wanted)
                while low < len(own) and own[low] == wanted:
                    found.append(lines[low][3:])
                    low += 1
                block += 1
            shard += 1
        return found


def read(lookups: DataFrame, folder: str, top: list[tuple]) -> DataFrame:
    """lookups[page_id, url] -> what the archives hold of each: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Lookups are dealt out in key order, about LOOKUPS to a task, so that a task reads neighbouring blocks. Every page
    found is read from its archive; one that isn't there gives no row; lookups that repeat a key and id count once and
    give all its captures; a null id finds captures without one only; a null url has the empty host; no lookups give
    no rows; other columns are ignored.
    """
    # one entry for each index file
    shared = lookups.sparkSession.sparkContext.broadcast(top)

    def looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(folder, shared.value)
        for batch in batches:
            out = []
            for key, page_id in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for entry in reader.captures(key, page_id):
                    fields, size, _ = parsed(reader.range(*entry))
                    refers_to = fields.get("X-Refers-To-Page-Id")
                    own = fields["X-Page-Id"]
                    out.append((int(own) if own else None, size, fields["WARC-Payload-Digest"][5:], fields["WARC-Type"], None if refers_to is None else int(refers_to)))
            columns = list(zip(*out, strict=True)) or [[]] * 5
            types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    keys = lookups.select(url_key(F.col("url")).alias("key"), F.col("page_id").cast("long")).distinct()
    dealt = keys.repartitionByRange(max(1, -(-lookups.count() // LOOKUPS)), "key", "page_id").sortWithinPartitions("key", "page_id")
    return dealt.mapInArrow(looked_up, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def query(spark, sf_dir):
    pages = common.table(spark, sf_dir, "pages")
    folder = common.new_folder(spark, "warc")
    return read(pages, folder, index(write(pages, folder), folder))


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages
), f AS (SELECT html, min(page_id) AS first FROM p GROUP BY html
), h AS (SELECT p.page_id, strlen(p.html) AS payload_bytes, sha1(p.html) AS hex, f.first FROM p JOIN f ON p.html = f.html)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(32), lambda k:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (((('0x' || substr(hex, 5 * (k // 4) + 1, 5))::BIGINT >> (15 - 5 * (k % 4))) & 31)::INT), 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM h
"""
