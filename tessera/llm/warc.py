"""WARC archives with a two-level capture index (operator 4).

``write_archives`` sorts the captures by reversed-host URL key and page id
over range partitions. A task writes its captures to gzip members of an
archive, and its index lines, in the same order, to compressed blocks of
``BLOCK_LINES``; the index file ends in its sparse block directory (first key,
offset, length of each block). What Spark gathers is one row a file: its key
range and name. Files of lost or repeated attempts are simply not listed.

``read_captures`` finds the file by binary search among the key ranges, the
block by binary search in the file's directory, the line by binary search in
the block, and reads the record's bytes alone.

Of records with equal payloads the one with the smallest page id is a
response; the others are revisits that refer to it and hold no payload.

Defined cases: a null html is an empty payload, a null url an empty key and
no target; a null page id is read back as null and can be referred to by
none; rows that repeat the smallest page id are responses too; repeated rows
are written and read back once each; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import struct
import uuid
import zlib
from bisect import bisect_left, bisect_right
from urllib.parse import quote, urlsplit

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import map_batches, small_side
from tessera.session import Scratch, scratch_path

BLOCK_LINES = 300
ARCHIVE_BYTES = 1 << 30  # a task starts another archive beyond it
REPEATS = 500_000  # payloads with copies that may be broadcast (some 40 MB)
DATE = "2024-01-01T00:00:00Z"
FILES = "first_key string, last_key string, index_file string, lines long"
CAPTURES = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def url_key(url: str | None) -> str:
    """Reversed-host key: http://www.a.example.com/x?y#z -> com,example,a)/x?y"""
    if not url:
        return ""
    try:
        parts = urlsplit(url.strip())
        host = (parts.hostname or "").removeprefix("www.")
        port = f":{parts.port}" if parts.port not in (None, 80, 443) else ""
    except ValueError:
        return url
    if not host:
        return url
    return ",".join(reversed(host.split("."))) + port + ")" + (parts.path or "/").lower() + (f"?{parts.query}" if parts.query else "")


def line_key(key: str, page_id: int | None) -> str:
    """Sorts like (key, page_id), nulls first."""
    number = "-" if page_id is None else f"{page_id + (1 << 63):020d}"
    return f"{quote(key, safe=PRINTABLE)} {number}"


PRINTABLE = "".join(chr(c) for c in range(33, 127))


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record, response or revisit, as a gzip member."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest(payload)}", f"WARC-Block-Digest: sha1:{digest(block)}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    if url:
        head.append(f"WARC-Target-URI: {quote(url, safe=PRINTABLE)}")
    if revisit:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
    packer = zlib.compressobj(3, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def parse(member: bytes) -> tuple:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of a
    record; a response's bytes and digest are taken from its payload."""
    head, _, rest = zlib.decompress(member, 31).partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    if fields["WARC-Block-Digest"] != f"sha1:{digest(block)}":
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    http, _, payload = block.partition(b"\r\n\r\n")
    number = lambda uri: int(uri[len("<urn:page:") : -1]) if uri and uri != "<urn:page:>" else None
    page_id, kind = number(fields["WARC-Record-ID"]), fields["WARC-Type"]
    if kind == "response":
        return page_id, len(payload), digest(payload), kind, None
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    return page_id, size, fields["WARC-Payload-Digest"].removeprefix("sha1:"), kind, number(fields["WARC-Refers-To"])


def opened(folder: str):
    """The file system of a folder, and the folder's path in it."""
    from pyarrow import fs

    uri = re.sub(r"^file:/(?!/)", "file:///", folder)
    return fs.FileSystem.from_uri(uri)


class IndexWriter:
    """Compressed blocks of sorted lines, then the block directory."""

    def __init__(self, stream):
        self.stream, self.directory, self.lines, self.at, self.count = stream, [], [], 0, 0
        self.first = self.last = None

    def add(self, key: str, archive: str, offset: int, length: int) -> None:
        self.first, self.last = key if self.first is None else self.first, key
        self.lines.append(f"{key} {archive} {offset} {length}")
        self.count += 1
        if len(self.lines) == BLOCK_LINES:
            self.flush()

    def flush(self) -> None:
        if self.lines:
            data = zlib.compress("\n".join(self.lines).encode())
            self.directory.append((" ".join(self.lines[0].split(" ")[:2]), self.at, len(data)))
            self.stream.write(data)
            self.at += len(data)
            self.lines = []

    def close(self) -> None:
        self.flush()
        data = zlib.compress(json.dumps(self.directory).encode())
        self.stream.write(data + struct.pack("<Q", len(data)))
        self.stream.close()


class IndexFile:
    """Binary search in an index file's directory, then in one block."""

    def __init__(self, system, path: str):
        self.file = system.open_input_file(path)
        size = self.file.size()
        length = struct.unpack("<Q", self.file.read_at(8, size - 8))[0]
        self.directory = json.loads(zlib.decompress(self.file.read_at(length, size - 8 - length)))
        self.keys = [d[0] for d in self.directory]
        self.cached: tuple = (None, [], [])

    def block(self, k: int) -> tuple[list[str], list[list[str]]]:
        if self.cached[0] != k:
            _, at, length = self.directory[k]
            lines = [x.split(" ") for x in zlib.decompress(self.file.read_at(length, at)).decode().split("\n")]
            self.cached = (k, [" ".join(x[:2]) for x in lines], lines)
        return self.cached[1:]

    def find(self, key: str) -> list[tuple[str, int, int]]:
        """(archive, offset, length) of every line of the key."""
        found = []
        for k in range(max(0, bisect_left(self.keys, key) - 1), bisect_right(self.keys, key)):
            keys, lines = self.block(k)
            for x in lines[bisect_left(keys, key) : bisect_right(keys, key)]:
                found.append((x[2], int(x[3]), int(x[4])))
        return found


def captures(pages: DataFrame) -> DataFrame:
    """page_id, url, html, and the page that a revisit refers to."""
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    own = own.withColumn("hash", F.sha1("html"))
    repeats = own.groupBy("hash").agg(F.min("page_id").alias("first"), F.count("*").alias("times")).where("times > 1").drop("times")
    repeats = Scratch(pages.sparkSession).write(repeats, "repeats")
    joined = own.join(small_side(repeats, REPEATS), "hash", "left").drop("hash")
    return joined.withColumn("refers_to", F.expr("IF(first IS NOT NULL AND NOT page_id <=> first, first, NULL)")).drop("first")


def sort_key(url: str, page_id: str):
    @F.pandas_udf("string")
    def key(urls: pd.Series, ids: pd.Series) -> pd.Series:
        return pd.Series([line_key(url_key(u), None if i is None else int(i)) for u, i in zip(urls, ids)], dtype=object)

    # as text, ids pass pandas unchanged beside nulls
    return key(F.col(url), F.col(page_id).cast("long").cast("string"))


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write archives and index files below ``folder``; one row (first_key,
    last_key, index_file, lines) for each index file."""

    def write(batches):
        system, base = opened(folder)
        system.create_dir(base, recursive=True)
        name, out, index, at = "", None, None, 0
        done = []

        def close():
            out.close()
            index.close()
            done.append((index.first, index.last, name, index.count))

        for batch in batches:
            for key, page_id, url, html, first in zip(batch.key, batch.page_id, batch.url, batch.html, batch.refers_to):
                if out is not None and at > ARCHIVE_BYTES:
                    close()
                    out = None
                if out is None:
                    name, at = f"part-{uuid.uuid4().hex}", 0
                    out = system.open_output_stream(f"{base}/{name}.warc.gz", compression=None)
                    index = IndexWriter(system.open_output_stream(f"{base}/{name}.index", compression=None))
                member = record(page_id, url, html.encode(), first, first is not None)
                out.write(member)
                index.add(key, name, at, len(member))
                at += len(member)
        if out is not None:
            close()
        yield done

    own = captures(pages).withColumn("key", sort_key("url", "page_id"))
    # pages of one key may be many: the order within it doesn't matter
    placed = own.repartitionByRange("key", F.xxhash64("html")).sortWithinPartitions("key")
    return map_batches(placed.select("key", "page_id", "url", "html", "refers_to"), write, FILES)


def read_captures(keys: DataFrame, files: DataFrame, folder: str) -> DataFrame:
    """The captures of ``keys`` (key string), read through the index. The list
    of files (one for a task or gigabyte) is broadcast."""
    spark = keys.sparkSession
    listed = spark.sparkContext.broadcast(sorted((r.first_key, r.last_key, r.index_file) for r in files.collect()))

    def read(batches):
        system, base = opened(folder)
        ranges = listed.value
        firsts, index, archives = [r[0] for r in ranges], {}, {}

        def held(cache, name, make):
            if name not in cache:
                if len(cache) > 3:
                    cache.pop(next(iter(cache)))
                cache[name] = make()
            return cache[name]

        for batch in batches:
            rows = []
            for key in batch.key:
                # files meet in a key only at their ends, so walk back while one ends in it
                k = bisect_right(firsts, key) - 1
                while k >= 0 and ranges[k][1] >= key:
                    path = f"{base}/{ranges[k][2]}.index"
                    for name, at, length in held(index, path, lambda: IndexFile(system, path)).find(key):
                        archive = held(archives, name, lambda: system.open_input_file(f"{base}/{name}.warc.gz"))
                        rows.append(parse(archive.read_at(length, at)))
                    k -= 1
            yield rows

    near = keys.distinct().repartitionByRange("key").sortWithinPartitions("key")
    return map_batches(near, read, CAPTURES)


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Write all pages, then read every capture back through the index."""
    spark = pages.sparkSession
    folder = scratch_path(spark, "warc")
    files = Scratch(spark).write(write_archives(pages, folder), "warc-files")
    keys = pages.select(sort_key("url", "page_id").alias("key"))
    return read_captures(keys, files, folder)
