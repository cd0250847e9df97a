"""WARC archives with a two-level capture index.

Writing: each task writes the records of its partition to one archive per ``ROLL`` bytes, a gzip
member per record, under a name of its own attempt, so a repeated task leaves no half-read file.
Equal payloads are grouped by digest before; all but the one with the largest page_id become revisit
records.

Index: one line per capture, keyed by the URL with its host reversed and the page_id. Lines are
sorted over the whole table; each task writes its range as compressed blocks of ``BLOCK_LINES``
lines, followed by a sparse directory (the first key of every block and its place). The driver keeps
the first key and the place of the directory of each file only: a row per partition of the index.

Reading: a key is searched in the list of files, in that file's directory and in one block, each by
bisection, then its record is read by one range read. Keys are looked up in their order and records
read in the order of the archives, so neighbours share reads.

Null html is an empty payload and null url an empty URL. Rows that repeat page_id and URL are one
capture each; each finds its own. Control characters in a URL are percent-encoded in the header.
Extra columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
import uuid
import zlib
from bisect import bisect_right
from collections import OrderedDict
from collections.abc import Iterator
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.staging import staged, work_folder
from .shipping import open_store, ship
from .words import slices

ROLL = 1 << 30
BLOCK_LINES = 512
#: Blocks and directories a task keeps at a time.
CACHED = 64
_CONTROL = re.compile(r"[\x00-\x20\x7f]")


def reversed_host_key(url: str) -> str:
    """``com,example,www)/path?query``; a URL without a host is its own key."""
    try:
        parts = urlsplit(url)
        host = (parts.hostname or "").lower()
        port = f":{parts.port}" if parts.port else ""
    except ValueError:
        return url
    if not host:
        return url
    rest = (parts.path or "/") + (f"?{parts.query}" if parts.query else "") + (f"#{parts.fragment}" if parts.fragment else "")
    return ",".join(reversed(host.split("."))) + port + ")" + rest


def sha1_label(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, row: int, url: str, payload: bytes, refers_to: int | None) -> bytes:
    """One record: a response with its payload, or a revisit that names the response's page."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{page_id}:{row}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: {_CONTROL.sub(lambda m: quote(m[0]), url)}",
        f"WARC-Payload-Digest: sha1:{sha1_label(payload)}",
        f"WARC-Block-Digest: sha1:{sha1_label(block)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: <urn:page:{refers_to}>"]
    return ("\r\n".join(head) + "\r\n\r\n").encode("utf-8", "replace") + block + b"\r\n\r\n"


def parse(data: bytes) -> dict[str, str | bytes]:
    """The headers of a record by lower-case name, ``http_length`` and its ``payload``."""
    head, _, rest = data.partition(b"\r\n\r\n")
    found: dict[str, str | bytes] = {}
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        found[name.decode().lower()] = value.decode("utf-8", "replace").strip()
    block = rest[:int(found["content-length"])]
    if sha1_label(block) != found["warc-block-digest"].removeprefix("sha1:"):
        raise ValueError(f"damaged record {found['warc-record-id']}")
    http, _, payload = block.partition(b"\r\n\r\n")
    found["http_length"] = re.search(rb"Content-Length: (\d+)", http)[1].decode()
    found["payload"] = payload
    return found


def _own_name(kind: str) -> str:
    context = TaskContext.get()
    return f"{kind}-{context.partitionId():06d}-{context.taskAttemptId()}-{uuid.uuid4().hex[:8]}"


_CAPTURES = pa.schema([("key", pa.string()), ("page_id", pa.int64()), ("row", pa.int64()), ("archive", pa.string()),
                       ("start", pa.int64()), ("length", pa.int64())])


def _write(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = open_store(folder)
        sink, name, at, row = None, "", 0, (TaskContext.get().partitionId() << 33)
        try:
            for batch in batches:
                for part in slices(batch, "html"):
                    rows = []
                    for page_id, url, html, refers in zip(*(part.column(c).to_pylist() for c in (
                            "page_id", "url", "html", "refers_to"))):
                        if sink is None or at >= ROLL:
                            if sink is not None:
                                sink.close()
                            name, at = _own_name("pages") + ".warc.gz", 0
                            sink = store.open_output_stream(f"{path}/{name}", compression=None)
                        member = gzip.compress(record(page_id, row, url or "", (html or "").encode(), refers), 4, mtime=0)
                        sink.write(member)
                        rows.append((reversed_host_key(url or ""), page_id, row, name, at, len(member)))
                        at, row = at + len(member), row + 1
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _CAPTURES)],
                                                     schema=_CAPTURES)
        finally:
            if sink is not None:
                sink.close()

    return run


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write a record per page; returns the captures: key, page_id, row, archive, start, length."""
    pages = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"),
                         F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    payload = F.sha2("html", 256)
    copies = (pages.select("page_id", payload.alias("payload")).groupBy("payload")
              .agg(F.max("page_id").alias("kept"), F.count(F.lit(1)).alias("n")).filter("n > 1"))
    ids = pages.select("page_id", payload.alias("payload")).filter("page_id IS NOT NULL")
    revisits = (ids.join(copies, "payload").filter("page_id < kept").groupBy("page_id", "payload")
                .agg(F.max("kept").alias("refers_to")))
    typed = pages.withColumn("payload", payload).join(revisits, ["page_id", "payload"], "left")
    kind = "key string, page_id long, row long, archive string, start long, length long"
    return staged(typed.select("page_id", "url", "html", "refers_to").mapInArrow(_write(folder), kind), "captures")


_FILES = pa.schema([("first", pa.string()), ("first_page", pa.int64()), ("first_row", pa.int64()), ("file", pa.string()),
                    ("directory", pa.int64()), ("size", pa.int64())])


def _order(key: str, page_id: int | None, row: int) -> tuple:
    return key, -(2**63) if page_id is None else page_id, row


def _index(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = open_store(folder)
        name, sink, at = _own_name("index") + ".cdx", None, 0
        directory, lines = [], []

        def block() -> None:
            nonlocal at
            data = zlib.compress(json.dumps(lines).encode())
            directory.append([lines[0][0], lines[0][1], lines[0][2], at, len(data)])
            sink.write(data)
            at += len(data)
            lines.clear()

        for batch in batches:
            for line in zip(*(c.to_pylist() for c in batch.columns)):
                if sink is None:
                    sink = store.open_output_stream(f"{path}/{name}", compression=None)
                lines.append(line)
                if len(lines) == BLOCK_LINES:
                    block()
        if sink is None:
            return
        if lines:
            block()
        data = zlib.compress(json.dumps(directory).encode())
        sink.write(data)
        sink.close()
        first = directory[0]
        yield pa.RecordBatch.from_arrays(
            [pa.array([v], f.type) for v, f in zip((*first[:3], name, at, len(data)), _FILES)], schema=_FILES)

    return run


class CaptureIndex:
    """The files of an index by their first keys; at most a row per partition it was written from."""

    def __init__(self, folder: str, files: list[tuple]):
        self.folder = folder
        self.files = sorted(files, key=lambda f: _order(*f[:3]))


def build_index(captures: DataFrame, folder: str) -> CaptureIndex:
    ordered = captures.repartitionByRange("key", "page_id", "row").sortWithinPartitions("key", "page_id", "row")
    files = staged(ordered.select(*_CAPTURES.names).mapInArrow(
        _index(folder), "first string, first_page long, first_row long, file string, directory long, size long"), "index-files")
    return CaptureIndex(folder, [tuple(r) for r in files.collect()])


class _Search:
    def __init__(self, index: CaptureIndex):
        self.store, self.path = open_store(index.folder)
        self.files = index.files
        self.starts = [_order(*f[:3]) for f in self.files]
        self.kept: OrderedDict = OrderedDict()

    def _read(self, file: str, start: int, size: int) -> tuple[list, list]:
        place = (file, start)
        if place not in self.kept:
            with self.store.open_input_file(f"{self.path}/{file}") as source:
                entries = json.loads(zlib.decompress(source.read_at(size, start)))
            self.kept[place] = entries, [_order(*e[:3]) for e in entries]
            if len(self.kept) > CACHED:
                self.kept.popitem(last=False)
        self.kept.move_to_end(place)
        return self.kept[place]

    def find(self, key: str, page_id: int | None, row: int) -> list | None:
        """The capture's line: file, block and line by bisection."""
        wanted = _order(key, page_id, row)
        i = bisect_right(self.starts, wanted) - 1
        if i < 0:
            return None
        *_, file, directory, size = self.files[i]
        blocks, firsts = self._read(file, directory, size)
        _, _, _, start, length = blocks[bisect_right(firsts, wanted) - 1]
        lines, keys = self._read(file, start, length)
        j = bisect_right(keys, wanted) - 1
        return lines[j] if j >= 0 and keys[j] == wanted else None


_PLACES = pa.schema([("archive", pa.string()), ("start", pa.int64()), ("length", pa.int64())])


def _look_up(index: CaptureIndex):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = _Search(index)
        for batch in batches:
            found = [search.find(*wanted) for wanted in zip(*(c.to_pylist() for c in batch.columns))]
            rows = [line[3:6] for line in found if line]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_PLACES)], schema=_PLACES)

    return run


_RECORDS = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                      ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string())])


def _fetch(folder: str):
    def number(uri: str) -> int | None:
        value = uri.removeprefix("<urn:page:").removesuffix(">").split(":")[0]
        return None if value == "None" else int(value)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = open_store(folder)
        name, source = None, None
        for batch in batches:
            rows = []
            for archive, start, length in zip(*(c.to_pylist() for c in batch.columns)):
                if archive != name:
                    if source is not None:
                        source.close()
                    name, source = archive, store.open_input_file(f"{path}/{archive}")
                found = parse(gzip.decompress(source.read_at(length, start)))
                digest = found["warc-payload-digest"].removeprefix("sha1:")
                payload, size = found["payload"], int(found["http_length"])
                kind = found["warc-type"]
                if kind == "response" and (len(payload) != size or sha1_label(payload) != digest):
                    raise ValueError(f"damaged payload in {archive} at {start}")
                refers = found.get("warc-refers-to")
                rows.append((number(found["warc-record-id"]), size, digest, kind, number(refers) if refers else None,
                             found["warc-target-uri"]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_RECORDS)], schema=_RECORDS)

    return run


def read_captures(wanted: DataFrame, index: CaptureIndex, archives: str) -> DataFrame:
    """The records of wanted captures (key, page_id, row): page_id, payload_bytes, payload_digest,
    record_type, refers_to, url. A key that the index lacks gives no row."""
    keys = wanted.select("key", "page_id", "row").repartitionByRange("key", "page_id", "row").sortWithinPartitions(
        "key", "page_id", "row")
    places = keys.mapInArrow(_look_up(index), "archive string, start long, length long")
    ordered = places.repartition("archive").sortWithinPartitions("archive", "start")
    return ordered.mapInArrow(
        _fetch(archives), "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string")


def archive_and_read(pages: DataFrame) -> DataFrame:
    """Write all pages to archives, index them, and read every capture back through the index."""
    spark = pages.sparkSession
    ship(spark)
    folder = work_folder(spark, "warc")
    store, path = open_store(folder)
    store.create_dir(path)
    captures = write_archives(pages, folder)
    return read_captures(captures, build_index(captures, folder), folder)
