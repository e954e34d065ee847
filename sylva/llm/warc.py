"""Operator 13: web archives (WARC 1.1) with revisit records and a two-level capture index.

*Writing.* Every row becomes one record, compressed as a gzip member of its own, so a record can be read from
its offset alone. Of rows with equal payloads of at least ``LEAST`` bytes the one with the largest id is stored
(``response``); the others name it (``revisit``) and store no payload. Each task writes files of bounded size
under names that no other attempt uses, and returns their records as rows. Only files of attempts that Spark
has accepted appear in the saved record table, so a lost executor leaves at most files that nothing names.

*Index.* The records are range-sorted by key: the URL with its host reversed (``com,example)/path``) and the
record number. Each range is one index file of gzip blocks of ``LINES`` lines and, behind them, a sparse
directory with one line a block: its first key, offset and length. A look-up finds the range by the first
keys of the ranges (one row a task), the block by binary search in the file's directory, the line by binary
search in the block, and then reads just the record's bytes from the archive. Keys that are looked up are
sorted into the same ranges, so each index file is read by one task, and a block once for all its keys.

*Reading back.* Archives are read file by file as streams; payloads of responses are measured and digested
as read. Each response that a revisit names is looked up once through the index.

Defined results: a null payload is empty; a null URL is the empty URL; a null id loses to every other id and is
read back as null; of rows with equal id and payload one (the last in the table) is the response; an empty
table gives an empty result. Blanks and control characters of URLs are percent-encoded in headers. Extra
columns are ignored, whatever their names. A record is held whole by its task, of very long ones one at a time.

The files lie in the shared folder and are read and written with pyarrow's file systems, since Spark has no
reader of byte ranges; the folder's scheme must be one that they know (a path, file, hdfs, s3, gs).
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlsplit

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sylva.llm.common import read_table, save, shuffle_partitions
from sylva.operators.lookup import attach
from sylva.session import new_table_path

LEAST = 1000  # bytes of a payload from which copies become revisits
FILE_BYTES = 64 << 20  # an archive file is closed once it is larger
LINES = 512  # records a block of the index
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n\r\n"


# ---- records -----------------------------------------------------------------------------------------------

def _clean(url: str) -> str:
    return "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)


def url_key(url: str) -> str:
    """Sort key of a URL: host parts reversed, port and query kept, fragment dropped, scheme and user left out."""
    url = _clean(url)
    try:
        cut = urlsplit(url)
        host, port = (cut.hostname or ""), cut.port
    except ValueError:  # no URL that can be parsed
        return url.lower()
    if not host:
        return url
    default = {"http": 80, "https": 443}.get(cut.scheme)
    place = ",".join(reversed(host.split("."))) + (f":{port}" if port and port != default else "")
    return f"{place}){cut.path or '/'}" + (f"?{cut.query}" if cut.query else "")


def index_key(url: str, number: int) -> str:
    """Key of one record: unique, and sorted by URL first."""
    return f"{url_key(url)} {number:016x}"


def record_id(number: int) -> str:
    return f"<urn:uuid:{uuid.UUID(int=number)}>"


def _record_number(urn: str) -> int:
    return uuid.UUID(urn[len("<urn:uuid:"):-1]).int


def make_record(number: int, page_id, url: str, payload: bytes | None, size: int, sha1: bytes, target: tuple | None) -> bytes:
    """One record as bytes; ``target`` = (number, page id, URL) of the response that a revisit names."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {size}\r\n\r\n").encode()
    body = http if target else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if target else 'response'}", f"WARC-Record-ID: {record_id(number)}",
            f"WARC-Date: {DATE}", f"WARC-Target-URI: {_clean(url)}",
            f"WARC-Payload-Digest: sha1:{base64.b32encode(sha1).decode()}"]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if target:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(target[0])}",
                 f"WARC-Refers-To-Target-URI: {_clean(target[2])}"]
        if target[1] is not None:
            head.append(f"X-Refers-To-Page-ID: {target[1]}")
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + END + body + END


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (lower-case names) and payload (HTTP headers cut off) of one record."""
    head, _, rest = raw.partition(END)
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record here")
    fields = {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
    size = int(fields["content-length"])
    if len(rest) != size + len(END) or rest[size:] != END:
        raise ValueError("WARC record of the wrong length")
    return fields, rest[:size].partition(END)[2]


# ---- files -------------------------------------------------------------------------------------------------

def open_folder(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" not in path and path.startswith("file:"):
        path = path[len("file:"):]
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


def _members(stream) -> Iterator[bytes]:
    """The gzip members of a stream, decompressed one by one."""
    left = b""
    while True:
        left = left or stream.read(1 << 20)
        if not left:
            return
        unpack, out = zlib.decompressobj(wbits=31), []
        while not unpack.eof:
            out.append(unpack.decompress(left))
            left = unpack.unused_data
            if not unpack.eof:
                left = stream.read(1 << 20)
                if not left:
                    raise ValueError("archive ends inside a record")
        yield b"".join(out)


def _writer(folder: str, file_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_folder(folder)
        fs.create_dir(root, recursive=True)
        out, name, at = None, "", 0
        try:
            for batch in batches:
                for lo in range(0, batch.num_rows, 64):
                    rows = batch.slice(lo, 64).to_pylist()
                    found = []
                    for r in rows:
                        if out is None or at >= file_bytes:
                            if out is not None:
                                out.close()
                            name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                            out = fs.open_output_stream(f"{root}/{name}", compression=None)
                        target = (r["to_number"], r["to_page"], r["to_url"]) if r["to_number"] is not None else None
                        payload = None if target else r["payload"].encode()
                        one = gzip.compress(make_record(r["number"], r["page_id"], r["url"], payload, r["size"],
                                                        bytes.fromhex(r["sha1"]), target), 6, mtime=0)
                        out.write(one)
                        found.append((index_key(r["url"], r["number"]), name, at, len(one)))
                        at += len(one)
                    cols = list(zip(*found))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(cols[0], pa.string()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.int64()),
                         pa.array(cols[3], pa.int64())], ["key", "file", "offset", "length"])
        finally:
            if out is not None:
                out.close()
    return run


@dataclass
class Archive:
    """Archive files in ``folder``; ``records`` has key, file, offset and length of every record."""

    folder: str
    records: DataFrame


def numbered(pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """Saved (number, page_id, url, payload, size, sha1); the number is a row's own."""
    text = F.coalesce(F.col(payload), F.lit(""))
    return save(pages.select(F.monotonically_increasing_id().alias("number"), F.col(page_id).alias("page_id"),
                             F.coalesce(F.col(url), F.lit("")).alias("url"), text.alias("payload"),
                             F.octet_length(text).cast("long").alias("size"), F.sha1(text).alias("sha1")), "warc-pages")


def with_targets(rows: DataFrame, least: int = LEAST) -> DataFrame:
    """Add to_number, to_page, to_url: the response that a row revisits (null for responses).

    Only digests are grouped, with partial aggregates, and only those with copies are joined back.
    """
    best = F.max(F.struct(F.col("page_id").isNotNull().alias("k"), F.col("page_id").alias("to_page"),
                          F.col("number").alias("to_number"), F.col("url").alias("to_url")))
    copies = save(rows.where(F.col("size") >= least).groupBy("sha1", "size").agg(best.alias("b"), F.count(F.lit(1)).alias("n"))
                  .where("n > 1").select("sha1", "size", "b.to_page", "b.to_number", "b.to_url"), "warc-copies")
    got = attach(rows, copies, ["sha1", "size"], F.col("number"))
    other = F.col("to_number") != F.col("number")
    return got.select("number", "page_id", "url", "size", "sha1",
                      F.when(~F.coalesce(other, F.lit(False)), F.col("payload")).alias("payload"),
                      *[F.when(other, F.col(c)).alias(c) for c in ("to_number", "to_page", "to_url")])


def write_archive(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", payload: str = "html",
                  least: int = LEAST, file_bytes: int = FILE_BYTES) -> Archive:
    """Write one record a row of ``pages`` into archive files in ``folder``."""
    rows = with_targets(numbered(pages, page_id, url, payload), least)
    written = rows.mapInArrow(_writer(folder, file_bytes), "key string, file string, offset long, length long")
    return Archive(folder, save(written, "warc-records"))


# ---- two-level index ---------------------------------------------------------------------------------------

@dataclass
class CaptureIndex:
    """Index files in ``folder``; ``ranges`` has (first key, file, offset and length of the directory) by first key."""

    folder: str
    ranges: list[tuple[str, str, int, int]]


def _index_writer(folder: str, lines: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_folder(folder)
        name, out, at, first, sparse, block = f"{uuid.uuid4().hex}.cdx.gz", None, 0, None, [], []

        def close_block() -> None:
            nonlocal at, block
            packed = gzip.compress("\n".join(block).encode(), 6, mtime=0)
            out.write(packed)
            sparse.append(f"{block[0].partition(chr(9))[0]}\t{at}\t{len(packed)}")
            at += len(packed)
            block = []

        for batch in batches:
            for row in zip(*[batch.column(c).to_pylist() for c in ("key", "file", "offset", "length")]):
                if out is None:
                    fs.create_dir(root, recursive=True)
                    out, first = fs.open_output_stream(f"{root}/{name}", compression=None), row[0]
                block.append("\t".join(map(str, row)))
                if len(block) == lines:
                    close_block()
        if out is None:
            return
        if block:
            close_block()
        directory = gzip.compress("\n".join(sparse).encode(), 6, mtime=0)
        out.write(directory)
        out.close()
        yield pa.RecordBatch.from_arrays([pa.array([first]), pa.array([name]), pa.array([at]), pa.array([len(directory)])],
                                         ["first", "file", "offset", "length"])
    return run


def build_index(archive: Archive, folder: str, lines: int = LINES) -> CaptureIndex:
    """Sort the records' keys into index files; the list of ranges has one row a task."""
    n = shuffle_partitions(archive.records.sparkSession)
    ranges = save(archive.records.repartitionByRange(n, "key").sortWithinPartitions("key")
                  .mapInArrow(_index_writer(folder, lines), "first string, file string, offset long, length long"), "warc-ranges")
    found = sorted(((r.first, r.file, r.offset, r.length) for r in ranges.select("first", "file", "offset", "length").collect()),
                   key=lambda r: r[0].encode())
    return CaptureIndex(folder, found)


class _IndexFile:
    """One open index file: its sparse directory, and the block that was read last."""

    def __init__(self, fs: pafs.FileSystem, root: str, entry: tuple):
        self.file = fs.open_input_file(f"{root}/{entry[1]}")
        lines = gzip.decompress(self._range(entry[2], entry[3])).decode().split("\n")
        self.blocks = [(k.encode(), int(at), int(n)) for k, at, n in (x.split("\t") for x in lines)]
        self.first = [b[0] for b in self.blocks]
        self.at, self.keys, self.lines, self.reads = -1, [], [], 0

    def _range(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return self.file.read(n)

    def block(self, i: int) -> tuple[list[bytes], list[str]]:
        if i != self.at:
            self.lines = gzip.decompress(self._range(*self.blocks[i][1:])).decode().split("\n")
            self.keys, self.at = [x.partition("\t")[0].encode() for x in self.lines], i
            self.reads += 1
        return self.keys, self.lines

    def find(self, prefix: str) -> Iterator[tuple[str, str, int, int]]:
        """All entries (key, file, offset, length) whose key begins with ``prefix``."""
        want = prefix.encode()
        i = max(bisect.bisect_right(self.first, want) - 1, 0)
        while i < len(self.blocks) and (self.first[i] <= want or self.first[i].startswith(want)):
            keys, lines = self.block(i)
            at = bisect.bisect_left(keys, want)
            while at < len(keys) and keys[at].startswith(want):
                key, file, offset, length = lines[at].split("\t")
                yield key, file, int(offset), int(length)
                at += 1
            if at < len(keys):
                return
            i += 1


def _ranges_of(index: CaptureIndex):
    """(first, last) range that can hold keys with a prefix, for many prefixes at once."""
    starts = [r[0].encode() for r in index.ranges]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prefixes, at = [], []
            for p in batch.column("prefix").to_pylist():
                if p is None:
                    continue
                want = p.encode()
                i = max(bisect.bisect_right(starts, want) - 1, 0)
                while i < len(starts) and (starts[i] <= want or starts[i].startswith(want)):
                    prefixes.append(p)
                    at.append(i)
                    i += 1
            yield pa.RecordBatch.from_arrays([pa.array(prefixes, pa.string()), pa.array(at, pa.int32())], ["prefix", "range"])
    return run


def find_captures(index: CaptureIndex, prefixes: DataFrame) -> DataFrame:
    """(prefix, key, file, offset, length) of all records whose key begins with a ``prefix`` (a column of distinct ones)."""
    folder, ranges = index.folder, index.ranges

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_folder(folder)
        held, now = None, -1
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                rows = []
                for p, i in zip(*[batch.slice(lo, 1024).column(c).to_pylist() for c in ("prefix", "range")]):
                    if i != now:
                        held, now = _IndexFile(fs, root, ranges[i]), i
                    rows += [(p, *hit) for hit in held.find(p)]
                cols = list(zip(*rows)) or [()] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(cols, (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()))],
                    ["prefix", "key", "file", "offset", "length"])

    n = shuffle_partitions(prefixes.sparkSession)
    return (prefixes.select("prefix").mapInArrow(_ranges_of(index), "prefix string, range int")
            .repartition(n, "range").sortWithinPartitions("range", "prefix")
            .mapInArrow(look, "prefix string, key string, file string, offset long, length long"))


def captures_of(index: CaptureIndex, urls: DataFrame) -> DataFrame:
    """Records of given URLs (column ``url``): url, key, file, offset, length."""
    key = F.udf(lambda u: None if u is None else f"{url_key(u)} ")(F.col("url"))
    keyed = urls.select("url", key.alias("prefix")).distinct()
    return keyed.join(find_captures(index, keyed.select("prefix").distinct()), "prefix").drop("prefix")


_PARSED = ("number long, page_id long, url string, kind string, size long, sha1 string, stated string, to_number long, "
           "to_page long, to_url string")


def _row(fields: dict[str, str], payload: bytes) -> tuple:
    stated = base64.b32decode(fields["warc-payload-digest"].partition(":")[2]).hex()
    kind, page = fields["warc-type"], fields.get("x-page-id")
    response = kind == "response"
    to = None if response else fields["warc-refers-to"]
    to_page = fields.get("x-refers-to-page-id")
    return (_record_number(fields["warc-record-id"]), None if page is None else int(page), fields["warc-target-uri"], kind,
            len(payload) if response else None, hashlib.sha1(payload).hexdigest() if response else None, stated,
            None if to is None else _record_number(to), None if to_page is None else int(to_page),
            fields.get("warc-refers-to-target-uri"))


def _parsed_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string()}
    spec = [x.split() for x in _PARSED.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[k]) for i, (_, k) in enumerate(spec)],
                                      [n for n, _ in spec])


def scan_records(archive: Archive) -> DataFrame:
    """All records of all archive files, each file read as a stream by one task."""
    folder = archive.folder

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_folder(folder)
        for batch in batches:
            for name in batch.column("file").to_pylist():
                rows = []
                with fs.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    for raw in _members(stream):
                        rows.append(_row(*parse_record(raw)))
                        if len(rows) == 1024:
                            yield _parsed_batch(rows)
                            rows = []
                if rows:
                    yield _parsed_batch(rows)

    files = archive.records.select("file").distinct()
    n = shuffle_partitions(files.sparkSession)
    return files.repartitionByRange(n, "file").mapInArrow(run, _PARSED)


def fetch_records(archive: Archive, captures: DataFrame) -> DataFrame:
    """Records at (file, offset, length), by range reads in the order of files and offsets."""
    folder = archive.folder

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_folder(folder)
        name, held = None, None
        for batch in batches:
            rows = []
            for file, at, n in zip(*[batch.column(c).to_pylist() for c in ("file", "offset", "length")]):
                if file != name:
                    if held is not None:
                        held.close()
                    name, held = file, fs.open_input_file(f"{root}/{file}")
                held.seek(at)
                rows.append(_row(*parse_record(gzip.decompress(held.read(n)))))
            if rows:
                yield _parsed_batch(rows)

    n = shuffle_partitions(captures.sparkSession)
    return (captures.select("file", "offset", "length").repartitionByRange(n, "file", "offset")
            .sortWithinPartitions("file", "offset").mapInArrow(run, _PARSED))


def _target_key() -> Column:
    return F.udf(index_key)(F.col("to_url"), F.col("to_number"))


def read_archive(archive: Archive, index: CaptureIndex) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every record of the archive.

    Sizes and digests are those of the payload as read: of a revisit's, the payload of the response it names,
    which is looked up once. A digest that differs from the stated one, or a response that the index does not
    have, raises an error.
    """
    scanned = save(scan_records(archive), "warc-scanned")
    named = (scanned.where("kind = 'revisit'").select("to_number", "to_url").distinct()
             .select(_target_key().alias("prefix")))
    found = fetch_records(archive, find_captures(index, named))
    targets = save(found.select(F.col("number").alias("to_number"), F.col("size").alias("_size"), F.col("sha1").alias("_sha1")),
                   "warc-targets")
    rows = attach(scanned, targets, ["to_number"], F.col("number"))
    digest = F.coalesce(F.col("sha1"), F.col("_sha1"))
    wrong = F.raise_error(F.concat(F.lit("record "), F.col("number").cast("string"), F.lit(": payload missing or changed")))
    return rows.select("page_id", F.coalesce(F.col("size"), F.col("_size")).alias("payload_bytes"),
                       F.when(digest.eqNullSafe(F.col("stated")), digest).otherwise(wrong.cast("string")).alias("payload_digest"),
                       F.col("kind").alias("record_type"), F.col("to_page").alias("refers_to"))


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archive = write_archive(read_table(spark, sf_dir, "pages"), new_table_path(spark, "warc"))
    return read_archive(archive, build_index(archive, new_table_path(spark, "warc-index")))


ORACLE = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), w AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS best FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id != best THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id != best THEN best END AS refers_to
FROM w
"""
