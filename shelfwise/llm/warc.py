"""WARC archives with a two-level capture index.

Writing: every task writes one archive of gzip members, a record each, and reports
where each record lies.  Of pages with equal payloads of at least ``MIN_REVISIT``
bytes that with the smallest id is written whole and the others as revisits of it.

Index: the captures are sorted by URL key (host reversed: com,example,www)/path),
cut into blocks of ``BLOCK_LINES`` lines, each compressed by itself; a sparse
directory has the first key and the place of every block.  A lookup searches the
directory by bisection, reads the blocks that can hold the key by byte range, and
then the records by byte range.

Archives live in a folder that all executors share, through Arrow's file systems.
A task attempt writes files of its own name and the index names those of the
attempts that counted, so a lost executor leaves at most unused files.

Defined results: a null html is an empty payload, a null url has the empty key; a
null page_id is kept as null and never chosen for others to refer to; pages
that repeat the id and payload of the chosen page are written whole; an empty
table gives an empty archive.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import lru_cache
from urllib.parse import quote, urlsplit

import pandas as pd
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.common import blank_if_null, bound_batches, cut_lineage

MIN_REVISIT = 100
BLOCK_LINES = 1000
DATE = "2000-01-01T00:00:00Z"
CAPTURE = "url_key string, page_id long, file string, offset long, length long"
PART = "part int, path string, first_key string, last_key string, n_blocks int, n_records long"
READ = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def file_system(uri: str) -> tuple[arrow_fs.FileSystem, str]:
    """The file system of a folder and the folder's path in it."""
    local = re.match(r"file:/+(.*)", uri)
    if local or "://" not in uri:
        return arrow_fs.LocalFileSystem(), "/" + local[1] if local else uri
    return arrow_fs.FileSystem.from_uri(uri)


def _header_value(text: str) -> str:
    """Without white space and controls, which would end a header or a line."""
    return re.sub(r"[\x00-\x20\x7f-\xa0  ]", lambda m: quote(m[0]), text)


def url_key(url: str | None) -> str:
    """The URL with its host's parts reversed; what cannot be parsed stays."""
    if not url:
        return ""
    clean = _header_value(url)
    try:
        u = urlsplit(clean)
        host, port = (u.hostname or ""), u.port
    except ValueError:
        return clean
    rest = u.path + (f"?{u.query}" if u.query else "")
    return ",".join(reversed(host.split("."))) + (f":{port}" if port else "") + ")" + (rest or "/")


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record; a revisit has the payload's HTTP header but not the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
             f"WARC-Record-ID: <urn:x-page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_header_value(url)}")
    if refers_to is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"WARC-Refers-To: <urn:x-page:{refers_to}>"]
    lines += ["Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha256:{digest}",
              f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """The fields of READ and the payload (None for a revisit); raises on a record
    that is cut short or whose payload does not have its digest."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    size = int(fields["Content-Length"])
    if rest[size:] != b"\r\n\r\n":
        raise ValueError("record cut short")
    http, _, payload = rest[:size].partition(b"\r\n\r\n")
    number = lambda name: int(m[1]) if (m := re.search(r"x-page:(-?\d+)>", fields.get(name, ""))) else None
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    whole = fields["WARC-Type"] == "response"
    if whole and hashlib.sha256(payload).hexdigest() != digest:
        raise ValueError("payload does not have its digest")
    length = int(re.search(rb"Content-Length: (\d+)", http)[1])
    return {"page_id": number("WARC-Record-ID"), "url": fields.get("WARC-Target-URI"), "payload_bytes": length, "payload_digest": digest,
            "record_type": fields["WARC-Type"], "refers_to": number("WARC-Refers-To"), "payload": payload if whole else None}


def with_revisits(pages: DataFrame) -> DataFrame:
    """Adds ``digest`` and ``refers_to`` (null: to be written whole) to (page_id,
    url, html).  Only payloads that occur twice are joined back."""
    body = F.encode(F.col("html"), "UTF-8")
    pages = pages.select("page_id", "url", blank_if_null("html").alias("html")).withColumn("digest", F.sha2(body, 256))
    first = pages.where(F.length(body) >= MIN_REVISIT).groupBy("digest").agg(
        F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n")).where("n > 1 and first_id is not null")
    met = pages.join(first.drop("n"), "digest", "left")
    other = F.col("first_id").isNotNull() & ~F.col("first_id").eqNullSafe(F.col("page_id"))
    return met.select("page_id", "url", "html", "digest", F.when(other, F.col("first_id")).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Writes (page_id, url, html) to WARC files in ``folder`` and returns the
    captures: URL key, page_id, file, offset, length."""
    bound_batches(pages.sparkSession)
    fs, path = file_system(folder)
    fs.create_dir(path, recursive=True)

    def written(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, name, at = None, f"captures-{uuid.uuid4().hex}.warc.gz", 0
        for batch in batches:
            if out is None:
                fs, path = file_system(folder)
                out = fs.open_output_stream(f"{path}/{name}", compression=None)
            rows = []
            for page_id, url, html, digest, refers_to in zip(*(batch[c].astype(object).where(batch[c].notna(), None) for c in batch.columns)):
                page_id, refers_to = (None if x is None else int(x) for x in (page_id, refers_to))
                member = gzip.compress(record(page_id, url, html.encode(), digest, refers_to), 6, mtime=0)
                out.write(member)
                rows.append((url_key(url), page_id, name, at, len(member)))
                at += len(member)
            frame = pd.DataFrame(rows, columns=["url_key", "page_id", "file", "offset", "length"])
            yield frame.astype({"page_id": "Int64"})
        if out is not None:
            out.close()

    # ids pass through pandas as text: a null among longs would turn them into floats
    rows = with_revisits(pages).select(F.col("page_id").cast("string"), "url", "html", "digest", F.col("refers_to").cast("string"))
    return cut_lineage(rows.mapInPandas(written, CAPTURE))


def write_index(captures: DataFrame, folder: str, parts: int, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Writes the sorted index in at most ``parts`` files and returns a row per
    file; beside each lies its directory.  A URL captured very often spreads over
    several blocks and files, as the page id is part of the order."""
    def written(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part, name = TaskContext.get().partitionId(), f"index-{uuid.uuid4().hex}"
        fs, path = file_system(folder)
        out, held, directory, at, n, last = None, [], [], 0, 0, ""

        def flush() -> None:
            nonlocal at
            block = zlib.compress("\n".join("\t".join(map(str, row)) for row in held).encode())
            out.write(block)
            directory.append(f"{held[0][0]}\t{at}\t{len(block)}")
            at += len(block)
            held.clear()

        for batch in batches:
            out = out or fs.open_output_stream(f"{path}/{name}.blocks", compression=None)
            for row in zip(batch.url_key, batch.page_id, batch.file, batch.offset, batch.length):
                held.append(row)
                n, last = n + 1, row[0]
                if len(held) == block_lines:
                    flush()
        if out is None:
            return
        if held:
            flush()
        out.close()
        with fs.open_output_stream(f"{path}/{name}.directory", compression=None) as d:
            d.write("\n".join(directory).encode())
        first = directory[0].split("\t")[0]
        yield pd.DataFrame([(part, name, first, last, len(directory), n)], columns=[c.split()[0] for c in PART.split(", ")])

    order = ["url_key", "page_id", "file", "offset"]
    ranged = captures.withColumn("page_id", F.coalesce(F.col("page_id").cast("string"), F.lit("")))
    ranged = ranged.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return cut_lineage(ranged.mapInPandas(written, PART))


class IndexReader:
    """Reads blocks and records by byte range; keeps a bounded number of files
    open and of directories in memory."""

    def __init__(self, folder: str):
        self.fs, self.path = file_system(folder)
        self.opened = lru_cache(maxsize=64)(lambda name: self.fs.open_input_file(f"{self.path}/{name}"))
        self.directory = lru_cache(maxsize=16)(self._directory)

    def _directory(self, name: str) -> tuple[list[str], list[tuple[int, int]]]:
        lines = self.fs.open_input_file(f"{self.path}/{name}.directory").read().decode().split("\n")
        rows = [line.split("\t") for line in lines]
        return [r[0] for r in rows], [(int(r[1]), int(r[2])) for r in rows]

    def _range(self, name: str, offset: int, length: int) -> bytes:
        file = self.opened(name)
        file.seek(offset)
        return file.read(length)

    def block(self, name: str, number: int) -> list[list[str]]:
        """The captures of a block: [url_key, page_id, file, offset, length]."""
        raw = self._range(f"{name}.blocks", *self.directory(name)[1][number])
        return [line.split("\t") for line in zlib.decompress(raw).decode().split("\n")]

    def blocks_of(self, name: str, key: str) -> range:
        """The blocks of an index file that can hold a key, by bisection."""
        firsts = self.directory(name)[0]
        return range(max(0, bisect_left(firsts, key) - 1), bisect_right(firsts, key))

    def captures(self, name: str, key: str) -> Iterator[list[str]]:
        """The captures of a key in an index file, by bisection."""
        for number in self.blocks_of(name, key):
            rows = self.block(name, number)
            keys = [r[0] for r in rows]
            yield from rows[bisect_left(keys, key):bisect_right(keys, key)]

    def record(self, file: str, offset: str, length: str) -> dict:
        return parse_record(gzip.decompress(self._range(file, int(offset), int(length))))


def _rows(found: list[dict], more: str = "") -> pd.DataFrame:
    names = [c.split()[0] for c in (READ + more).split(", ")]
    frame = pd.DataFrame([[f[n] for n in names] for f in found], columns=names)
    return frame.astype({"page_id": "Int64", "refers_to": "Int64", "payload_bytes": "int64"})


def read_all(parts: DataFrame, folder: str) -> DataFrame:
    """Every record of the archive, block by block through the index, with its
    payload read, checked against its digest and left out."""
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = IndexReader(folder)
        for batch in batches:
            for name, number in zip(batch.path, batch.number):
                # in the order of files and places, so that a file is read onward
                rows = sorted(reader.block(name, number), key=lambda r: (r[2], int(r[3])))
                yield _rows([reader.record(*r[2:]) for r in rows])

    blocks = parts.select("path", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)).alias("number"))
    n = int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return blocks.repartition(n).mapInPandas(read, READ)


def lookup(urls: DataFrame, parts: DataFrame, folder: str, url_col: str = "url") -> DataFrame:
    """The captures of the URLs (column ``url_col``): the record's fields and
    ``payload``, which for a revisit is null.  The list of index files, whose number is a
    parameter of the writer, goes to every task; directories and blocks are read
    as needed."""
    files = [tuple(r) for r in parts.select("first_key", "last_key", "path").orderBy("part").collect()]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader, lasts, firsts = IndexReader(folder), [f[1] for f in files], [f[0] for f in files]
        for batch in batches:
            found = []
            for url in batch[url_col]:
                key = url_key(url)
                for _, _, name in files[bisect_left(lasts, key):bisect_right(firsts, key)]:
                    found += [reader.record(*r[2:]) for r in reader.captures(name, key)]
            yield _rows(found, ", payload binary")

    return urls.select(url_col).distinct().mapInPandas(read, READ + ", payload binary")


def read_urls(urls: DataFrame, parts: DataFrame, folder: str, url_col: str = "url") -> DataFrame:
    """The records of the URLs, without their payloads, which are checked against their
    digests.  Every URL's key is searched for in the list of index files and in their
    directories by bisection; the blocks found are dealt to tasks, so that a URL captured
    very often is read by many, and a task reads a block once for all keys."""
    files = [tuple(r) for r in parts.select("first_key", "last_key", "path").orderBy("part").collect()]

    def located(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader, lasts, firsts = IndexReader(folder), [f[1] for f in files], [f[0] for f in files]
        for batch in batches:
            keys = sorted({url_key(u) for u in batch[url_col]})
            yield pd.DataFrame([(key, name, number) for key in keys for _, _, name in files[bisect_left(lasts, key):bisect_right(firsts, key)]
                                for number in reader.blocks_of(name, key)], columns=["url_key", "path", "number"])

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader, held, block = IndexReader(folder), None, []
        for batch in batches:
            rows = []
            for key, name, number in zip(batch.url_key, batch.path, batch.number):
                if held != (name, number):
                    held, block = (name, number), reader.block(name, number)
                    keys = [r[0] for r in block]
                rows += block[bisect_left(keys, key):bisect_right(keys, key)]
            # in the order of files and places, so that a file is read onward
            yield _rows([reader.record(*r[2:]) for r in sorted(rows, key=lambda r: (r[2], int(r[3])))])

    n = int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = urls.select(url_col).distinct().mapInPandas(located, "url_key string, path string, number int").distinct()
    return found.repartition(n, "path", "number").sortWithinPartitions("path", "number").mapInPandas(read, READ)


def archive(pages: DataFrame, folder: str, parts: int | None = None) -> DataFrame:
    """Writes archives and index; returns the index files (see ``write_index``)."""
    parts = parts or int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return write_index(write_archives(pages, folder), folder, parts)


def new_folder(spark: SparkSession) -> str:
    """A new folder for an archive beside the checkpoints, which executors share."""
    from shelfwise.session import ensure_checkpoint_dir

    return f"{ensure_checkpoint_dir(spark)}/warc-{uuid.uuid4().hex}"


#: DuckDB SQL of what the archives hold.
ORACLE = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, octet_length(encode(html)) AS n, sha256(html) AS digest FROM p),
f AS (SELECT *, CASE WHEN n >= {MIN_REVISIT} THEN min(page_id) OVER (PARTITION BY digest) END AS first_id FROM d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN first_id IS NULL OR first_id IS NOT DISTINCT FROM page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first_id IS NOT DISTINCT FROM page_id THEN NULL ELSE first_id END AS refers_to
FROM f
"""
