"""WARC archives with a two-level capture index.

Archives: each task writes one file of records, every record a gzip member of its own, so that a record is one range
read. The first level of the index holds one line per capture, sorted by reversed-host URL key, in compressed blocks; the
second level is a sparse directory with the first key, file, offset and length of each block. A lookup finds the part by
its first key, the block by binary search in the part's directory, and reads two ranges: the block and the record.

Of records with equal payloads of at least ``revisit_bytes`` bytes, those with the smallest page_id are responses (all of
them when rows repeat) and the others revisit it; a null page_id is the smallest only if all are null. Smaller payloads are
responses. A null html is an empty payload; a null URL has the empty key. Captures with equal keys are ordered by page_id.
An empty table writes no file and has an empty index. Other columns are not archived.

Files go to the folder every executor shares; a task's file has a name of its own and counts only once the task's manifest
row is stored, so a task that is run again leaves at most an unused file.
"""

from __future__ import annotations

import bisect
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseframe.llm.common import shared_folder, stored
from pulseframe.llm.url_filter import host_of

REVISIT_BYTES = 100
BLOCK_LINES = 1000
LOOKUP_SPLITS = 64  # the distinct keys asked of one part are spread over so many rows
_CAPTURE = "surt string, page_id long, file string, offset long, length long"


@dataclass(frozen=True)
class Archive:
    """Folder of the files; ``directory`` has one row per index block: part, first and last key, file, offset, length."""

    folder: str
    directory: DataFrame


def surt_key(url: Column) -> Column:
    """com,example,www)/path?query: the reversed host, then the rest without the fragment."""
    host = F.split_part(host_of(url), F.lit(":"), F.lit(1))
    rest = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^#]*)", 1)
    return F.coalesce(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest), F.lit(")"))


def gzip_member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def unpack(data: bytes) -> bytes:
    return zlib.decompress(data, 31)


def record(kind: str, page_id: int | None, url: str | None, payload: bytes, size: int, digest: str, refers_to: int | None) -> bytes:
    """One WARC record; a revisit has the headers of the payload it refers to and no payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    block = http + (payload if kind == "response" else b"")
    number = "" if page_id is None else str(page_id)
    target = (url or "").replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{number}')}>",
        "WARC-Date: 2026-01-01T00:00:00Z", f"WARC-Target-URI: {target}", f"X-Page-ID: {number}",
        f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {size}", "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if kind == "revisit":
        head[2:2] = ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                     f"WARC-Refers-To: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{refers_to}')}>", f"X-Refers-To-Page: {refers_to}"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """(headers, payload)."""
    head, _, rest = data.partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "")
                   for line in head.decode("utf-8", "surrogatepass").split("\r\n")[1:])
    block = rest[: int(headers["Content-Length"])]
    return headers, block.partition(b"\r\n\r\n")[2]


def opened(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder if "://" in folder else "file://" + folder.removeprefix("file:"))


def write_archive(pages: DataFrame, revisit_bytes: int = REVISIT_BYTES, block_lines: int = BLOCK_LINES) -> Archive:
    """Write the records of ``pages`` (page_id, url, html) and their index."""
    spark = pages.sparkSession
    folder = shared_folder(spark, "warc")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumns({"size": F.octet_length("html").cast("long"), "digest": F.sha2("html", 256)})
    firsts = (rows.filter(F.col("size") >= revisit_bytes).groupBy("digest")
              .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"))
    rows = rows.join(firsts, "digest", "left")
    rows = rows.withColumn("refers_to", F.when((F.col("size") >= revisit_bytes) & ~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id")))
    rows = rows.select("page_id", "url", F.when(F.col("refers_to").isNull(), F.col("html")).alias("html"), "size", "digest", "refers_to",
                       surt_key(F.col("url")).alias("surt"))

    def archived(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, base = opened(folder)
        out, name, at = None, f"part-{uuid.uuid4().hex}.warc.gz", 0
        for batch in batches:
            found = []
            for page_id, url, html, size, digest, refers_to, surt in batch.itertuples(index=False):
                page_id, refers_to = (None if pd.isna(x) else int(x) for x in (page_id, refers_to))
                payload = html.encode("utf-8", "surrogatepass") if isinstance(html, str) else b""
                data = gzip_member(record("response" if refers_to is None else "revisit", page_id,
                                          url if isinstance(url, str) else None, payload, size, digest, refers_to))
                if out is None:
                    files.create_dir(base, recursive=True)
                    out = files.open_output_stream(f"{base}/{name}", compression=None)
                out.write(data)
                found.append((surt, page_id, name, at, len(data)))
                at += len(data)
            if found:
                yield pd.DataFrame(found, columns=["surt", "page_id", "file", "offset", "length"]).astype({"page_id": "Int64"})
        if out is not None:
            out.close()

    captures = stored(rows.mapInPandas(archived, _CAPTURE), "captures")

    def indexed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, base = opened(folder)
        part = uuid.uuid4().hex
        out, at, waiting = None, 0, []

        def block() -> pd.DataFrame:
            nonlocal out, at
            lines, rest = waiting[:block_lines], waiting[block_lines:]
            data = gzip_member("\n".join(json.dumps(x) for x in lines).encode())
            if out is None:
                files.create_dir(base, recursive=True)
                out = files.open_output_stream(f"{base}/index-{part}.cdx.gz", compression=None)
            out.write(data)
            row = (part, lines[0][0], lines[-1][0], f"index-{part}.cdx.gz", at, len(data), len(lines))
            at += len(data)
            waiting[:] = rest
            return pd.DataFrame([row], columns=["part", "first_key", "last_key", "file", "offset", "length", "lines"])

        for batch in batches:
            ids = [None if pd.isna(x) else int(x) for x in batch["page_id"]]
            waiting += zip(batch["surt"], ids, batch["file"], batch["offset"].tolist(), batch["length"].tolist())
            while len(waiting) >= block_lines:
                yield block()
        if waiting:
            yield block()
        if out is not None:
            out.close()

    # The order of the columns keeps equal keys together in page order; sorting by all of them splits even one hot key.
    laid = captures.repartitionByRange("surt", "page_id", "file", "offset").sortWithinPartitions("surt", "page_id", "file", "offset")
    directory = laid.mapInPandas(indexed, "part string, first_key string, last_key string, file string, offset long, length long, lines long")
    return Archive(folder, stored(directory, "directory"))


def _range(files: fs.FileSystem, open_files: dict, path: str, offset: int, length: int) -> bytes:
    if path not in open_files:
        if len(open_files) > 64:
            open_files.popitem()[1].close()
        open_files[path] = files.open_input_file(path)
    return open_files[path].read_at(length, offset)


_RECORD = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, digest_ok boolean")


def _read(files: fs.FileSystem, base: str, open_files: dict, file: str, offset: int, length: int) -> tuple:
    headers, payload = parse_record(unpack(_range(files, open_files, f"{base}/{file}", offset, length)))
    kind, number, refers = headers["WARC-Type"], headers["X-Page-ID"], headers.get("X-Refers-To-Page")
    stated = headers["WARC-Payload-Digest"].removeprefix("sha256:")
    if kind == "response":
        size, digest = len(payload), hashlib.sha256(payload).hexdigest()
    else:
        size, digest = int(headers["X-Payload-Length"]), stated
    url = headers["WARC-Target-URI"].replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")
    return (int(number) if number else None, url, size, digest, kind, int(refers) if refers else None, digest == stated)


_COLUMNS = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "digest_ok"]


def read_archive(archive: Archive) -> DataFrame:
    """Every record, read through the index: a task takes blocks of the directory, unpacks them and range-reads each record.

    All blocks are wanted, so nothing is searched; ``lookup`` searches the directory by key.
    """
    folder = archive.folder

    def records(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, base = opened(folder)
        open_files: dict = {}
        for batch in batches:
            for file, offset, length in zip(batch["file"], batch["offset"], batch["length"]):
                lines = [json.loads(x) for x in unpack(_range(files, open_files, f"{base}/{file}", offset, length)).split(b"\n")]
                lines.sort(key=lambda x: (x[2], x[3]))  # sequential inside each archive file
                found = [_read(files, base, open_files, *line[2:]) for line in lines]
                yield pd.DataFrame(found, columns=_COLUMNS).astype({"page_id": "Int64", "refers_to": "Int64"})

    blocks = archive.directory.select("file", "offset", "length")
    tasks = max(2, int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return blocks.repartition(tasks).mapInPandas(records, _RECORD)


def lookup(archive: Archive, urls: DataFrame, url: str = "url") -> DataFrame:
    """Records of the given URLs: (key string, and the columns of a record). Equal keys return all their captures.

    Parts are few (one per index task), so their bounds are joined as a range; each part's directory is then read by the
    tasks that need it and searched by bisection, and only the blocks that can hold a key are read.
    """
    folder = archive.folder
    parts = archive.directory.groupBy("part").agg(
        F.min("first_key").alias("low"), F.max("last_key").alias("high"),
        F.array_sort(F.collect_list(F.struct("first_key", "last_key", "file", "offset", "length"))).alias("blocks"))
    keys = urls.select(surt_key(F.col(url)).alias("key")).distinct()
    wanted = keys.join(F.broadcast(parts.select("part", "low", "high")), (F.col("key") >= F.col("low")) & (F.col("key") <= F.col("high")))
    wanted = (wanted.groupBy("part", F.pmod(F.xxhash64("key"), F.lit(LOOKUP_SPLITS)).alias("split")).agg(F.collect_list("key").alias("keys"))
              .join(parts.select("part", "blocks"), "part"))

    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, base = opened(folder)
        open_files: dict = {}
        for batch in batches:
            for keys, blocks in zip(batch["keys"], batch["blocks"]):
                lows, highs, rows, need = [b["first_key"] for b in blocks], [b["last_key"] for b in blocks], [], {}
                for key in keys:
                    for i in range(bisect.bisect_left(highs, key), bisect.bisect_right(lows, key)):
                        need.setdefault(i, set()).add(key)
                for i, asked in need.items():
                    b = blocks[i]
                    for line in unpack(_range(files, open_files, f"{base}/{b['file']}", b["offset"], b["length"])).split(b"\n"):
                        surt, _, *place = json.loads(line)
                        if surt in asked:
                            rows.append((surt, *_read(files, base, open_files, *place)))
                yield pd.DataFrame(rows, columns=["key", *_COLUMNS]).astype({"page_id": "Int64", "refers_to": "Int64"})

    return wanted.select("keys", "blocks").mapInPandas(found, "key string, " + _RECORD)
