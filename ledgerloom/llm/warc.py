"""WARC archives: records written, monolithic gzip files normalised, records read back.

A WARC file compressed as one gzip stream can only be read from its start. The
normaliser inflates such a stream once, writes every record as a gzip member of
its own and a sidecar index with the offset and length of each member, so that
any record can be read alone. Archives may be of any writer: any version 1 of the
format, records of all types (copied byte for byte), field names in any case, one
gzip member or many, or no compression at all. Files live in the shared folder; a
task streams through them and holds one record at a time. Names carry a random
part, so a task that runs twice leaves a file that nobody lists.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm.files import opened
from ledgerloom.session import scratch_dir

FILE_BYTES = 32 << 20
_CHUNK = 1 << 20
# Fixed values of the format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
#: A field of our own, where the page's URL is not one that a header can hold.
EXACT_URL = "WARC-X-Page-URL"
PAGE_ID = "urn:page:"

_UNSAFE = re.compile(r"[\x00-\x20\x7f-\x9f]+")
_VERSION = re.compile(rb"WARC/1\.\d+\s*$")
_LENGTH = re.compile(rb"^content-length[ \t]*:[ \t]*(\d+)[ \t]*\r?$", re.I | re.M)
_END = re.compile(rb"\r?\n\r?\n")
_GAP = re.compile(rb"[\r\n]*")


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(kind: str, page_id, url: str | None, digest: str, size: int, payload: bytes, refers_to=None) -> bytes:
    """One record: a response with its payload, or a revisit with the HTTP headers only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + payload if kind == "response" else http
    header = {
        "WARC-Type": kind,
        "WARC-Record-ID": f"<urn:page:{page_id}>",
        "WARC-Date": DATE,
        "WARC-Payload-Digest": f"sha1:{digest}",
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": len(block),
    }
    if url is not None:
        header["WARC-Target-URI"] = _UNSAFE.sub(lambda m: quote(m[0]), url) or "about:blank"
        if header["WARC-Target-URI"] != url:
            header[EXACT_URL] = json.dumps(url)
    if kind == "revisit":
        header["WARC-Profile"] = REVISIT_PROFILE
        header["WARC-Refers-To"] = f"<urn:page:{refers_to}>"
    lines = "".join(f"{name}: {value}\r\n" for name, value in header.items())
    return VERSION + b"\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes, int]:
    """Header fields (names in lower case), block and length without the closing lines of the record
    at the start of ``data``."""
    end = _END.search(data)
    if end is None:
        raise ValueError("not a record: no end of its header")
    first, *lines = re.split(r"\r?\n", data[: end.start()].decode("utf-8", "replace"))
    if not _VERSION.match(first.encode()):
        raise ValueError(f"not a record: {first!r}")
    header: dict[str, str] = {}
    name = ""
    for line in lines:
        if line[:1] in " \t" and name:
            header[name] += " " + line.strip()
            continue
        name, _, value = line.partition(":")
        name = name.strip().lower()
        header.setdefault(name, value.strip())
    size = int(header["content-length"])
    block = data[end.end() : end.end() + size]
    if len(block) < size:
        raise ValueError("the record is cut off")
    return header, block, end.end() + size


def target_url(header: dict[str, str]) -> str | None:
    """The URL of a record as text; None if it has none."""
    if EXACT_URL.lower() in header:
        return json.loads(header[EXACT_URL.lower()])
    url = header.get("warc-target-uri")
    return url[1:-1] if url and url.startswith("<") and url.endswith(">") else url


def inflated(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """The bytes of a gzip stream, whatever its members, inflated once; other streams as they are."""
    inflate, begun, plain = zlib.decompressobj(31), b"", None
    for chunk in chunks:
        if plain is None:
            begun += chunk
            if len(begun) < 2:
                continue
            plain, chunk = begun[:2] != b"\x1f\x8b", begun
        if plain:
            yield chunk
            continue
        while chunk:
            yield inflate.decompress(chunk)
            chunk = inflate.unused_data
            if inflate.eof:
                # Members may be padded with zeros.
                inflate, chunk = zlib.decompressobj(31), chunk.lstrip(b"\0")


def inflated_records(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """Whole records, each with its closing lines, one at a time."""
    held, need = bytearray(), 0
    for chunk in inflated(chunks):
        held += chunk
        while held and len(held) >= need:
            del held[: _GAP.match(held).end()]
            end = _END.search(held)
            if end is None:
                break
            size = _LENGTH.search(held, 0, end.start() + 2)
            if size is None:
                raise ValueError("a record without a length")
            need = end.end() + int(size[1])
            # What closes a record may come with a later chunk, or not at all.
            if len(held) < need:
                break
            yield bytes(held[:need]) + b"\r\n\r\n"
            del held[:need]
            need = 0
    if held.strip(b"\r\n"):
        raise ValueError("the last record is cut off")


def _chunks(system, path: str) -> Iterator[bytes]:
    with system.open_input_stream(path, compression=None) as f:
        while chunk := f.read(_CHUNK):
            yield chunk


def write_archives(pages: DataFrame, folder: str, revisit_min_bytes: int = 0, file_bytes: int = FILE_BYTES,
                   id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write a record per row into WARC files of one gzip stream each; the list of files.

    Of rows with equal payloads of at least ``revisit_min_bytes`` the one with
    the largest id is a response, the others are revisits of it; rows with that
    same id are all responses. Null html is an empty payload, a null url is
    kept as null, rows with null ids revisit a row with an id if there is one.
    Digests are grouped before the payload is joined, so a group of copies is
    one row per task there, and the join is one that Spark splits.
    """
    html = F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), html.alias("payload"))
    rows = rows.withColumn("sha", F.sha1("payload"))
    groups = (
        rows.where(F.length("payload") >= revisit_min_bytes)
        .groupBy("sha")
        .agg(F.max("id").alias("keeper"), F.count("*").alias("n"))
        .where("n > 1")
    )
    revisit = F.col("keeper").isNotNull() & ~F.col("id").eqNullSafe(F.col("keeper"))
    placed = rows.join(groups, "sha", "left").select("id", "url", "payload", F.when(revisit, F.col("keeper")).alias("refers"))

    def write(batches):
        system, base = opened(folder)
        system.create_dir(base, recursive=True)
        out = stream = None
        for batch in batches:
            for i in range(batch.num_rows):
                page_id, url, payload, refers = (batch.column(c)[i].as_py() for c in range(4))
                if out is None:
                    name = f"part-{uuid.uuid4().hex}.warc.gz"
                    out, stream, total, n = system.open_output_stream(f"{base}/{name}", compression=None), zlib.compressobj(1, wbits=31), 0, 0
                kind = "response" if refers is None else "revisit"
                data = record_bytes(kind, page_id, url, base32_sha1(payload), len(payload), payload, refers)
                out.write(stream.compress(data))
                total, n = total + len(data), n + 1
                if total >= file_bytes:
                    out.write(stream.flush())
                    out.close()
                    yield _listed(name, n)
                    out = None
        if out is not None:
            out.write(stream.flush())
            out.close()
            yield _listed(name, n)

    spark = pages.sparkSession
    listing = scratch_dir(spark, "warc-files")
    placed.mapInArrow(write, "file string, records long").write.parquet(listing)
    return spark.read.parquet(listing).select(F.concat(F.lit(f"{folder}/"), "file").alias("file"), "records")


def _listed(name: str, n: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n], pa.int64())], ["file", "records"])


def normalise(files: DataFrame, folder: str) -> DataFrame:
    """Rewrite WARC files (column ``file``) of any writer record by record; the list of new files.

    Records of all types are kept byte for byte. Each new file ``x`` has a sidecar ``x.idx``: a line of JSON per record with
    its offset, length, id, type and URL. The list has ``file``, ``index`` and
    ``records``.
    """

    def rewrite(batches):
        target, base = opened(folder)
        target.create_dir(base, recursive=True)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                name = f"part-{uuid.uuid4().hex}.warc.gz"
                at = n = 0
                source, inner = opened(path)
                with target.open_output_stream(f"{base}/{name}", compression=None) as out, target.open_output_stream(f"{base}/{name}.idx", compression=None) as index:
                    for data in inflated_records(_chunks(source, inner)):
                        header, _, _ = parse_record(data)
                        member = zlib.compress(data, 6, 31)
                        out.write(member)
                        line = {"offset": at, "length": len(member), "id": header.get("warc-record-id"), "type": header.get("warc-type"), "url": target_url(header)}
                        index.write(json.dumps(line).encode() + b"\n")
                        at, n = at + len(member), n + 1
                yield _listed(name, n)

    spark = files.sparkSession
    listing = scratch_dir(spark, "warc-index")
    files.select("file").repartition(_spread(files)).mapInArrow(rewrite, "file string, records long").write.parquet(listing)
    path = F.concat(F.lit(f"{folder}/"), "file")
    return spark.read.parquet(listing).select(path.alias("file"), F.concat(path, F.lit(".idx")).alias("index"), "records")


#: Files that one task goes through where there are more files than a few per core.
TASK_FILES = 8


def _spread(files: DataFrame) -> int:
    """Tasks for these files: one for each while they are few, then one for several."""
    n, cores = files.count(), files.sparkSession.sparkContext.defaultParallelism
    return max(1, min(n, max(4 * cores, -(-n // TASK_FILES))))


def read_archives(files: DataFrame) -> DataFrame:
    """Records of normalised files, each inflated alone at its offset.

    Returns ``record_id``, ``url``, ``record_type``, ``payload_bytes`` and
    ``payload_digest`` of the full payload, ``refers_to`` (the id a revisit refers
    to), ``payload`` (null for revisits) and ``intact``. The payload of a response is
    what follows its HTTP header, that of other records the whole block; a revisit
    has the size and digest that its headers state, null if they do not. ``intact``
    says whether a payload has the digest of its header, null without one in SHA-1.
    A record without an id, type or URL has null there.
    """
    schema = "record_id string, url string, record_type string, payload_bytes long, payload_digest string, refers_to string, payload binary, intact boolean"

    def read(batches):
        for batch in batches:
            for path, index in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                system, inner = opened(path)
                rows, size = [], 0
                with system.open_input_file(inner) as f, system.open_input_stream(opened(index)[1], compression=None) as lines:
                    for line in _lines(lines):
                        entry = json.loads(line)
                        f.seek(entry["offset"])
                        data = zlib.decompress(f.read(entry["length"]), 31)
                        rows.append(_row(data))
                        size += len(data)
                        if size > 1 << 22:
                            yield _rows(rows)
                            rows, size = [], 0
                yield _rows(rows)

    return files.select("file", "index").repartition(_spread(files)).mapInArrow(read, schema)


def _lines(stream) -> Iterator[bytes]:
    held = b""
    while chunk := stream.read(_CHUNK):
        *whole, held = (held + chunk).split(b"\n")
        yield from whole


def _bare(identifier: str | None) -> str | None:
    """A record's id without its brackets, a page's id without its scheme."""
    return identifier and identifier.removeprefix("<").removesuffix(">").removeprefix(PAGE_ID)


def _row(data: bytes) -> tuple:
    header, block, _ = parse_record(data)
    kind, stated = header.get("warc-type"), header.get("warc-payload-digest")
    algorithm, _, digest = (stated or "").rpartition(":")
    http = _END.search(block) if block.startswith(b"HTTP/") else None
    url, refers = target_url(header), _bare(header.get("warc-refers-to"))
    if kind == "revisit":
        size = _LENGTH.search(block, 0, http.start() + 2) if http else None
        return _bare(header.get("warc-record-id")), url, kind, int(size[1]) if size else None, digest or None, refers, None, None
    payload = block[http.end() :] if http else block
    real = base32_sha1(payload)
    intact = real == digest.upper() if algorithm.lower() == "sha1" and len(digest) == len(real) else None
    return _bare(header.get("warc-record-id")), url, kind, len(payload), real, refers, payload, intact


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    names = ["record_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload", "intact"]
    kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary(), pa.bool_()]
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)
