"""Archives of web records in Zstandard: one dictionary ahead, one frame per record.

An archive starts with a skippable frame (magic 0x184D2A5D) that holds the dictionary; every
record is a frame of its own, so a reader can start at any record's offset. Records are sorted
into archives by a hash of their id; a task writes archives of bounded size into the shared
folder under names of its own and reports them, and only reported archives are read, so what a
lost or repeated task leaves behind is ignored.
"""

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.storage import qualified, scratch_dir

# The query over pages as SQL; a digest is read off five hex digits, which are four letters, at a time.
ORACLE = """
WITH payloads AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(encode(coalesce(html, ''))) AS x FROM pages
),
digests AS (
  SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
         array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
           (CAST('0x' || substr(x, 5 * (i // 4) + 1, 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31 AS BIGINT), 1)), '') AS payload_digest
  FROM payloads
),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS original FROM digests)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> original THEN original END AS refers_to
FROM firsts
"""

DICTIONARY_MAGIC = 0x184D2A5D
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
_WINDOW = 1 << 14


class BadArchive(ValueError):
    """An archive or a record that breaks the format: wrong magic, header or length."""


def _b32(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode()


def mark_revisits(pages: DataFrame, id_col: str = "page_id", payload: str = "html", least: int = 0) -> DataFrame:
    """``page_id, url, payload, refers_to``: the smallest id among equal payloads of ``least`` bytes
    or more is the response, the others refer to it.

    Digests meet in an aggregate with map-side combining, and only digests that occur twice are
    joined back, as an inner side that adaptive execution splits if one payload is very common.
    """
    rows = pages.select(
        F.col(id_col).alias("page_id"),
        F.coalesce(F.col("url"), F.lit("")).alias("url"),
        F.coalesce(F.col(payload), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("sha1", F.sha1("payload"))
    seen = (
        rows.where(F.length("payload") >= least)
        .groupBy("sha1")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select("sha1", "first")
    )
    refers = F.when(F.col("first") != F.col("page_id"), F.col("first"))
    return rows.join(seen, "sha1", "left").select("page_id", "url", "payload", refers.alias("refers_to"))


def train_dictionary(pages: DataFrame, samples: int = 400, kept: int = 4096, size: int = 16384) -> bytes:
    """A dictionary from the first ``kept`` bytes of at most ``samples`` payloads, different ones, of
    the smallest hashes. It only affects how small the archives are. Empty if there is too little to
    train on.

    Payloads are cut and all but about twice the sample are left out where they are scanned, so the
    rows that meet in one task, and those that reach the driver, do not grow with the pages."""
    share = 2 * samples / max(pages.count(), 1)
    heads = pages.select(F.substring("payload", 1, kept).alias("head")).withColumn("spot", F.pmod(F.xxhash64("head"), F.lit(1 << 30)))
    some = heads.where((F.col("spot") < int(min(share, 1.0) * (1 << 30))) & (F.length("head") > 0)).distinct()
    parts = [bytes(r["head"]) for r in some.orderBy("spot", "head").limit(samples).collect()]
    try:
        return zstandard.train_dictionary(size, parts).as_bytes()
    except zstandard.ZstdError:
        return b""


def _record_id(page_id, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page/{page_id}/{digest}')}>"


def record(page_id, url: str, payload: bytes, refers_to) -> bytes:
    """One record: header lines, a blank line, the block, two line ends. The block of a response is
    an HTTP message with the payload as its body; a revisit has none."""
    digest = _b32(hashlib.sha1(payload).digest())
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", _record_id(page_id, digest)),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Target-URI", re.sub(r"[\r\n\0]", "", url)),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("X-Page-ID", "" if page_id is None else str(page_id)),
        ("X-Payload-Length", str(len(payload))),
    ]
    block = b""
    if refers_to is None:
        block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nContent-Length: {len(payload)}\r\n\r\n".encode() + payload
    else:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", _record_id(refers_to, digest)), ("X-Refers-To-Page-ID", str(refers_to))]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """Header fields (lower-case names), ``block`` and ``payload`` of one record, with version,
    lengths and digest checked. The payload of an HTTP message is its body."""
    head, blank, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not blank or not re.fullmatch(r"WARC/1\.[01]", lines[0]):
        raise BadArchive(f"not a record: {lines[0][:40]!r}")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            raise BadArchive(f"header line without a colon: {line[:40]!r}")
        fields[name.strip().lower()] = value.strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if not fields.get(name):
            raise BadArchive(f"header {name} is missing")
    if not fields["content-length"].isdigit():
        raise BadArchive("content-length is not a number")
    n = int(fields["content-length"])
    if len(rest) != n + 4 or rest[n:] != b"\r\n\r\n":
        raise BadArchive(f"content-length {n} does not fit {len(rest)} bytes")
    block = payload = rest[:n]
    if fields["warc-type"] == "response":
        if fields.get("content-type", "").startswith("application/http"):
            _, blank, payload = block.partition(b"\r\n\r\n")
            if not blank:
                raise BadArchive("the HTTP header has no end")
        if fields.get("warc-payload-digest") != "sha1:" + _b32(hashlib.sha1(payload).digest()):
            raise BadArchive("the payload does not have the digest of the header")
        if int(fields.get("x-payload-length", len(payload))) != len(payload):
            raise BadArchive("the payload does not have the length of the header")
    return fields | {"block": block, "payload": payload}


def dictionary_frame(dictionary: bytes) -> bytes:
    return struct.pack("<II", DICTIONARY_MAGIC, len(dictionary)) + dictionary


def read_archive(data: bytes) -> Iterator[dict]:
    """The records of an archive, each with its ``offset``. Frames are fed in windows, so a record
    costs its own length and at most one window more, wherever in the archive it is."""
    view = memoryview(data)
    if len(data) < 8:
        raise BadArchive("too short for an archive")
    magic, size = struct.unpack_from("<II", data)
    if magic != DICTIONARY_MAGIC:
        raise BadArchive("no dictionary frame at the start")
    if len(data) < 8 + size:
        raise BadArchive("the dictionary frame is cut off")
    dictionary = bytes(view[8 : 8 + size])
    if dictionary[:4] == _ZSTD_MAGIC:  # a dictionary may itself be compressed
        dictionary = zstandard.ZstdDecompressor().decompressobj().decompress(dictionary)
    options = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}
    reader, at = zstandard.ZstdDecompressor(**options), 8 + size
    while at < len(data):
        frame, out, end = reader.decompressobj(), [], at
        while not frame.eof:
            if end >= len(data):
                raise BadArchive(f"the frame at {at} is cut off")
            part = view[end : end + _WINDOW]
            try:
                out.append(frame.decompress(part))
            except zstandard.ZstdError as error:
                raise BadArchive(f"bad frame at {at}: {error}") from error
            end += len(part)
        yield parse_record(b"".join(out)) | {"offset": at}
        at = end - len(frame.unused_data)


def write_archives(
    marked: DataFrame, folder: str, dictionary: bytes, archive_bytes: int = 16 << 20, level: int = 3
) -> DataFrame:
    """Write ``marked`` (of :func:`mark_revisits`) into archives of about ``archive_bytes`` under
    ``folder``, at most; return the manifest: ``path, n_records, n_bytes``. A folder without a
    scheme is on Spark's default file system, as it is for :func:`read_archives`."""
    folder = qualified(marked.sparkSession, folder)

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = pafs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        options = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}
        writer = zstandard.ZstdCompressor(level=level, **options)
        out, name, n, size = None, "", 0, 0

        def closed():
            out.close()
            return pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "n_records": [n], "n_bytes": [size]})

        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    name, n, head = f"{uuid.uuid4().hex}.warc.zst", 0, dictionary_frame(dictionary)
                    out, size = store.open_output_stream(f"{base}/{name}", compression=None), len(head)
                    out.write(head)
                frame = writer.compress(record(row["page_id"], row["url"], row["payload"], row["refers_to"]))
                out.write(frame)
                n, size = n + 1, size + len(frame)
                if size >= archive_bytes:
                    yield closed()
                    out = None
        if out is not None:
            yield closed()

    kept = marked.select("page_id", "url", "payload", F.col("refers_to"))
    return kept.mapInArrow(tasks, "path string, n_records long, n_bytes long")


def read_archives(spark: SparkSession, manifest: DataFrame, folder: str, id_type: str = "long") -> DataFrame:
    """One row per record of the archives that ``manifest`` names:
    ``page_id, url, record_type, payload_digest, payload_bytes, refers_to, payload, path, offset``."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, data in zip(batch["path"], batch["content"], strict=True):
                rows, held = [], 0
                for r in read_archive(data):
                    refers, own = r.get("x-refers-to-page-id"), r.get("x-page-id", "")
                    rows.append(
                        (own or None, r.get("warc-target-uri"), r["warc-type"],
                         r.get("warc-payload-digest", "").removeprefix("sha1:"),
                         int(r.get("x-payload-length", len(r["block"]))), refers or None,
                         r["payload"] if r["warc-type"] == "response" else None, path, r["offset"])
                    )
                    held += len(r["block"])
                    if held > 8 << 20:
                        yield pd.DataFrame(rows, columns=names)
                        rows, held = [], 0
                yield pd.DataFrame(rows, columns=names)

    names = ["page_id", "url", "record_type", "payload_digest", "payload_bytes", "refers_to", "payload", "path", "offset"]
    kinds = ["string", "string", "string", "string", "long", "string", "binary", "string", "long"]
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder).select("path", "content")
    named = manifest.select(F.element_at(F.split("path", "/"), -1).alias("name"))
    files = files.join(named, F.element_at(F.split("path", "/"), -1) == F.col("name"), "left_semi")
    rows = files.mapInPandas(parse, ", ".join(f"{n} {k}" for n, k in zip(names, kinds, strict=True)))
    return rows.withColumn("page_id", F.col("page_id").cast(id_type)).withColumn("refers_to", F.col("refers_to").cast(id_type))


def round_trip(pages: DataFrame, least: int = 0, **settings) -> DataFrame:
    """Write ``pages`` (page_id, url, html) into archives and read them back.

    Defined results: null html is an empty payload, null url an empty one; repeated rows are
    records of their own (equal ids are one response each way); a null id is written empty and
    read as null; an empty table gives no archives and no rows; other columns are ignored.
    """
    spark, id_type = pages.sparkSession, dict(pages.dtypes)["page_id"]
    marked = mark_revisits(pages, least=least)
    folder, listing = scratch_dir(spark, "warc"), scratch_dir(spark, "warc-manifest")
    plain = pages.select(F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
    write_archives(marked, folder, train_dictionary(plain), **settings).write.parquet(listing)
    manifest = spark.read.parquet(listing)
    if manifest.isEmpty():
        names = "page_id {0}, url string, record_type string, payload_digest string, payload_bytes long, refers_to {0}, payload binary, path string, offset long"
        return spark.createDataFrame([], names.format(id_type))
    return read_archives(spark, manifest, folder, id_type)
