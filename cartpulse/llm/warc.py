"""WARC archives from pages, and a normaliser for archives compressed as one gzip stream.

1. ``write``: one record per page, as text files that Spark's writer compresses as a whole: the
   record separator is the writer's line separator. Of records with equal payloads of at least
   ``MIN_REVISIT`` bytes that with the largest page_id is the response, the others revisit it.
2. ``normalise``: every archive is inflated once as a stream; each record is compressed as a gzip member
   of its own, and a sidecar index has offset and length of every member. Members are written with
   an empty gzip member between them as line separator, which readers of gzip skip. Archive and
   index are committed together by the task that makes them, so a lost executor leaves none half done.
3. ``read``: members are cut out of the archives by the index and parsed.

All files go through Spark's readers and writers, so they may lie in any store Spark reads.
"""

import gzip
import hashlib
import json
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartpulse.session import scratch_path, stored

MIN_REVISIT = 1000
RECORDS = 1000  # of one archive; bounds what a reading task holds
_BREAK = "\r\n"
_RECORD_END = b"\r\n\r\n"
_EMPTY_MEMBER = gzip.compress(b"", 6, mtime=0)
_READ = 1 << 18
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def with_records(pages: DataFrame) -> DataFrame:
    """(page_id, url, html, payload_bytes, digest, record_type, refers_to) of every page.

    Null html is an empty payload. Rows that repeat the largest page_id of a payload are
    all responses; where no row of it has an id, all are. Other columns are ignored."""
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long"),
        F.col("url").cast("string"),
        payload.alias("html"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        F.sha1(payload.cast("binary")).alias("digest"),
    )
    repeated = stored(
        rows.where(F.col("payload_bytes") >= MIN_REVISIT)
        .groupBy(F.col("digest").alias("of"), F.col("payload_bytes").alias("size"))
        .agg(F.max("page_id").alias("response"), F.count("*").alias("n"))
        .where("n > 1 AND response IS NOT NULL")
        .drop("n"),
        "repeated-payloads",
    )
    match = (F.col("digest") == F.col("of")) & (F.col("payload_bytes") == F.col("size"))
    revisit = F.col("response").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response"))
    return rows.join(repeated, match, "left").select(
        *rows.columns,
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("response")).alias("refers_to"),
    )


def _record_id(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:x-page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(">"))


def _record(rows: DataFrame) -> Column:
    """A WARC record without the line ends that close it."""
    url = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]", "%20")
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{_BREAK}Content-Type: text/html; charset=utf-8{_BREAK}Content-Length: "),
        F.col("payload_bytes").cast("string"),
        F.lit(_BREAK * 2),
    )
    revisit = F.col("record_type") == "revisit"
    body = F.when(revisit, http).otherwise(F.concat(http, F.col("html")))
    refers = F.concat(
        F.lit("WARC-Refers-To: "), _record_id(F.col("refers_to")),
        F.lit(f"{_BREAK}WARC-Profile: {_PROFILE}{_BREAK}"),
    )
    return F.concat(
        F.lit(f"WARC/1.1{_BREAK}WARC-Type: "), F.col("record_type"),
        F.lit(f"{_BREAK}WARC-Record-ID: "), _record_id(F.col("page_id")),
        F.lit(f"{_BREAK}WARC-Target-URI: "), url,
        F.lit(f"{_BREAK}WARC-Payload-Digest: sha1:"), F.col("digest"), F.lit(_BREAK),
        F.when(revisit, refers).otherwise(F.lit("")),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.lit(f"{_BREAK}Content-Length: "), F.octet_length(body).cast("string"), F.lit(_BREAK * 2), body,
    )


def write(pages: DataFrame, folder: str, records: int = RECORDS) -> None:
    """Archives of at most ``records`` records, each one gzip stream as a whole."""
    rows = with_records(pages)
    options = {"compression": "gzip", "lineSep": _RECORD_END.decode(), "maxRecordsPerFile": records}
    rows.select(_record(rows).alias("value")).write.options(**options).text(folder)


def _inflated(content: bytes):
    """Pieces of a gzip file of one or more members."""
    stream = zlib.decompressobj(31)
    view = memoryview(content)
    at = 0
    while at < len(view):
        piece = view[at : at + _READ]
        at += len(piece)
        while piece:
            yield stream.decompress(piece)
            piece = stream.unused_data
            if stream.eof:
                stream = zlib.decompressobj(31)


def _headers(head: bytes) -> dict[str, str]:
    pairs = (line.partition(b":") for line in head.split(b"\r\n")[1:])
    return {name.strip().lower().decode(): value.strip().decode() for name, _, value in pairs}


def split_records(pieces):
    """Whole records (headers, bytes with closing line ends) of a stream of WARC bytes; holds one record."""
    held = bytearray()
    need = None
    for piece in pieces:
        held += piece
        while True:
            if need is None:
                end = held.find(b"\r\n\r\n")
                if end < 0:
                    break
                headers = _headers(bytes(held[:end]))
                need = end + 4 + int(headers["content-length"]) + len(_RECORD_END)
            if len(held) < need:
                break
            yield headers, bytes(held[:need])
            del held[:need]
            need = None
    if held:
        raise ValueError("the archive ends within a record")


_ROWS = pa.schema([("archive", pa.string()), ("kind", pa.string()), ("nth", pa.int64()), ("value", pa.binary())])


def _normalised(batches):
    for rows in batches:
        for path, content in zip(*(c.to_pylist() for c in rows.columns), strict=True):
            archive = hashlib.sha1(path.encode()).hexdigest()
            out, size, offset, index = [], 0, 0, []
            for headers, record in split_records(_inflated(content)):
                member = gzip.compress(record, 6, mtime=0)
                entry = {"offset": offset, "length": len(member), "id": headers["warc-record-id"],
                         "type": headers["warc-type"], "digest": headers["warc-payload-digest"]}
                index.append(json.dumps(entry))
                out.append((archive, "records", len(index), member))
                offset += len(member) + len(_EMPTY_MEMBER)
                size += len(member)
                if size > 1 << 22:
                    yield pa.RecordBatch.from_pylist([dict(zip(_ROWS.names, r, strict=True)) for r in out], _ROWS)
                    out, size = [], 0
            lines = gzip.compress("\n".join(index).encode(), 6, mtime=0)
            out.append((archive, "index", 0, lines))
            yield pa.RecordBatch.from_pylist([dict(zip(_ROWS.names, r, strict=True)) for r in out], _ROWS)


def _files(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)


def normalise(spark: SparkSession, folder: str, target: str) -> None:
    """Archives below ``folder`` again as ``target``/archive=ID/kind=records, one member a record, with
    their index at kind=index: a JSON line per record."""
    files = _files(spark, folder, "*.gz").select("path", "content")
    rows = files.mapInArrow(_normalised, "archive string, kind string, nth long, value binary")
    separator = {"lineSep": _EMPTY_MEMBER.decode("latin-1"), "encoding": "latin1"}
    (
        rows.sortWithinPartitions("archive", "kind", "nth")
        .select("archive", "kind", F.col("value").cast("string").alias("value"))
        .write.partitionBy("archive", "kind")
        .options(**separator)
        .text(target)
    )


_PARSED = pa.schema(
    [("record_id", pa.string()), ("record_type", pa.string()), ("url", pa.string()), ("refers", pa.string()),
     ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("intact", pa.bool_())]
)


def _parsed(record: bytes) -> tuple:
    head, _, body = record.partition(b"\r\n\r\n")
    headers = _headers(head)
    http, _, payload = body[: -len(_RECORD_END)].partition(b"\r\n\r\n")
    digest = headers["warc-payload-digest"].removeprefix("sha1:")
    size = int(_headers(http)["content-length"])
    revisit = headers["warc-type"] == "revisit"
    intact = not payload if revisit else len(payload) == size and hashlib.sha1(payload).hexdigest() == digest
    return (headers["warc-record-id"], headers["warc-type"], headers["warc-target-uri"],
            headers.get("warc-refers-to"), size, digest, intact)


def _records(batches):
    for rows in batches:
        for content, index in zip(*(c.to_pylist() for c in rows.columns), strict=True):
            out = []
            for line in gzip.decompress(index).decode().split("\n"):
                if line:
                    entry = json.loads(line)
                    member = content[entry["offset"] : entry["offset"] + entry["length"]]
                    found = _parsed(gzip.decompress(member))
                    out.append((*found[:-1], found[-1] and found[0] == entry["id"]))
            if out:
                columns = [pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _PARSED, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, schema=_PARSED)


def read(spark: SparkSession, target: str) -> DataFrame:
    """Every record of normalised archives, found by the index: record_id, record_type, url, refers,
    payload_bytes, payload_digest, and whether payload, digest, length and index agree."""
    files = _files(spark, target, "part-*").select("archive", "kind", "content")
    records = files.where("kind = 'records'").select("archive", "content")
    index = files.where("kind = 'index'").select("archive", F.col("content").alias("index"))
    return records.join(index, "archive").select("content", "index").mapInArrow(
        _records,
        "record_id string, record_type string, url string, refers string, payload_bytes long, "
        "payload_digest string, intact boolean",
    )


def query(pages: DataFrame) -> DataFrame:
    """Writes, normalises and reads back; an empty table gives an empty result."""
    spark = pages.sparkSession
    folder, target = scratch_path(spark, "warc-whole"), scratch_path(spark, "warc")
    write(pages, folder)
    normalise(spark, folder, target)
    page = lambda c: F.regexp_extract(c, r"^<urn:x-page:(-?\d+)>$", 1).try_cast("long")
    return read(spark, target).select(
        page("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        page("refers").alias("refers_to"),
        "intact",
    )


SQL = f"""
WITH rows AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
  FROM pages
), marked AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS newest FROM rows
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= {MIN_REVISIT} AND page_id <> newest THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= {MIN_REVISIT} AND page_id <> newest THEN newest END AS refers_to,
  true AS intact
FROM marked
"""
