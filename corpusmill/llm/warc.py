"""WARC archives of pages, and their index by external merge.

Writing: pages with equal payloads become one response record and revisit records
that refer to it.  Records are rendered by DataFrame functions and written by
Spark's text writer, whose line separator is the end of a WARC record, so archives
go to any file system that Spark writes to.  Each task writes its captures in the
order of URL key and time, in files of a bounded number of records.

Reading: archives are parsed record by record by their Content-Length; a response's
length and digest come from its payload, a revisit's from its headers.

Index: each archive is a locally sorted run of captures.  Runs are cut at common
range bounds of (URL key, time, page); each range is one task, which merges the
runs' parts through a loser tree, streaming its result.  Ranges are in global
order, so the files of the result, read in order, are the capture histories.

Scale: a payload that many pages share is a skewed join key that can be split (the
other side has one row); bounds include time and page, so one URL with very many
captures spreads over ranges.  A task holds one archive, or one range's index rows.

Defined results: a null html is an empty payload; a null URL has no target header
and sorts first; a null page id is a record without id: never the first of equal
payloads unless all their ids are null, and then all are responses.  Repeated rows
with the smallest id are all responses.  Payloads shorter than ``least_bytes`` are
always responses.  Extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm.common import scratch, stored

#: Records in one archive at most.
ARCHIVE_RECORDS = 2000

# ---- fixed values: the WARC format ----------------------------------------------------------------------------------
VERSION, EOL, RECORD_END = "WARC/1.1", "\r\n", "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_ID = "<urn:x-page:{}>"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
# ---------------------------------------------------------------------------------------------------------------------
CAPTURE = ("urlkey string, captured string, page_id {id}, url string, record_type string, payload_digest string, "
           "payload_bytes long, refers_to {id}, archive string, offset long")


def base32_sha1(payload: Column) -> Column:
    """The bare upper-case base32 SHA-1 of a string's UTF-8 bytes."""
    digest = F.sha1(payload.cast("binary"))
    fives = [F.lpad(F.conv(F.substring(digest, k, 5), 16, 32), 4, "0") for k in range(1, 41, 5)]
    return F.translate(F.concat(*fives), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def url_key(url: Column) -> Column:
    """A sort key: the host's labels from the top down, then the rest, lower-cased; empty for null."""
    rest = F.regexp_replace(F.lower(F.coalesce(url, F.lit(""))), r"^[^:/?#]*://", "")
    host = F.regexp_replace(F.regexp_extract(rest, r"^[^/?#]*", 0), r"^www\d*\.", "")
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), F.regexp_extract(rest, r"^[^/?#]*(.*)$", 1))


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit(EOL))


def records(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", captured: str | None = None,
            least_bytes: int = 0) -> DataFrame:
    """``(urlkey, captured, page_id, value)``: a rendered record for each page, without its end.

    Without a column ``captured`` a page's time is its id in seconds after the year 2000.
    """
    moment = F.col(captured) if captured else F.timestamp_seconds(F.lit(946684800) + F.coalesce(F.col(page_id).cast("long"), F.lit(0)))
    # a line break can't be part of a header
    safe = F.replace(F.replace(F.col(url), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    rows = pages.select(F.col(page_id).alias("page_id"), safe.alias("url"), F.coalesce(F.col(html), F.lit("")).alias("payload"),
                        F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("captured"))
    rows = rows.withColumn("same", F.sha2("payload", 256)).withColumn("bytes", F.octet_length("payload").cast("long"))
    first = (rows.where(F.col("bytes") >= least_bytes).groupBy("same").agg(F.min("page_id").alias("first"))
             .withColumnRenamed("same", "of"))
    joined = rows.join(first, (F.col("same") == F.col("of")), "left")
    revisit = F.coalesce(~F.col("page_id").eqNullSafe(F.col("first")) & F.col("first").isNotNull(), F.lit(False))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{EOL}Content-Type: text/html; charset=utf-8{EOL}"), _line("Content-Length", F.col("bytes").cast("string")), F.lit(EOL))
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("payload")))
    head = F.concat(
        F.lit(VERSION + EOL), _line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        F.coalesce(_line("WARC-Record-ID", F.concat(F.lit("<urn:x-page:"), F.col("page_id").cast("string"), F.lit(">"))), F.lit("")),
        F.coalesce(_line("WARC-Date", F.col("captured")), F.lit("")), F.coalesce(_line("WARC-Target-URI", F.col("url")), F.lit("")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32_sha1(F.col("payload")))),
        F.when(revisit, F.concat(_line("WARC-Profile", F.lit(REVISIT_PROFILE)),
                                 _line("WARC-Refers-To", F.concat(F.lit("<urn:x-page:"), F.col("first").cast("string"), F.lit(">"))))).otherwise(F.lit("")),
        F.lit("Content-Type: application/http; msgtype=response" + EOL), _line("Content-Length", F.octet_length(block).cast("string")), F.lit(EOL))
    return joined.select(url_key(F.col("url")).alias("urlkey"), "captured", "page_id", F.concat(head, block).alias("value"))


def write_archives(rendered: DataFrame, path: str, archive_records: int = ARCHIVE_RECORDS) -> None:
    """Write records as gzipped archives, each sorted by URL key, time and page."""
    (rendered.sortWithinPartitions("urlkey", "captured", "page_id").select("value").write.option("lineSep", RECORD_END)
     .option("compression", "gzip").option("maxRecordsPerFile", archive_records).text(path))


def parse(data: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """``(offset, headers, block)`` of each record of an archive's uncompressed bytes."""
    at = 0
    while at < len(data):
        stop = data.index(b"\r\n\r\n", at)
        lines = data[at:stop].decode().split(EOL)
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
        start = stop + 4
        end = start + int(headers["content-length"])
        if data[end:end + 4] != RECORD_END.encode():
            raise ValueError(f"record at byte {at} has another length than it says")
        yield at, headers, data[start:end]
        at = end + 4


def _page(value: str | None) -> str | None:
    m = re.fullmatch(r"<urn:x-page:(.*)>", value or "")
    return m[1] if m else None


def read_archives(spark: SparkSession, path: str, id_type: str = "bigint") -> DataFrame:
    """A capture for each record of the archives below ``path``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, content in zip(b.column("path"), b.column("content"), strict=True):
                rows = []
                for offset, h, block in parse(zlib.decompress(content.as_buffer(), wbits=47)):
                    http, _, payload = block.partition(b"\r\n\r\n")
                    if h["warc-type"] == "revisit":
                        digest = h["warc-payload-digest"].removeprefix("sha1:")
                        size = int(re.search(rb"(?im)^content-length: *(\d+)", http)[1])
                    else:
                        digest, size = base64.b32encode(hashlib.sha1(payload).digest()).decode(), len(payload)
                        if h["warc-payload-digest"] != f"sha1:{digest}":
                            raise ValueError(f"{name}: the payload at byte {offset} isn't the one written")
                    rows.append((h.get("warc-date"), _page(h.get("warc-record-id")), h.get("warc-target-uri"), h["warc-type"],
                                 digest, size, _page(h.get("warc-refers-to")), name.as_py(), offset))
                names = ["captured", "page", "url", "record_type", "payload_digest", "payload_bytes", "refers", "archive", "offset"]
                kinds = [pa.string()] * 5 + [pa.int64()] + [pa.string()] * 2 + [pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                                                 if rows else [pa.array([], k) for k in kinds], names=names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("path", "content")
    found = files.mapInArrow(run, "captured string, page string, url string, record_type string, payload_digest string, "
                                  "payload_bytes long, refers string, archive string, offset long")
    return found.select(url_key(F.col("url")).alias("urlkey"), "captured", F.col("page").cast(id_type).alias("page_id"), "url", "record_type",
                        "payload_digest", "payload_bytes", F.col("refers").cast(id_type).alias("refers_to"), "archive", "offset")


class LoserTree:
    """Merges sorted runs: each inner node holds the run that lost there, so the next
    smallest needs one comparison for each level on the path of the last winner."""

    def __init__(self, runs: Iterable[Iterable], key):
        self.runs = [iter(r) for r in runs]
        self.key = key
        self.head: list[tuple | None] = [self._next(k) for k in range(len(self.runs))]
        self.losers = [-1] * max(1, len(self.runs))
        for k in range(len(self.runs)):
            self._play(k, building=True)

    def _next(self, run: int) -> tuple | None:
        row = next(self.runs[run], None)
        return None if row is None else (self.key(row), run, row)

    def _beats(self, a: int, b: int) -> bool:
        if self.head[a] is None or self.head[b] is None:
            return self.head[b] is None and (self.head[a] is not None or a < b)
        return self.head[a][:2] < self.head[b][:2]

    def _play(self, run: int, building: bool = False) -> None:
        """Take ``run`` up from its leaf; losers stay, the winner goes to the top (place 0)."""
        node = (run + len(self.runs)) // 2
        while node > 0:
            other = self.losers[node]
            if other < 0 and building:  # the first to come waits for its opponent
                self.losers[node] = run
                return
            if self._beats(other, run):
                self.losers[node], run = run, other
            node //= 2
        self.losers[0] = run

    def __iter__(self) -> Iterator:
        while self.runs and self.head[top := self.losers[0]] is not None:
            yield self.head[top][2]
            self.head[top] = self._next(top)
            self._play(top)


def merge_index(captures: DataFrame) -> DataFrame:
    """Captures in global order of URL key, time and page, merged from the archives' sorted runs.

    The rows of the result's partitions, one after the other, are in order; nulls come first.
    """
    schema = captures.schema
    names = schema.fieldNames()
    key_at = [names.index(n) for n in ("urlkey", "captured", "page_id", "offset")]
    run_at = names.index("archive")

    def key(row: tuple) -> tuple:
        return tuple((row[k] is not None, row[k]) if row[k] is not None else (False,) for k in key_at)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs: dict[str, list[tuple]] = {}
        kinds = None
        for b in batches:
            kinds = b.schema
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                runs.setdefault(row[run_at], []).append(row)
        if kinds is None:
            return
        for rows in runs.values():
            rows.sort(key=key)  # a run comes in its own order, so this only checks it - unless a fetch was repeated
        out: list[tuple] = []
        for row in LoserTree(runs.values(), key):
            out.append(row)
            if len(out) == 5000:
                yield _batch(out, kinds)
                out = []
        if out:
            yield _batch(out, kinds)

    # bounds that all runs share: Spark samples the keys of the stored captures
    order = ["urlkey", "captured", "page_id", "offset"]
    return captures.repartitionByRange(*order).mapInArrow(run, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], names=schema.names)


def archive_and_index(pages: DataFrame, path: str | None = None, least_bytes: int = 0, archive_records: int = ARCHIVE_RECORDS,
                      **columns: str) -> DataFrame:
    """Write ``pages`` to archives, read them back, and return the merged index."""
    spark = pages.sparkSession
    path = path or scratch(spark, "warc")
    rendered = records(pages, least_bytes=least_bytes, **columns)
    write_archives(rendered, path, archive_records)
    id_type = pages.schema[columns.get("page_id", "page_id")].dataType.simpleString()
    return merge_index(stored(read_archives(spark, path, id_type), "captures"))
