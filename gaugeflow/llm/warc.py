"""WARC archives and their merged capture index.

Writing: one record per page through Spark's text sink, whose line separator
is the blank lines that end a record; the sink's commit protocol makes lost
tasks harmless. An archive is bounded by bytes and by records; a record over
``ARCHIVE_BYTES`` has one of its own. Of equal payloads of at least ``MIN_REVISIT`` bytes, the one
with the smallest page_id is a ``response``, the others are ``revisit``
records that name it and carry no payload.

Reading: every archive is parsed from its bytes and gives a run of captures
sorted by URL key and time. Runs are cut at shared key boundaries, and each
key range merges its pieces of all runs with a k-way loser tree, so the
ranges in order are the globally ordered capture history. Ranges are cut on
(URL key, time, page, run), so a URL with most of the captures is spread
over many ranges; a task merges about ``RANGE_ROWS`` of them.

Defined results:

* null html: an empty payload; null url: no target URI and an empty URL key;
* null page_id: no id in the record; it is never the response of others,
  unless all of equal payloads are null, then each is a response;
* repeated rows with the smallest page_id are all responses;
* line breaks in a URL are percent-encoded, so they can not end a header;
* empty table: empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.llm.common import bound_batches, pick, stage
from gaugeflow.session import scratch_path

MIN_REVISIT = 100       # bytes
ARCHIVE_BYTES = 64 << 20  # an archive is read into memory as a whole
RECORDS_PER_FILE = 8192
RANGE_ROWS = 200_000    # captures merged by one task
EPOCH = 1_700_000_000   # of the default capture times
CRLF = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _header(name: str, value: Column) -> Column:
    """The header line, or nothing where the value is null."""
    return F.coalesce(F.concat(F.lit(name + ": "), value, F.lit(CRLF)), F.lit(""))


def with_record(pages: DataFrame, captured: Column | None = None) -> DataFrame:
    """``pages`` (page_id, url, html) with the text of each one's record.
    ``captured``: epoch seconds; by default in the order of page_id."""
    if captured is None:
        captured = F.lit(EPOCH) + F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(10**9))
    rows = pages.withColumn("html", F.coalesce("html", F.lit(""))).withColumns({
        "digest": F.sha2(F.col("html").cast("binary"), 256), "bytes": F.octet_length("html"),
        "captured": captured.cast("long")})
    # Only payloads that stand on several rows, so mostly a small table.
    first = stage(rows.filter(F.col("bytes") >= MIN_REVISIT).groupBy("digest").agg(
        F.count("*").alias("n"), F.min("page_id").alias("first")).filter("n > 1").select("digest", "first"), "warc-first")
    rows = rows.join(first, "digest", "left")
    revisit = F.coalesce(F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")), F.lit(False))
    date = F.date_format(F.to_utc_timestamp(F.timestamp_seconds("captured"), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    uri = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}"),
                    _header("Content-Length", F.col("bytes").cast("string")), F.lit(CRLF))

    def name(page: Column) -> Column:
        return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("")), F.lit(":"), F.col("digest"), F.lit(">"))

    body = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("html")))
    head = F.concat(
        F.lit(f"WARC/1.1{CRLF}WARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")), F.lit(CRLF),
        _header("WARC-Record-ID", name(F.col("page_id"))), _header("WARC-Date", date), _header("WARC-Target-URI", uri),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        _header("WARC-Refers-To", F.when(revisit, name(F.col("first")))),
        _header("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        F.lit(f"Content-Type: application/http; msgtype=response{CRLF}"),
        _header("Content-Length", F.octet_length(body).cast("string")), F.lit(CRLF))
    return rows.select("page_id", F.concat(head, body).alias("record"))


def _numbered(rows: DataFrame) -> DataFrame:
    """``record`` and the number, within the task, of the ``archive`` it goes
    to: the next one where the bytes of the last would pass ARCHIVE_BYTES."""
    most = ARCHIVE_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, size = 0, 0
        for b in batches:
            numbers = []
            for n in b.column(1).to_pylist():
                if size and size + n > most:
                    number, size = number + 1, 0
                size += n
                numbers.append(number)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(numbers, pa.int32())], ["record", "archive"])

    sized = rows.select("record", (F.octet_length("record") + len(CRLF * 2)).alias("size"))
    return sized.mapInArrow(run, "record string, archive int")


def write_archives(pages: DataFrame, path: str, captured: Column | None = None) -> None:
    """One archive file or more per task, under ``path``."""
    bound_batches(pages.sparkSession)
    rows = with_record(pick(pages, page_id="page_id", url="url", html="html"), captured)
    _numbered(rows).write.option("maxRecordsPerFile", RECORDS_PER_FILE).partitionBy("archive").text(path, lineSep=CRLF * 2)


def url_key(url: str | None) -> str:
    """Sortable form of a URL: host from the right, then path and query."""
    if not url:
        return ""
    host, path = re.match(r"(?:[A-Za-z][A-Za-z0-9+.\-]*://)?([^/?#]*)([^#]*)", url, re.S).groups()
    host = re.sub(r":(80|443)?$", "", host.rpartition("@")[2].lower())
    host = re.sub(r"^www\d*\.", "", host)
    return ",".join(reversed(host.split("."))) + ")" + (path or "/").lower()


def records(data: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, length, headers, block) of each record of an archive."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        head = data[at:end].decode("utf-8").split(CRLF)
        if not head[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        fields = {k.lower(): v for k, _, v in (x.partition(": ") for x in head[1:])}
        size = int(fields["content-length"])
        stop = end + 4 + size
        if data[stop:stop + 4] != b"\r\n\r\n":
            raise ValueError(f"record at byte {at} is cut short")
        yield at, stop + 4 - at, fields, data[end + 4:stop]
        at = stop + 4


RUN_SCHEMA = ("run string, at int, url_key string, captured string, page_id long, url string, record_type string, "
              "refers_to long, payload_bytes long, payload_digest string, offset long, length long")
_ARROW = pa.schema([(c.split(" ")[0], {"string": pa.string(), "int": pa.int32(), "long": pa.int64()}[c.split(" ")[1]])
                    for c in RUN_SCHEMA.split(", ")])


def _page(name: str | None) -> int | None:
    number = re.match(r"<urn:page:(-?\d*):", name)[1] if name else ""
    return int(number) if number else None


def _captures(path: str, data: bytes) -> list[dict]:
    out = []
    for offset, length, f, block in records(data):
        http, _, payload = block.partition(b"\r\n\r\n")
        size = int(re.search(rb"Content-Length: (\d+)", http)[1])
        kind = f["warc-type"]
        digest = f["warc-payload-digest"].removeprefix("sha256:")
        if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
            raise ValueError(f"payload of the record at byte {offset} of {path} differs from its digest")
        url = f.get("warc-target-uri")
        out.append({"url_key": url_key(url), "captured": f["warc-date"], "page_id": _page(f["warc-record-id"]), "url": url,
                    "record_type": kind, "refers_to": _page(f.get("warc-refers-to")), "payload_bytes": size,
                    "payload_digest": digest, "offset": offset, "length": length, "run": path})
    out.sort(key=_order)
    for i, r in enumerate(out):
        r["at"] = i
    return out


def _order(r: dict) -> tuple:
    return r["url_key"], r["captured"], r["page_id"] is not None, r["page_id"] or 0, r["run"], r["offset"]


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """The sorted capture run of every archive under ``path``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, data in zip(b.column(0), b.column(1), strict=True):
                yield pa.RecordBatch.from_pylist(_captures(name.as_py(), data.as_py()), _ARROW)

    bound_batches(spark)
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(run, RUN_SCHEMA)


class LoserTree:
    """Merges sorted runs: each inner node keeps the loser of its match, so
    the next row costs one comparison per level."""

    def __init__(self, runs: list[Iterable], key):
        self.key, self.runs = key, [iter(r) for r in runs]
        self.k = len(self.runs)
        self.rows: list = [None] * self.k
        self.keys: list = [None] * self.k
        self.losers = [0] * max(1, self.k)
        for i in range(self.k):
            self._advance(i)
        self.winner = self._build(1) if self.k else 0

    def _advance(self, i: int) -> None:
        self.rows[i] = row = next(self.runs[i], None)
        self.keys[i] = (1,) if row is None else (0, self.key(row))

    def _build(self, node: int) -> int:
        if node >= self.k:
            return node - self.k
        a, b = self._build(2 * node), self._build(2 * node + 1)
        if self.keys[b] < self.keys[a]:
            a, b = b, a
        self.losers[node] = b
        return a

    def __iter__(self) -> Iterator:
        while self.k and self.rows[self.winner] is not None:
            w = self.winner
            yield self.rows[w]
            self._advance(w)
            node = (w + self.k) // 2
            while node:
                if self.keys[self.losers[node]] < self.keys[w]:
                    w, self.losers[node] = self.losers[node], w
                node //= 2
            self.winner = w


def merge_runs(runs: DataFrame) -> DataFrame:
    """The globally ordered captures of a written table of runs: partition by
    partition, by URL key, capture time and page."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces: dict[str, list[dict]] = {}  # one range of the keys, see RANGE_ROWS
        for b in batches:
            for r in b.to_pylist():
                pieces.setdefault(r["run"], []).append(r)
        part = []
        for r in LoserTree(list(pieces.values()), _order):
            part.append(r)
            if len(part) == 10_000:
                yield pa.RecordBatch.from_pylist(part, _ARROW)
                part = []
        if part:
            yield pa.RecordBatch.from_pylist(part, _ARROW)

    ranges = max(1, math.ceil(runs.count() / RANGE_ROWS))
    cut = runs.repartitionByRange(ranges, "url_key", "captured", "page_id", "run", "offset")
    return cut.sortWithinPartitions("run", "at").mapInArrow(run, RUN_SCHEMA)


def capture_index(pages: DataFrame, captured: Column | None = None) -> DataFrame:
    """Writes ``pages`` as archives in the shared folder, reads them back and
    returns their merged capture index."""
    spark = pages.sparkSession
    path = scratch_path(spark, "llm-warc")
    write_archives(pages, path, captured)
    return merge_runs(stage(read_runs(spark, path), "warc-runs"))


ORACLE_SQL = f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b, sha256(coalesce(html, '')) AS digest FROM pages),
f AS (SELECT digest, min(page_id) AS first FROM p WHERE octet_length(b) >= {MIN_REVISIT} GROUP BY digest)
SELECT p.page_id, octet_length(b)::BIGINT AS payload_bytes, p.digest AS payload_digest,
       CASE WHEN f.first IS NOT NULL AND p.page_id IS DISTINCT FROM f.first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.first IS NOT NULL AND p.page_id IS DISTINCT FROM f.first THEN f.first END AS refers_to
FROM p LEFT JOIN f ON f.digest = p.digest
"""
