"""WARC archives with an external capture index.

Archives are written by the text sink, whose separator is the blank lines that end a WARC record, so they go through Spark's commit
protocol to any file system. They are read back whole, file by file, and each file yields a run of index entries in order of
URL key and time. A task merges the runs of its archives by a tree of losers; what it makes is range-partitioned by that order and
merged, range by range, by a tree again.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterable, Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..deploy import ship
from .common import Saved, scratch_path

# Fixed values of the WARC 1.1 format.
END = "\r\n\r\n"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: Bytes that an archive is meant to have, and that it has at most if it holds several records: each is read back whole. Entries of a range
#: of the index, and of a run that a task merges from its archives.
ARCHIVE_BYTES, MOST_BYTES, RANGE_ROWS, RUN_ROWS = 16 << 20, 1 << 30, 50_000, 200_000
#: Records are written by classes of payload sizes, so that few large ones among many small ones make no archive too large to read.
CLASSES = [0, 1 << 18, 1 << 24, 1 << 40]
#: Bytes that a record's headers take, of which urls may take some.
HEADERS = 4096
#: Rows of the table of revisits that are broadcast, about 64 MB; a larger one is shuffled.
BROADCAST_ROWS = 1_000_000
#: Without a capture time of its own, a page is taken as captured so many seconds after this one as its id says.
EPOCH = 1_700_000_000

ENTRY = "urlkey string, captured string, page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, archive string, offset long, length long"


def base32_sha1(data: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: 40 bits at a time, through the digits 0-9A-V."""
    digest = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _records(pages: DataFrame, revisits: DataFrame, broadcast: bool) -> DataFrame:
    """One WARC record per page, as text without its end."""
    line = lambda name, value: F.concat(F.lit(name + ": "), value, F.lit("\r\n"))
    page = F.coalesce(F.col("page_id").cast("string"), F.lit("null"))
    body = F.coalesce(F.col("html").cast("string"), F.lit(""))
    keyed = pages.select(
        page.alias("page"), "page_id", body.alias("body"), F.octet_length(body).alias("bytes"), base32_sha1(body.cast("binary")).alias("digest"),
        F.regexp_replace(F.coalesce(F.col("url").cast("string"), F.concat(F.lit("urn:page:"), page)), r"[\x00-\x20\x7F]", "%20").alias("uri"),
        F.date_format(F.timestamp_seconds(F.lit(EPOCH) + F.coalesce(F.pmod(F.col("page_id"), F.lit(1 << 31)), F.lit(0))), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("captured"),
    )
    keyed = keyed.join(F.broadcast(revisits) if broadcast else revisits, (F.col("page_id") == F.col("r_page")) & (F.col("digest") == F.col("r_digest")), "left")
    again = F.col("refers_to").isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit("\r\n\r\n"))
    block = F.when(again, http).otherwise(F.concat(http, "body"))
    record = F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", F.when(again, F.lit("revisit")).otherwise(F.lit("response"))), line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), "page", F.lit(">"))),
        line("WARC-Date", F.col("captured")), line("WARC-Target-URI", F.col("uri")), line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        F.when(again, F.concat(line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("refers_to").cast("string"), F.lit(">"))), line("WARC-Profile", F.lit(REVISIT)))).otherwise(F.lit("")),
        line("Content-Type", F.lit("application/http; msgtype=response")), line("Content-Length", F.octet_length(block).cast("string")), F.lit("\r\n"), block,
    )
    return keyed.select(record.alias("value"))


def write_archives(pages: DataFrame, path: str, least_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """A record per row of `pages` (page_id, url, html) in WARC files under `path`.

    Of pages with equal payloads of at least `least_bytes`, that with the largest page_id is a response and the others are revisits of it.
    Null html is an empty payload. Pages with a null page_id, and rows that repeat the largest, are responses. Null urls become
    urn:page:<id>; white space and control characters in urls become %20. Other columns are ignored; no pages make an empty archive.
    """
    body = F.coalesce(F.col("html").cast("string"), F.lit(""))
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url"), F.col("html"))
    digests = Saved(pages.select("page_id", F.octet_length(body).cast("long").alias("bytes"), base32_sha1(body.cast("binary")).alias("digest")), "digests")
    repeated = digests.df.where(F.col("bytes") >= least_bytes).groupBy("digest", "bytes").agg(F.max("page_id").alias("refers_to"), F.min("page_id").alias("least")).where("least < refers_to").select(F.col("digest").alias("r_digest"), "refers_to")
    revisits = digests.df.join(repeated, F.col("digest") == F.col("r_digest")).where("page_id < refers_to").select(F.col("page_id").alias("r_page"), "r_digest", "refers_to").distinct()
    revisits = Saved(revisits, "revisits")
    few = revisits.df.count() <= BROADCAST_ROWS
    bytes_ = F.octet_length(body)
    sizes = digests.df.select(*[F.struct(F.count(part).alias("n"), F.avg(part).alias("mean"), F.max(part).alias("most")).alias(f"c{i}") for i, (low, high) in enumerate(zip(CLASSES, CLASSES[1:])) for part in [F.when((F.col("bytes") >= low) & (F.col("bytes") < high), F.col("bytes"))]]).first()
    for i, (low, high) in enumerate(zip(CLASSES, CLASSES[1:])):
        n, mean, most = sizes[f"c{i}"]
        if n or not i:
            held = max(1, min(int(archive_bytes / ((mean or 0) + 500)), MOST_BYTES // ((most or 0) + HEADERS)))
            records = _records(pages.where((bytes_ >= low) & (bytes_ < high)), revisits.df, few)
            records.write.mode("append").option("lineSep", END).option("maxRecordsPerFile", held).text(path)
    digests.drop()
    revisits.drop()


def url_key(uri: str) -> str:
    """The sort-friendly form: host labels reversed, without user, port, scheme, www and fragment, lower case."""
    try:
        parts = urlsplit(uri)
        host = parts.hostname or ""
    except ValueError:
        return uri.lower()
    if not host:
        return uri.lower()
    labels = host.split(".")
    if labels[0] == "www" and len(labels) > 2:
        labels = labels[1:]
    return (",".join(reversed(labels)) + ")" + (parts.path or "/") + (f"?{parts.query}" if parts.query else "")).lower()


_PAGE = re.compile(r"<urn:page:(-?\d+)>")


def parse(data: bytes | memoryview) -> Iterator[tuple[dict[str, str], int, int, bytes]]:
    """(headers, offset, length, block) of each record of an archive."""
    data, at = bytes(data), 0
    while at < len(data):
        head = data.index(b"\r\n\r\n", at)
        lines = data[at:head].decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        headers = dict(x.split(": ", 1) for x in lines[1:])
        end = head + 4 + int(headers["Content-Length"])
        yield headers, at, end + 4 - at, data[head + 4 : end]
        at = end + 4


def _entries(name: str, data: bytes | memoryview) -> list[tuple]:
    """The run of an archive: its index entries in order. Payload sizes and digests of responses are taken from the payload."""
    out = []
    for headers, offset, length, block in parse(data):
        head, _, payload = block.partition(b"\r\n\r\n")
        kind = headers["WARC-Type"]
        if kind == "response":
            size, digest = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
        else:
            size, digest = int(re.search(rb"Content-Length: (\d+)", head)[1]), headers["WARC-Payload-Digest"].removeprefix("sha1:")
        page, refers = (_PAGE.match(headers.get(k, "")) for k in ("WARC-Record-ID", "WARC-Refers-To"))
        out.append((url_key(headers["WARC-Target-URI"]), headers["WARC-Date"], int(page[1]) if page else None, size, digest, kind, int(refers[1]) if refers else None, name, offset, length))
    return sorted(out, key=_order)


def _order(e: tuple) -> tuple:
    return e[0], e[1], e[7], e[8]


class LoserTree:
    """Merges sorted runs: each inner node keeps the loser of its match, so the next least entry costs one match a level."""

    def __init__(self, runs: list[Iterable[tuple]]):
        self.runs = [iter(r) for r in runs]
        self.k = max(1, len(runs))
        self.heads: list[tuple | None] = [next(r, None) for r in self.runs] or [None]
        self.losers = [-1] * self.k
        for i in range(self.k):
            self._climb(i)

    def _beats(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return y is None or (x is not None and (_order(x), a) < (_order(y), b))

    def _climb(self, i: int) -> None:
        """Play from leaf i to the root; while the tree is being built, wait at the first match without an opponent."""
        node = (i + self.k) // 2
        while node:
            if self.losers[node] < 0:
                self.losers[node] = i
                return
            if self._beats(self.losers[node], i):
                self.losers[node], i = i, self.losers[node]
            node //= 2
        self.losers[0] = i

    def __iter__(self) -> Iterator[tuple]:
        while (best := self.heads[self.losers[0]]) is not None:
            yield best
            i = self.losers[0]
            self.heads[i] = next(self.runs[i], None)
            self._climb(i)


def _arrow(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, schema.types)], schema=schema)


_FIELDS = [("urlkey", pa.string()), ("captured", pa.string()), ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64())]
_ENTRY = pa.schema(_FIELDS)


def _merged(runs: list[list[tuple]]) -> Iterator[tuple]:
    return iter(LoserTree(runs)) if len(runs) > 1 else iter(runs[0] if runs else [])


def runs(spark: SparkSession, path: str, run_rows: int = RUN_ROWS) -> DataFrame:
    """Sorted runs of the index entries of all archives under `path`, with `run`, its name, and `seq`, an entry's place in it.

    An archive is a run. A task merges those of its archives into longer ones of `run_rows` entries or so, so that fewer are left to merge.
    """

    def read(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([*_FIELDS, ("run", pa.string()), ("seq", pa.int64())])
        held: list[list[tuple]] = []

        def out() -> Iterator[pa.RecordBatch]:
            name, block = held[0][0][7], []
            for i, r in enumerate(_merged(held)):
                block.append((*r, name, i))
                if len(block) == 8192:
                    yield _arrow(block, schema)
                    block = []
            yield _arrow(block, schema)

        for batch in it:
            for name, data in zip(batch.column(0), batch.column(1)):
                if rows := _entries(name.as_py().rpartition("/")[2], data.as_buffer()):
                    held.append(rows)
                if sum(map(len, held)) >= run_rows:
                    yield from out()
                    held = []
        if held:
            yield from out()

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(read, ENTRY + ", run string, seq long")


def merged_index(spark: SparkSession, path: str, range_rows: int = RANGE_ROWS, run_rows: int = RUN_ROWS) -> DataFrame:
    """The captures of all archives under `path` in one order: URL key, capture time, archive, offset.

    Partitions hold ranges of that order in turn. Ranges are cut by the whole order and not by the URL alone, so a URL of very many
    captures spans several, and each holds a bounded number of entries of any number of runs. Without captures there are no rows.
    """
    ship(spark)
    saved = Saved(runs(spark, path, run_rows), "runs")
    n = max(1, -(-saved.df.count() // range_rows))
    run = len(_FIELDS)

    def merge(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple]] = {}
        for batch in it:
            for row in zip(*(c.to_pylist() for c in batch.columns[:-1])):
                held.setdefault(row[run], []).append(row[:run])
        block: list[tuple] = []
        for row in _merged(list(held.values())):
            block.append(row)
            if len(block) == 8192:
                yield _arrow(block, _ENTRY)
                block = []
        yield _arrow(block, _ENTRY)

    # Within a range, each run's slice comes in its own order; only the tree brings the runs together.
    dealt = saved.df.repartitionByRange(n, "urlkey", "captured", "archive", "offset").sortWithinPartitions("run", "seq")
    return dealt.mapInArrow(merge, ENTRY)


def archive(pages: DataFrame, path: str | None = None, least_bytes: int = 0) -> DataFrame:
    """Write `pages` as WARC archives, under a scratch folder if no path is given, and return their merged index; no pages give no rows."""
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    write_archives(pages, path, least_bytes)
    return merged_index(spark, path)
