"""WARC archives and a capture index merged from sorted runs.

Writing: every page becomes a record (WARC/1.1).  Of equal payloads of at least MIN_REVISIT bytes
the one of smallest page_id is stored as a response and the others as revisits that refer to it;
smaller payloads are all responses.  Each task sorts its records by URL key and time and writes
gzip files of RECORDS records at most through Spark's writer, which commits them to shared
storage; with the separator that WARC asks for between records, its text files are archives.

Reading: every archive is a sorted run of captures.  The runs are dealt by ranges of (URL key,
time, page), and each range is merged by a loser tree over the pieces of the runs, so the ranges
together list all captures in order and each URL's history is one stretch.

A null html is an empty payload, a null url an empty one.  Rows without page_id, and rows that
repeat the smallest page_id of a payload, are responses if no smaller page_id has the payload;
what revisits a payload without any page_id does not occur.  Line breaks in a url are
percent-encoded.  Empty tables give archives without records; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.llm.common import new_folder

#: Payloads shorter than this are always stored.
MIN_REVISIT = 100
#: Records per archive, at most: what one read opens at once.
RECORDS = 1000
#: Seconds since 1970 of a capture whose page_id is 0; without a time of its own, page n is n seconds later.
FIRST_CAPTURE = 1_700_000_000
SEPARATOR = "\r\n\r\n"
_NO_ID = "none"

CAPTURE_DDL = (
    "url_key string, captured string, page_id long, url string, record_type string, refers_to long, "
    "payload_bytes long, payload_digest string, archive string, record int"
)
MERGED_DDL = CAPTURE_DDL + ", range int, place long"


def url_key(url: Column) -> Column:
    """Host labels in reverse order, then path and query: what belongs together sorts together."""
    url = F.coalesce(url, F.lit(""))
    scheme = r"^[A-Za-z][A-Za-z0-9+.\-]*://"
    host = F.lower(F.regexp_extract(url, scheme + r"(?:[^/?#@]*@)?(?:www\.)?([^/?#:]*)", 1))
    rest = F.regexp_extract(url, scheme + r"[^/?#]*([^#]*)", 1)
    key = F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), F.when(rest == "", "/").otherwise(rest))
    return F.when(url.rlike(scheme), key).otherwise(url)


def _record(kind: str, block: Column, more: list[Column]) -> Column:
    lines = [
        F.lit(f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce(F.col("page_id").cast("string"), F.lit(_NO_ID)),
        F.lit(">\r\nWARC-Date: "),
        F.col("captured"),
        F.lit("\r\nWARC-Target-URI: "),
        F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A")),
        F.lit("\r\nWARC-Payload-Digest: sha256:"),
        F.col("digest"),
        *more,
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length(block).cast("string"),
        F.lit(SEPARATOR),
        block,
    ]
    return F.concat(*lines)


def write_archives(pages: DataFrame, folder: str, records: int = RECORDS) -> None:
    """Write page_id, url, html (and, where there is one, a timestamp captured_at) as archives in a folder."""
    if "captured_at" in pages.columns:
        time = F.col("captured_at").cast("timestamp")
    else:
        time = F.timestamp_seconds(FIRST_CAPTURE + F.pmod(F.coalesce(F.col("page_id").cast("long"), F.lit(0)), F.lit(10**9)))
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"),
        F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("captured"),
        payload.alias("payload"),
        F.octet_length(payload).alias("size"),
        F.sha2(payload, 256).alias("digest"),
    )
    first = rows.filter(F.col("size") >= MIN_REVISIT).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    rows = rows.join(first.filter("n > 1").select("digest", "first"), "digest", "left")
    revisits = F.coalesce(~F.col("page_id").eqNullSafe(F.col("first")) & F.col("first").isNotNull(), F.lit(False))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size").cast("string"), F.lit(SEPARATOR)
    )
    profile = "\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nWARC-Refers-To: <urn:page:"
    revisit = _record("revisit", http, [F.lit(profile), F.col("first").cast("string"), F.lit(">")])
    response = _record("response", F.concat(http, F.col("payload")), [])
    ordered = rows.withColumn("key", url_key(F.col("url"))).sortWithinPartitions("key", "captured", "page_id")
    value = F.when(revisits, revisit).otherwise(response)
    writer = ordered.select(value.alias("value")).write.option("lineSep", SEPARATOR).option("compression", "gzip")
    writer.option("maxRecordsPerFile", records).text(folder)


def records(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of every record of an opened archive."""
    at = 0
    while at < len(archive):
        end = archive.index(b"\r\n\r\n", at)
        version, *lines = archive[at:end].decode("utf-8", "replace").split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        head = {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}
        size = int(head["content-length"])
        yield head, archive[end + 4 : end + 4 + size]
        at = end + 4 + size + 4


def unpack(content: bytes) -> bytes:
    """All members of a gzip file."""
    parts = []
    while content:
        opened = zlib.decompressobj(31)
        parts.append(opened.decompress(content) + opened.flush())
        content = opened.unused_data
    return b"".join(parts)


def _page(urn: str) -> int | None:
    value = urn.strip("<>").rpartition(":")[2]
    return None if value == _NO_ID else int(value)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (path, content) as captures."""
    names = ["captured", "page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "archive", "record"]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int32()]
    for batch in batches:
        for path, content in zip(batch.column(0), batch.column(1)):
            rows = []
            for k, (head, block) in enumerate(records(unpack(content.as_py()))):
                http, _, payload = block.partition(b"\r\n\r\n")
                size = int(http.rpartition(b"Content-Length: ")[2])
                digest = head["warc-payload-digest"].partition(":")[2]
                refers = None
                if head["warc-type"] == "revisit":
                    refers = _page(head["warc-refers-to"])
                elif len(payload) != size or hashlib.sha256(payload).hexdigest() != digest:
                    raise ValueError(f"record {k} of {path} is damaged")
                own = _page(head["warc-record-id"])
                rows.append((head["warc-date"], own, head["warc-target-uri"], head["warc-type"], refers, size, digest, path.as_py(), k))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)


class LoserTree:
    """Merges sorted runs: each inner node keeps the loser of its match, the winner goes on to the root."""

    def __init__(self, runs: list[Iterator], key: Callable):
        self._runs, self._key = runs, key
        n = 1
        while n < len(runs):
            n *= 2
        self._leaves = n
        self._heads = [self._next(i) for i in range(n)]
        winners = [0] * n + list(range(n))
        self._losers = [0] * n
        for node in range(n - 1, 0, -1):
            a, b = winners[2 * node], winners[2 * node + 1]
            winners[node], self._losers[node] = (a, b) if self._beats(a, b) else (b, a)
        self._winner = winners[1] if n > 1 else 0

    def _next(self, i: int):
        """The key and row that run i offers; None at its end."""
        row = next(self._runs[i], None) if i < len(self._runs) else None
        return None if row is None else (self._key(row), row)

    def _beats(self, a: int, b: int) -> bool:
        x, y = self._heads[a], self._heads[b]
        if x is None or y is None:
            return y is None and (x is not None or a < b)
        return (x[0], a) < (y[0], b)

    def __iter__(self) -> Iterator:
        while (head := self._heads[self._winner]) is not None:
            yield head[1]
            i = self._winner
            self._heads[i] = self._next(i)
            node = (i + self._leaves) // 2
            while node:
                if self._beats(self._losers[node], i):
                    i, self._losers[node] = self._losers[node], i
                node //= 2
            self._winner = i


def _order(row: tuple) -> tuple:
    """URL key, time, page (none first), archive and record."""
    return row[0], row[1], row[2] is not None, row[2] or 0, row[8], row[9]


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A range's captures, merged from the pieces of the runs; both are held in memory."""
    runs: dict[str, list[tuple]] = {}
    schema = None
    for batch in batches:
        schema = batch.schema
        for row in zip(*[c.to_pylist() for c in batch.columns]):
            runs.setdefault(row[8], []).append(row)
    if schema is None:
        return
    for run in runs.values():  # the shuffle may hand a run's rows over in another order
        run.sort(key=_order)
    merged, part, place = LoserTree([iter(run) for run in runs.values()], _order), TaskContext.get().partitionId(), 0
    held: list[tuple] = []

    def batch_of(rows: list[tuple], at: int) -> pa.RecordBatch:
        columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)]
        columns += [pa.array([part] * len(rows), pa.int32()), pa.array(range(at, at + len(rows)), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, [*schema.names, "range", "place"])

    for row in merged:
        held.append(row)
        if len(held) == 4096:
            yield batch_of(held, place)
            place, held = place + len(held), []
    if held:
        yield batch_of(held, place)


def read_captures(spark: SparkSession, folder: str) -> DataFrame:
    """A row per record of the archives, in no order."""
    files = spark.read.format("binaryFile").load(folder).select("path", "content")
    ddl = CAPTURE_DDL.partition(", ")[2]
    return files.mapInArrow(_read, ddl).select(url_key(F.col("url")).alias("url_key"), "*")


def merge_index(captures: DataFrame) -> DataFrame:
    """All captures in order of URL key, time and page: by `range`, and within a range by `place`."""
    return captures.repartitionByRange("url_key", "captured", "page_id").mapInArrow(_merge, MERGED_DDL)


def archive(pages: DataFrame) -> DataFrame:
    """Write the pages, read the archives back and merge their index: page_id, payload_bytes, payload_digest,
    record_type, refers_to and the place of the capture."""
    folder = new_folder(pages.sparkSession, "warc")
    write_archives(pages, folder)
    merged = merge_index(read_captures(pages.sparkSession, folder))
    return merged.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured", "range", "place"
    )
