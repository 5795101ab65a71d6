"""WARC archives written and read by Spark, and an index of captures merged from sorted runs.

Records go out through Spark's text writer, whose record separator is the one of WARC, so any file
system that Spark knows will do and offsets in the archives are true. Each task writes its records
in the order of (URL key, time, page), which makes the captures of an archive a sorted run. Runs
are dealt out by ranges of that order, and a loser tree merges them in each range.

Defined cases. A null page is an empty payload. Equal payloads of at least ``min_bytes`` have one
response, that of the largest page id; rows repeating its id and payload are responses too. Null
ids count as smallest. A null URL has no target header and an empty key; control characters in a
URL are escaped. Other columns are not archived. An empty table gives an empty archive and index.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_path
from .work import saved

END = "\r\n"
RECORDS_PER_FILE = 2000
# An archive is read whole. Longer records are written apart, fewer to a file, so none grows beyond
# this unless by a single record.
BYTES_PER_FILE = 64 << 20
# Captures that one task of the merge holds.
CAPTURES_PER_TASK = 200_000

REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HEX32, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in upper-case base32: five hexadecimal digits are four of base 32."""
    digest = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(digest, 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*groups), HEX32, BASE32)


def url_key(url: Column) -> Column:
    """Host labels from the last to the first, then path and query; without scheme, port and fragment."""
    bare = F.regexp_replace(F.coalesce(url, F.lit("")), r"(?s)^[A-Za-z][A-Za-z0-9+.-]*://|#.*$", "")
    host = F.lower(F.regexp_extract(bare, r"(?s)^([^/?:]*)", 1))
    rest = F.regexp_extract(bare, r"(?s)^[^/?:]*(?::\d*)?(.*)$", 1)
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest)


def fetch_time(page_id: Column) -> Column:
    """A time for pages that come without one: a second per page from the start of 2024."""
    return F.timestamp_seconds(F.coalesce(page_id, F.lit(0)).cast("long") + 1_704_067_200)


def _payload_key(html: Column) -> Column:
    return F.unhex(F.sha2(html, 256))


def _revisits(pages: DataFrame, min_bytes: int) -> DataFrame:
    """(id, key, refers_to) of the pages whose payload a larger page id holds as well."""
    held = pages.where(F.octet_length("html") >= min_bytes).select("page_id", _payload_key(F.col("html")).alias("key"))
    last = held.groupBy("key").agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return held.join(last.drop("n"), "key").where(
        F.coalesce(F.col("page_id") < F.col("refers_to"), F.col("refers_to").isNotNull()))


def _record_id(page_id: Column) -> Column:
    d = F.md5(F.concat(F.lit("page "), F.coalesce(page_id.cast("string"), F.lit("-"))))
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(
        d, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), F.lit(">"))


def _field(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(END))


def _records(pages: DataFrame, revisits: DataFrame, time: Callable[[Column], Column]) -> DataFrame:
    """One text per page: a record without the two line ends behind it."""
    found = pages.withColumn("key", _payload_key(F.col("html"))).join(
        revisits.select(F.col("page_id").alias("r_id"), F.col("key").alias("r_key"), "refers_to"),
        F.col("page_id").eqNullSafe(F.col("r_id")) & (F.col("key") == F.col("r_key")), "left")
    again = F.col("refers_to").isNotNull()
    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}"),
                    _field("Content-Length", F.octet_length("html")), F.lit(END))
    when = F.date_format(time(F.col("page_id")), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    block = F.concat(F.col("http"), F.when(again, F.lit("")).otherwise(F.col("html")))
    optional = [
        _field("WARC-Target-URI", F.col("url")),
        F.when(F.col("page_id").isNotNull(), _field("X-Page-ID", F.col("page_id"))),
        F.when(again, F.concat(
            F.lit(f"WARC-Profile: {REVISIT_PROFILE}{END}"),
            _field("WARC-Refers-To", _record_id(F.col("refers_to"))),
            _field("X-Refers-To-Page-ID", F.col("refers_to")))),
    ]
    return found.withColumn("url", url).withColumn("http", http).select(
        url_key(F.col("url")).alias("key"), when.alias("time"), "page_id",
        F.concat(
            F.lit(f"WARC/1.1{END}"),
            _field("WARC-Type", F.when(again, "revisit").otherwise("response")),
            _field("WARC-Record-ID", _record_id(F.col("page_id"))),
            _field("WARC-Date", when),
            *[F.coalesce(x, F.lit("")) for x in optional],
            _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32_sha1(F.col("html")))),
            F.lit(f"Content-Type: application/http; msgtype=response{END}"),
            _field("Content-Length", F.octet_length(block)),
            F.lit(END), block,
        ).alias("record"))


def _size_classes(longest: int) -> Iterator[tuple[int, int, int]]:
    """(over, up to, records per file) of record sizes in bytes, so that files stay within ``BYTES_PER_FILE``."""
    over, most = 0, RECORDS_PER_FILE
    while over < longest:
        upto = BYTES_PER_FILE // most if most > 1 else longest
        yield over, max(upto, over), most
        over, most = max(upto, over), max(most // 8, 1)


def write_archives(
    pages: DataFrame, path: str, min_bytes: int = 0, time: Callable[[Column], Column] = fetch_time,
) -> None:
    """Writes a record per page to archives under ``path``, each a run in (URL key, time, page).

    Revisits are settled on digests alone. Their table is written first; it is joined by
    broadcast if it is small then, so pages are shuffled only where revisits are many. Pages of
    each class of sizes have archives of their own.
    """
    pages = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    revisits = saved(_revisits(pages, min_bytes), "revisits")
    # At most: an escaped byte is three, and the headers without the URL have less than 1,024.
    size = F.octet_length("html").cast("long") + 3 * F.coalesce(F.octet_length("url"), F.lit(0)) + 1024
    classes = list(_size_classes(pages.agg(F.max(size)).first()[0] or 1))
    for over, upto, most in classes:
        part = pages.where((size > over) & (size <= upto)) if len(classes) > 1 else pages
        (_records(part, revisits, time).sortWithinPartitions("key", "time", "page_id").select("record")
         .write.mode("append" if over else "errorifexists")
         .option("lineSep", 2 * END).option("maxRecordsPerFile", most).text(path))


# --- reading ----------------------------------------------------------------------------

CAPTURE = ("page_id long, url string, time string, record_type string, payload_bytes long, payload_digest string, "
           "refers_to long, intact boolean, offset long, length long")


def parse_records(content: bytes) -> Iterator[tuple]:
    """The captures of an archive, by the lengths that its records state."""
    at = 0
    while at < len(content):
        head = content.index(b"\r\n\r\n", at)
        fields = dict(line.split(": ", 1) for line in content[at:head].decode().split(END)[1:])
        end = head + 4 + int(fields["Content-Length"])
        body = content.index(b"\r\n\r\n", head + 4) + 4
        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
        stated = int(re.search(rb"Content-Length: (\d+)", content[head + 4:body])[1])
        intact = True
        if fields["WARC-Type"] == "response":
            payload = content[body:end]
            found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
            intact, digest, stated = found == digest and len(payload) == stated, found, len(payload)
        page, refers = fields.get("X-Page-ID"), fields.get("X-Refers-To-Page-ID")
        yield (page and int(page), fields.get("WARC-Target-URI"), fields["WARC-Date"], fields["WARC-Type"], stated,
               digest, refers and int(refers), intact, at, end - at)
        at = end + 4


def read_captures(spark: SparkSession, path: str) -> DataFrame:
    """A row per record of the archives, with its file, offset and length; ``intact`` is the digest's test."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(path).select("path", "content")
    names = [c.split()[0] for c in CAPTURE.split(", ")]

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}
        schema = pa.schema([("file", pa.string()), *((n, kinds[k]) for n, k in map(str.split, CAPTURE.split(", ")))])
        for part in parts:
            for file, content in zip(part.column("path"), part.column("content")):
                rows = [(file.as_py(), *r) for r in parse_records(content.as_py())]
                columns = list(zip(*rows)) or [[] for _ in schema]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    found = files.mapInArrow(batches, f"file string, {CAPTURE}")
    return found.select(url_key(F.col("url")).alias("url_key"), *names, "file")


class LoserTree:
    """Merges sorted runs: the tree holds the loser of each match, so a new item meets one per level."""

    def __init__(self, runs: list[list[tuple]]) -> None:
        self._runs = [iter(r) for r in runs]
        self._heads = [next(r, None) for r in self._runs]
        k = len(runs)
        self._losers = [-1] * k
        for run in range(k):
            self._play(run)

    def _play(self, run: int) -> None:
        """``run`` moves up until it loses; on an empty place it waits for the other side."""
        losers, heads = self._losers, self._heads
        at = (run + len(losers)) // 2
        while at > 0:
            other = losers[at]
            if other == -1:
                losers[at] = run
                return
            if heads[run] is None or (heads[other] is not None and heads[other] < heads[run]):
                losers[at], run = run, other
            at //= 2
        losers[0] = run

    def __iter__(self) -> Iterator[tuple]:
        while self._losers and (item := self._heads[run := self._losers[0]]) is not None:
            yield item
            self._heads[run] = next(self._runs[run], None)
            self._play(run)


def merge_index(captures: DataFrame) -> DataFrame:
    """All captures in the order of (URL key, time, page), over all partitions in turn.

    Ranges are as many as the captures need at ``CAPTURES_PER_TASK``. The full order splits the
    captures of one URL over tasks too.
    """
    order = ["url_key", "time", "page_id"]
    tasks = max(1, -(-captures.count() // CAPTURES_PER_TASK))
    ranges = captures.repartitionByRange(tasks, *order)
    at = [captures.columns.index(c) for c in order]
    file_at = captures.columns.index("file")

    def key(row: tuple) -> tuple:
        return tuple((row[k] is not None, row[k]) if k == at[2] else row[k] or "" for k in at)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs: dict[str, list[tuple]] = {}
        schema, n = None, 0
        for part in parts:
            schema = part.schema
            for row in zip(*(c.to_pylist() for c in part.columns)):
                runs.setdefault(row[file_at], []).append((key(row), n, row))
                n += 1
        for run in runs.values():  # fetched blocks need not come in the order of their run
            run.sort()
        merged = [row for _, _, row in LoserTree(list(runs.values()))]
        for start in range(0, len(merged), 10_000):
            columns = zip(*merged[start:start + 10_000])
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return ranges.mapInArrow(batches, captures.schema)


def capture_histories(
    pages: DataFrame, min_bytes: int = 0, time: Callable[[Column], Column] = fetch_time, path: str | None = None,
) -> DataFrame:
    """Archives ``pages``, reads the archives back and returns their merged index."""
    spark = pages.sparkSession
    path = path or fresh_path(spark, "archives")
    write_archives(pages, path, min_bytes, time)
    return merge_index(saved(read_captures(spark, path), "captures"))
