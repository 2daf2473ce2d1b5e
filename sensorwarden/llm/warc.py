"""WARC archives of pages, and one globally ordered capture index over them.

Records are written by Spark's text writer: the separator that ends a WARC record is its line separator, so every part
file is an archive, compressed as a whole; offsets are those of the uncompressed archive. Reading goes by Content-Length, never by the separator. Each archive yields its captures as a run
sorted by (URL key, time, page); the runs are dealt to key ranges, and each range merges its k runs with a loser tree.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import partitions, scratch_path, ship, written

#: Payload bytes an archive file holds, about; one file is read by one task.
ARCHIVE_BYTES = 32 << 20

END = "\r\n\r\n"

CAPTURE = T.StructType(
    [
        T.StructField("urlkey", T.StringType()),
        T.StructField("ts", T.StringType()),
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("refers_to", T.LongType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("archive", T.StringType()),
        T.StructField("offset", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("seq", T.LongType()),
    ]
)

ARROW = pa.schema([(f.name, pa.int64() if f.dataType == T.LongType() else pa.string()) for f in CAPTURE.fields])


def base32_of_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: every five hex digits are four base32 digits."""
    digits = F.sha1(payload)
    groups = [
        F.lpad(F.conv(F.substring(digits, 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)
    ]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def plan_records(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Pages with digest, size and response_id: the largest page id of equal payloads of at least min_bytes bytes.

    Rows repeated with one page id and payload are all of the same type. Null ids are never a response of others; where
    all ids of a payload are null, all its records are responses.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "utf-8")
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.coalesce("url", F.lit("")).alias("url"),
        F.coalesce("html", F.lit("")).alias("html"),
        base32_of_sha1(payload).alias("digest"),
        F.octet_length(payload).cast("bigint").alias("size"),
    )
    light = written(rows.select("page_id", "digest", "size").distinct(), "warc-digests")
    groups = light.filter(F.col("size") >= min_bytes).groupBy("digest", "size").agg(F.max("page_id").alias("response_id"))
    key = F.concat_ws(":", F.coalesce(F.col("page_id").cast("string"), F.lit("none")), F.col("digest"))
    decided = light.join(groups, ["digest", "size"], "left").select(key.alias("key"), "response_id")
    total = light.agg(F.sum("size")).first()[0] or 0
    files = max(1, -(-total // ARCHIVE_BYTES))
    # the join keeps this dealing: payloads are shuffled once, and files are even
    return rows.withColumn("key", key).repartition(files, "key").join(decided, "key", "left").drop("key")


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0) -> None:
    """One WARC record per page below ``path``; a revisit carries the response's HTTP header without its payload."""
    rows = plan_records(pages, min_bytes)
    revisit = F.coalesce(F.col("response_id") != F.col("page_id"), F.col("response_id").isNotNull())
    name = F.coalesce(F.col("page_id").cast("string"), F.lit("none"))
    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    when = F.date_format(F.timestamp_seconds(F.lit(1_704_067_200) + F.coalesce(F.pmod("page_id", F.lit(1 << 30)), F.lit(0))), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("size").cast("string"),
        F.lit(END),
    )
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("html")))
    header = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "),
        F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
        F.lit("\r\nWARC-Record-ID: <urn:page:"),
        name,
        F.lit(">\r\nWARC-Date: "),
        when,
        F.lit("\r\nWARC-Target-URI: "),
        url,
        F.lit("\r\nWARC-Payload-Digest: sha1:"),
        F.col("digest"),
        F.when(revisit, F.concat(F.lit("\r\nWARC-Refers-To: <urn:page:"), F.col("response_id").cast("string"), F.lit(">"))).otherwise(F.lit("")),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length(F.encode(block, "utf-8")).cast("string"),
        F.lit(END),
    )
    rows.select(F.concat(header, block).alias("value")).write.option("lineSep", END).option("compression", "gzip").text(path)


def url_key(url: str) -> str:
    """Host labels reversed, then path and query; without scheme, user, www and default port, lower-cased."""
    try:
        parts = urlsplit(url if "//" in url else f"//{url}")
        host, port = parts.hostname or "", parts.port
    except ValueError:  # no URL: ordered by its text
        return url.lower()
    host = re.sub(r"^www\d*\.", "", host)
    key = ",".join(reversed(host.split("."))) + (f":{port}" if port not in (None, 80, 443) else "")
    return (key + ")" + (parts.path or "/") + (f"?{parts.query}" if parts.query else "")).lower()


def _page_number(urn: str | None) -> int | None:
    tail = (urn or "").rpartition(":")[2].rstrip(">")
    return None if tail in ("", "none") else int(tail)


def records(content: bytes) -> Iterator[tuple[dict[str, str], int, int, memoryview]]:
    """Header fields, offset, length and block of each record, by Content-Length."""
    at, view = 0, memoryview(content)
    while at < len(content):
        close = content.index(b"\r\n\r\n", at)
        lines = content[at:close].decode().split("\r\n")
        fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
        start = close + 4
        stop = start + int(fields["Content-Length"])
        if lines[0] != "WARC/1.1" or content[stop : stop + 4] != b"\r\n\r\n":
            raise ValueError(f"no WARC record at byte {at}")
        yield fields, at, stop + 4 - at, view[start:stop]
        at = stop + 4


def captures_of(archive: str, content: bytes) -> list[tuple]:
    """The archive's run: its captures sorted by key, time and page. Payloads are checked against their digests."""
    run = []
    for fields, offset, length, block in records(content):
        http = bytes(block[:512])
        head = http.index(b"\r\n\r\n") + 4
        size = int(re.search(rb"Content-Length: (\d+)", http[:head])[1])
        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
        if fields["WARC-Type"] == "response":
            payload = block[head:]
            if len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                raise ValueError(f"payload at byte {offset} of {archive} does not match its digest")
        url = fields["WARC-Target-URI"]
        run.append(
            (url_key(url), fields["WARC-Date"], _page_number(fields["WARC-Record-ID"]), url, fields["WARC-Type"],
             _page_number(fields.get("WARC-Refers-To")), size, digest, archive, offset, length)
        )
    run.sort(key=_order)
    return [(*row, i) for i, row in enumerate(run)]


def _order(row: tuple) -> tuple:
    return row[0], row[1], row[2] is None, row[2] or 0


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in ARROW]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, ARROW, strict=True)], schema=ARROW)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"], strict=True):
            yield _batch(captures_of(path.as_py(), gzip.decompress(content.as_py())))


class LoserTree:
    """k sorted lists merged in order; every pop replays one path of the tournament."""

    def __init__(self, runs: list[list[tuple]]):
        self.runs, self.k = runs, len(runs)
        self.at = [0] * self.k
        self.heads = [self._key(i) for i in range(self.k)]
        self.losers = [-1] * self.k
        self.winner = 0
        for i in range(self.k):
            self._play(i)

    def _key(self, i: int) -> tuple:
        """Exhausted runs lose to all others."""
        if self.at[i] >= len(self.runs[i]):
            return (1,)
        return (0, *_order(self.runs[i][self.at[i]]), i)

    def _play(self, leaf: int) -> None:
        winner, node = leaf, (leaf + self.k) // 2
        while node > 0:
            other = self.losers[node]
            if other == -1:  # first round: wait here for an opponent
                self.losers[node] = winner
                return
            if self.heads[other] < self.heads[winner]:
                self.losers[node], winner = winner, other
            node //= 2
        self.winner = winner

    def __iter__(self) -> Iterator[tuple]:
        while self.k and self.heads[self.winner][0] == 0:
            i = self.winner
            yield self.runs[i][self.at[i]]
            self.at[i] += 1
            self.heads[i] = self._key(i)
            self._play(i)


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One key range: rows come by archive and place in its run; the range bounds what is held."""
    runs: dict[str, list[tuple]] = {}
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            runs.setdefault(row[8], []).append(row)
    out = []
    for row in LoserTree(list(runs.values())):
        out.append(row)
        if len(out) == 5000:
            yield _batch(out)
            out = []
    yield _batch(out)


def merged_index(spark: SparkSession, path: str) -> DataFrame:
    """Captures of all archives below ``path`` in one global order of (urlkey, ts, page_id); nulls last.

    Every partition is a key range and sorted; partition numbers follow the order.
    """
    ship(spark)
    runs = spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(_runs, CAPTURE)
    runs = written(runs, "warc-runs")
    key = ["urlkey", "ts", F.col("page_id").asc_nulls_last(), "archive", "seq"]
    ranged = runs.repartitionByRange(partitions(spark), *key).sortWithinPartitions("archive", "seq")
    return ranged.mapInArrow(_merged, CAPTURE).drop("seq")


def archived_index(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Writes pages (page_id, url, html) to archives in the shared folder and returns the index read back from them.

    Null html is an empty payload, a null url an empty one; an empty table gives an empty index; other columns are not read.
    """
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archives(pages, path, min_bytes)
    return merged_index(spark, path)
