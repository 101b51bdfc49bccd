"""WARC archives of captures, and one globally ordered index over them.

Each writing task sorts its captures by URL key and time and writes them as
uncompressed WARC files of a bounded number of records: locally sorted runs. Of
equal payloads of some length the one with the smallest page id is stored as a
response, the others as revisits that refer to it and keep the HTTP head alone.
Reading parses the files record by record by their lengths, and checks digests.
The index of all runs is cut into ranges of key and time, in each of which a
loser tree merges the runs: the captures of one URL stand together, in order.

Defined cases: a null html is an empty payload, a null url an empty target with
an empty key. Null page ids are written and come back as null and are never
referred to. Rows that repeat a page id are records of their own; copies of the
response's own row are responses too. An empty table writes no record.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketlens.session import materialize, scratch_folder

#: Shorter payloads are always stored.
REVISIT_BYTES = 100
RECORDS_PER_FILE = 1_000
#: Index rows that one task merges.
RANGE_ROWS = 100_000
#: Up to so many repeated digests (32 bytes and an id each) are broadcast, more are joined by shuffle.
BROADCAST_DIGESTS = 100_000
#: Captures without a time of their own are one second apart, by id, from 2020-01-01 on.
FIRST_SECOND = 1_577_836_800
RECORD_END = "\r\n\r\n"


def url_key(url: Column) -> Column:
    """Host labels from the last to the first, then path and query; without scheme, port, leading www and fragment."""
    clean = F.regexp_replace(F.regexp_replace(F.coalesce(url, F.lit("")), "#.*$", ""), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(clean, "^([^/?:]*)", 1)), r"^www[0-9]*\.", "")
    rest = F.regexp_replace(clean, "^[^/?]*", "")
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest)


def captures(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, url_key, captured, payload, payload_bytes, payload_digest of each row."""
    payload = F.coalesce(F.col(html), F.lit(""))
    second = F.lit(FIRST_SECOND) + F.coalesce(F.col(page_id), F.lit(0)) % 1_000_000_000
    return pages.select(
        F.col(page_id).cast("long").alias("page_id"),
        F.regexp_replace(F.coalesce(F.col(url), F.lit("")), r"[\r\n]", "").alias("url"),
        url_key(F.col(url)).alias("url_key"),
        F.date_format(F.timestamp_seconds(second), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("captured"),
        payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        F.sha2(payload, 256).alias("payload_digest"),
    )


def first_captures(rows: DataFrame) -> DataFrame:
    """digest and first_id of the payloads that are stored once and referred to."""
    return (
        rows.filter(F.col("payload_bytes") >= REVISIT_BYTES)
        .groupBy(F.unhex("payload_digest").alias("digest"))
        .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
        .filter((F.col("copies") > 1) & F.col("first_id").isNotNull())
        .drop("copies")
    )


def records(rows: DataFrame) -> DataFrame:
    """Captures as WARC records (text without the closing blank lines), with their key and time."""
    repeated = materialize(first_captures(rows))
    if repeated.count() <= BROADCAST_DIGESTS:
        repeated = F.broadcast(repeated)
    joined = rows.join(repeated, F.unhex("payload_digest") == F.col("digest"), "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("payload_bytes"), F.lit("\r\n\r\n"),
    )
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: "), _urn(F.col("page_id")),
        F.lit("\r\nWARC-Target-URI: "), F.col("url"), F.lit("\r\nWARC-Date: "), F.col("captured"),
        F.lit("\r\nWARC-Payload-Digest: sha256:"), F.col("payload_digest"),
        F.when(
            revisit,
            F.concat(
                F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                F.lit("\r\nWARC-Refers-To: "), _urn(F.col("first_id")),
            ),
        ).otherwise(""),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "), F.octet_length(block),
        F.lit("\r\n\r\n"),
    )
    return joined.select("url_key", "captured", "page_id", F.concat(head, block).alias("value"))


def _urn(page: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("")), F.lit(">"))


def write_archives(rows: DataFrame, path: str, records_per_file: int = RECORDS_PER_FILE) -> None:
    """Write captures as .txt-named WARC files; every task sorts its own, and Spark commits whole files."""
    (
        records(rows)
        .sortWithinPartitions("url_key", "captured", "page_id")
        .select("value")
        .write.option("lineSep", RECORD_END)
        .option("maxRecordsPerFile", records_per_file)
        .text(path)
    )


def parse_archive(content: bytes) -> Iterator[tuple[int, int, dict[str, str], memoryview]]:
    """(offset, length, headers, block) of each record, by the lengths the records give."""
    view, at = memoryview(content), 0
    while at < len(content):
        end = content.index(b"\r\n\r\n", at)
        lines = content[at:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
        size = int(headers["Content-Length"])
        stop = end + 4 + size
        yield at, stop + 4 - at, headers, view[end + 4 : stop]
        at = stop + 4


def _page(urn: str | None) -> int | None:
    digits = (urn or "")[len("<urn:page:") : -1]
    return int(digits) if digits else None


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One index row per record of all archives below `path`; payload sizes and digests are taken from the payloads."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, content in zip(batch.column(0), batch.column(1), strict=True):
                rows: dict[str, list] = {name: [] for name in PARSED}
                for offset, length, headers, block in parse_archive(content.as_py()):
                    stated = headers["WARC-Payload-Digest"].removeprefix("sha256:")
                    cut = bytes(block[: min(len(block), 4096)]).index(b"\r\n\r\n") + 4
                    if headers["WARC-Type"] == "response":
                        size, digest = len(block) - cut, hashlib.sha256(block[cut:]).hexdigest()
                        if digest != stated:
                            raise ValueError(f"{archive}: the record at byte {offset} is damaged")
                    else:
                        http = bytes(block[:cut]).decode().split("Content-Length: ")[1]
                        size, digest = int(http.split("\r\n")[0]), stated
                    for name, value in zip(PARSED, (
                        _page(headers["WARC-Record-ID"]), headers["WARC-Target-URI"], headers["WARC-Date"],
                        headers["WARC-Type"], size, digest, _page(headers.get("WARC-Refers-To")),
                        archive.as_py(), offset, length,
                    ), strict=True):
                        rows[name].append(value)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows[n], pa.int64() if n in LONGS else pa.string()) for n in PARSED], list(PARSED)
                )

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    schema = ", ".join(f"{n} {'long' if n in LONGS else 'string'}" for n in PARSED)
    parsed = files.mapInArrow(index, schema)
    return parsed.select("*", url_key(F.col("url")).alias("url_key"))


#: Columns of a parsed record, and which of them are numbers.
PARSED = (
    "page_id", "url", "captured", "record_type", "payload_bytes", "payload_digest", "refers_to", "archive", "offset", "length"
)
LONGS = ("page_id", "payload_bytes", "refers_to", "offset", "length")


class LoserTree:
    """Merges sorted runs: each step replays one path from the winning run's leaf to the root."""

    def __init__(self, runs: Sequence[Sequence]) -> None:
        self.runs = runs
        self.next = [0] * len(runs)
        self.losers = [-1] * max(len(runs), 1)
        for run in range(len(runs)):
            self._replay(run)

    def _before(self, a: int, b: int) -> bool:
        """Does run a's head go before run b's? An unplayed leaf (-1) goes first, an empty run last, equals by run."""
        if a < 0 or b < 0:
            return a < b
        if self.next[a] >= len(self.runs[a]):
            return False
        if self.next[b] >= len(self.runs[b]):
            return True
        x, y = self.runs[a][self.next[a]], self.runs[b][self.next[b]]
        return x < y or (x == y and a < b)

    def _replay(self, winner: int) -> None:
        node = (winner + len(self.runs)) // 2
        while node > 0:
            if self._before(self.losers[node], winner):
                winner, self.losers[node] = self.losers[node], winner
            node //= 2
        self.losers[0] = winner

    def merge(self) -> Iterator[tuple[int, int]]:
        """(run, position in the run) in merged order."""
        if not self.runs:
            return
        while True:
            run = self.losers[0]
            if self.next[run] >= len(self.runs[run]):
                return
            yield run, self.next[run]
            self.next[run] += 1
            self._replay(run)


def merge_runs(frame: pd.DataFrame) -> pd.DataFrame:
    """The rows of several runs, each sorted and given by archive and offset, in one order."""
    heads = list(zip(frame["url_key"], frame["captured"], frame["page_id"].fillna(-1), strict=True))
    starts = frame.index[(frame["archive"] != frame["archive"].shift()).to_numpy()].tolist()
    ends = [*starts[1:], len(frame)]
    tree = LoserTree([heads[a:b] for a, b in zip(starts, ends, strict=True)])
    return frame.iloc[[starts[run] + k for run, k in tree.merge()]]


def merge_index(index: DataFrame, rows: int, range_rows: int = RANGE_ROWS) -> DataFrame:
    """All index rows, ordered by URL key, time and id: by `range`, and by `position` within it.

    Ranges are cut by key, time and id, so one URL with very many captures is cut
    too. A task holds the index rows of its range only.
    """
    order = ["url_key", "captured", "page_id"]
    ranged = index.repartitionByRange(max(1, math.ceil(rows / range_rows)), *order).sortWithinPartitions("archive", "offset")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        whole = pa.Table.from_batches(held)
        frame = whole.select(["url_key", "captured", "page_id", "archive"]).to_pandas()
        order_of = merge_runs(frame).index.to_numpy()
        merged = whole.take(pa.array(order_of)).append_column("position", pa.array(range(len(order_of)), pa.int64()))
        yield from merged.combine_chunks().to_batches()

    merged = ranged.select(*index.columns).mapInArrow(
        merge, ", ".join([*[f"{n} {t}" for n, t in index.dtypes], "position long"])
    )
    return merged.select("*", F.spark_partition_id().alias("range"))


def archive_pages(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write the pages into archives in the shared scratch folder, read them back, and return the merged index."""
    spark = pages.sparkSession
    folder = scratch_folder(spark)
    write_archives(captures(pages, page_id, url, html), folder)
    return merge_index(materialize(read_archives(spark, folder)), pages.count())
