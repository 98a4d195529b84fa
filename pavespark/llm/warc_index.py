"""WARC archives of pages and a merged index of their captures (operator 1).

Pages are written as WARC/1.1 records, one archive per output file of Spark's text writer
(its line separator is the blank line that ends a record, so files are plain WARC). Of pages
with equal payloads of at least ``LEAST_REVISIT`` bytes, the one with the largest id is a
response and the others are revisits of it.

Archives are read back as whole files of bounded size; each gives a run of index entries
sorted by (URL key, time, page). The runs are cut at common ranges of that key, and in every
range a loser tree merges the runs' slices, so the ranges one after the other are the
capture history of every URL in order. A URL with very many captures spreads over ranges,
since time, page and place in the archive are part of the key.

Null html is an empty payload; a null url is empty. Rows without an id revisit like others
but are never referred to; if no id is known, all are responses. Repeated rows of the id
that is referred to are all responses. An empty table gives an empty index.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pavespark.llm.common import frames
from pavespark.session import ensure_checkpoint_dir, written

LEAST_REVISIT = 1000
CRLF = "\r\n"
RECORD_END = CRLF * 2
FIRST_CAPTURE = 1_704_067_200  # pages carry no time: a second per page from here on
CAPTURE_SECONDS = 10 * 365 * 86_400
HTTP_HEAD = f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}{CRLF}"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def captures(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, bytes, digest, refers_to (null for responses)."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    made = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"),
                        F.octet_length(payload).cast("long").alias("bytes"),
                        F.sha1(payload.cast("binary")).alias("digest"))
    originals = (made.where(F.col("bytes") >= LEAST_REVISIT).groupBy("digest")
                 .agg(F.max("page_id").alias("original"), F.count(F.lit(1)).alias("n"))
                 .where("n > 1").select("digest", "original"))
    # written, so its size is known: Spark broadcasts it only below its limit, and only
    # beyond that are the payloads shuffled
    originals = written(originals)
    refers = F.when(~F.col("original").eqNullSafe(F.col("page_id")), F.col("original"))
    return made.join(originals, "digest", "left").withColumn("refers_to", refers)


def records(found: DataFrame) -> DataFrame:
    """A WARC record per capture, without the blank line that ends it."""

    def name(column: str) -> F.Column:
        return F.concat(F.lit("<urn:page:"), F.coalesce(F.col(column).cast("string"), F.lit("")), F.lit(">"))

    url = F.coalesce(F.col("url"), F.lit(""))
    for c in "%\r\n":  # a line break in a URL must not end the header line
        url = F.replace(url, F.lit(c), F.lit(f"%{ord(c):02X}"))
    seconds = F.lit(FIRST_CAPTURE) + F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(CAPTURE_SECONDS))
    revisit = F.col("refers_to").isNotNull()
    body = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    date = F.date_format(F.to_utc_timestamp(F.timestamp_seconds(seconds), F.current_timezone()),
                         "yyyy-MM-dd'T'HH:mm:ss'Z'")
    fields = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), name("page_id")),
        F.concat(F.lit("WARC-Date: "), date),
        F.concat(F.lit("WARC-Target-URI: "), url),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        # null fields are left out
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), name("refers_to"))),
        F.when(revisit, F.lit(f"WARC-Profile: {PROFILE}")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To-Payload-Length: "), F.col("bytes").cast("string"))),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), (F.octet_length(body) + len(HTTP_HEAD)).cast("string")),
    ]
    return found.select(F.concat(F.concat_ws(CRLF, *fields), F.lit(RECORD_END + HTTP_HEAD), body).alias("value"))


def write_archives(pages: DataFrame, path: str, archive_bytes: int = 16 << 20,
                   most_bytes: int = 512 << 20) -> None:
    """Archives of about ``archive_bytes``, never above ``most_bytes`` (or one record)."""
    size = F.octet_length("html") + 700
    sizes = pages.agg(F.avg(F.coalesce(size, F.lit(700))).alias("mean"), F.max(size).alias("most")).first()
    each = int(min(archive_bytes / (sizes["mean"] or 1), most_bytes / (sizes["most"] or 1)))
    (records(captures(pages)).write.option("lineSep", RECORD_END)
     .option("maxRecordsPerFile", max(1, each)).text(path))


def parsed(data: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, header fields, block) of every record of an archive."""
    at, blank = 0, RECORD_END.encode()
    while at < len(data):
        head = data.index(blank, at)
        lines = data[at:head].decode("utf-8").split(CRLF)
        fields = dict(line.split(": ", 1) for line in lines[1:])
        start = head + len(blank)
        end = start + int(fields["Content-Length"])
        if data[end:end + len(blank)] != blank:
            raise ValueError(f"a record at {at} does not end where its length says")
        yield at, fields, data[start:end]
        at = end + len(blank)


def page_of(name: str | None) -> int | None:
    digits = re.fullmatch(r"<urn:page:(-?\d+)>", name or "")
    return int(digits[1]) if digits else None


def url_key(url: str) -> str:
    """Host labels from the top level down, then path and query; no scheme, no fragment."""
    found = re.match(r"(?:[A-Za-z][A-Za-z0-9+.-]*://)?([^/?#]*)([^#]*)", url)
    return ",".join(reversed(found[1].lower().split("."))) + ")" + found[2]


ENTRY = ("url_key string, captured_at string, page_id long, run string, offset long, "
         "payload_bytes long, payload_digest string, record_type string, refers_to long")
COLUMNS = [c.split()[0] for c in ENTRY.split(", ")]
KEY = COLUMNS[:5]


def entry(run: str, offset: int, fields: dict[str, str], block: bytes) -> tuple:
    if fields["WARC-Type"] == "response":
        payload = block[block.index(RECORD_END.encode()) + 4:]
        size, digest = len(payload), hashlib.sha1(payload).hexdigest()
    else:
        size = int(fields["WARC-Refers-To-Payload-Length"])
        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    url = re.sub("%(0D|0A|25)", lambda m: chr(int(m[1], 16)), fields["WARC-Target-URI"])
    return (url_key(url), fields["WARC-Date"], page_of(fields["WARC-Record-ID"]), run, offset,
            size, digest, fields["WARC-Type"], page_of(fields.get("WARC-Refers-To")))


def order_of(row: tuple) -> tuple:
    """Nulls first, as Spark's ascending order has them."""
    return row[0], row[1], row[2] is not None, row[2] or 0, row[3], row[4]


def whole(rows: Iterator[tuple]) -> Iterator[pd.DataFrame]:
    for frame in frames(rows, COLUMNS):
        yield frame.astype({"page_id": "Int64", "refers_to": "Int64"})


def runs(archives: DataFrame) -> DataFrame:
    """Index entries of every archive, sorted inside it."""

    def read(blocks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block in blocks:
            for path, data in zip(block["path"], block["content"], strict=True):
                run = path.rsplit("/", 1)[-1]
                yield from whole(sorted((entry(run, *r) for r in parsed(bytes(data))), key=order_of))

    return archives.select("path", "content").mapInPandas(read, ENTRY)


class LoserTree:
    """Merges sorted lists: every inner node holds the loser of its match, so a new item of
    the winner's list plays only against the losers on its way up."""

    def __init__(self, lists: list[list[tuple]]):
        self.items = [iter(x) for x in lists]
        self.heads = [next(x, None) for x in self.items]
        self.keys = [None if h is None else order_of(h) for h in self.heads]
        self.k = len(lists)
        self.losers = [-1] * max(1, self.k)
        for leaf in range(self.k):
            self.play(leaf)

    def wins(self, a: int, b: int) -> bool:
        """Whether list a's head comes before list b's; an ended list always loses."""
        if self.keys[a] is None or self.keys[b] is None:
            return self.keys[a] is not None
        return self.keys[a] < self.keys[b]

    def play(self, leaf: int) -> None:
        winner, node = leaf, (leaf + self.k) // 2
        while node > 0:
            other = self.losers[node]
            if other < 0:  # while the tree is built: wait for the opponent
                self.losers[node] = winner
                return
            if self.wins(other, winner):
                self.losers[node], winner = winner, other
            node //= 2
        self.losers[0] = winner

    def __iter__(self) -> Iterator[tuple]:
        while self.k and self.heads[leaf := self.losers[0]] is not None:
            yield self.heads[leaf]
            self.heads[leaf] = head = next(self.items[leaf], None)
            self.keys[leaf] = None if head is None else order_of(head)
            self.play(leaf)


def merged(entries: DataFrame, range_rows: int = 100_000) -> DataFrame:
    """The entries with capture_seq, their place in the order of all captures, from 0."""
    entries = written(entries)
    ranges = max(8, entries.count() // range_rows)

    def merge(blocks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        slices: dict[str, list[tuple]] = {}
        for block in blocks:
            block = block.astype(object).where(block.notna(), None)
            for row in block.itertuples(index=False, name=None):
                slices.setdefault(row[3], []).append(row)
        for own in slices.values():
            own.sort(key=order_of)  # one pass where the shuffle has kept a run's order
        at = TaskContext.get().partitionId()
        first = 0
        for frame in whole(iter(LoserTree(list(slices.values())))):
            yield frame.assign(part=at, inside=range(first, first + len(frame)))
            first += len(frame)

    ranged = entries.repartitionByRange(ranges, *KEY)
    placed = written(ranged.mapInPandas(merge, ENTRY + ", part int, inside long"))
    # a row per range
    sizes = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = W.partitionBy(F.lit("all")).orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return (placed.join(F.broadcast(offsets), "part")
            .withColumn("capture_seq", F.col("before") + F.col("inside")).select(*COLUMNS, "capture_seq"))


def capture_index(pages: DataFrame) -> DataFrame:
    """Writes the archives below the shared folder, reads them back and merges their index."""
    spark = pages.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/warc-{uuid.uuid4().hex}"
    write_archives(pages, path)
    return merged(runs(spark.read.format("binaryFile").load(path)))
