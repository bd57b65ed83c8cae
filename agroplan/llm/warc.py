"""WARC archives and a globally ordered capture index by external merge.

Writing: each page becomes one gzip member of an archive. Of the pages with equal payloads the one
with the largest id is a ``response``, the others are ``revisit`` records that name it. Reading: each
archive gives a run of captures, sorted by URL key (host labels reversed, then path and query),
timestamp and id; runs are cut into blocks. Merging: the key space is cut into ranges of about equal
size, the runs are cut at the ranges' bounds, and loser trees merge the runs of a range, block by block
and at most ``FAN_IN`` at a time. The result's rank is a capture's place in the whole order.

Null html is an empty payload, a null url an empty key; equal rows are records of their own, and of
rows with the largest id all are responses; a null id is a record that never is referred to; other
columns are not looked at; an empty table gives no archive and an empty index.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import json
import re
import uuid
import zlib
from datetime import datetime, timedelta, timezone

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import new_path, shuffle_partitions, written
from .files import read_file, write_file

#: Bytes after which a task begins a new archive, and captures in a block of a run.
ARCHIVE_BYTES, BLOCK = 16 << 20, 2048
#: Runs that one loser tree merges.
FAN_IN = 128
_START = datetime(2024, 1, 1, tzinfo=timezone.utc)
#: Negative ids are counted down from here in record ids.
_IDS = 1 << 64


def digest_text(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def url_key(url: str | None) -> str:
    """Sortable form of a url: ``com,example,www)/path?query``."""
    found = re.match(r"(?s)[^:]*://([^/?#]*)([^#]*)", url or "")
    if not found:
        return (url or "").split("#")[0]
    host = found[1].lower().rpartition("@")[2].removesuffix(":80").removesuffix(":443")
    return ",".join(reversed(host.split("."))) + ")" + (found[2] or "/")


def record_bytes(page: int | None, url: str | None, when: str, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC record as a gzip member."""
    head = {"WARC-Type": "response" if refers_to is None else "revisit", "WARC-Record-ID": f"<urn:uuid:{uuid.UUID(int=page % _IDS)}>" if page is not None else f"<urn:uuid:{uuid.uuid4()}>", "WARC-Date": when}
    if url is not None:
        head["WARC-Target-URI"] = re.sub(r"[\x00-\x20\x7f]", lambda c: f"%{ord(c[0]):02X}", url)
    head["WARC-Payload-Digest"] = "sha1:" + digest_text(payload)
    if refers_to is not None:
        head |= {"WARC-Refers-To": f"<urn:uuid:{uuid.UUID(int=refers_to % _IDS)}>", "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"}
    head |= {"X-Page-ID": "" if page is None else str(page), "X-Payload-Length": str(len(payload)), "Content-Type": "text/html; charset=utf-8"}
    body = payload if refers_to is None else b""
    head["Content-Length"] = str(len(body))
    pack = zlib.compressobj(4, zlib.DEFLATED, 31)
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()) + "\r\n"
    return pack.compress(text.encode() + body + b"\r\n\r\n") + pack.flush()


def read_records(data: bytes):
    """``(offset, length, headers, body)`` of each gzip member of an archive."""
    at = 0
    while at < len(data):
        unpack = zlib.decompressobj(31)
        raw = unpack.decompress(memoryview(data)[at:])
        length = len(data) - at - len(unpack.unused_data)
        head, _, rest = raw.partition(b"\r\n\r\n")
        headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        yield at, length, headers, rest[: int(headers["Content-Length"])]
        at += length


def write_archives(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write the archives; ``(archive, n_records, n_bytes)`` per file."""
    spark = pages.sparkSession
    folder = new_path(spark, "warc")
    pages = pages.select(F.col(id_col).cast("long").alias("page"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html")).withColumn("sha", F.unhex(F.sha1("html")))
    same = pages.select("page", "sha").where("page is not null").distinct()
    first = same.groupBy("sha").agg(F.max("page").alias("response"), F.count(F.lit(1)).alias("n"))
    # only payloads with more than one id have revisits; the html itself is not shuffled unless they are many
    revisits = written(same.join(first.where("n > 1"), "sha").where("page < response").select("page", "sha", "response"), "revisits")
    revisits = F.broadcast(revisits) if revisits.count() <= 500_000 else revisits
    marked = pages.join(revisits, ["page", "sha"], "left").select("page", "url", "html", "response")

    def run(batches):
        data, n, part, size = [], 0, 0, 0

        def close():
            path = write_file(folder, f"capture-{part:05d}", b"".join(data))
            return pa.RecordBatch.from_pylist([{"archive": path, "n_records": n, "n_bytes": size}])

        for batch in batches:
            for page, url, html, response in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                when = (_START + timedelta(seconds=(page or 0) % (1 << 31))).strftime("%Y-%m-%dT%H:%M:%SZ")
                data.append(record_bytes(page, url, when, html.encode(), response))
                n += 1
                size += len(data[-1])
                if size > ARCHIVE_BYTES:
                    yield close()
                    data, n, part, size = [], 0, part + 1, 0
        if data:
            yield close()

    return written(marked.mapInArrow(run, "archive string, n_records long, n_bytes long"), "archives")


def capture_runs(archives: DataFrame) -> DataFrame:
    """``(run, block, first_key, last_key, captures)``: each archive's sorted captures, read back, in blocks."""

    def run(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows = []
                for offset, length, head, body in read_records(read_file(path)):
                    digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
                    kind, refers = head["WARC-Type"], head.get("WARC-Refers-To")
                    if kind == "response" and digest_text(body) != digest:
                        raise ValueError(f"{path}: the record at {offset} is damaged")
                    page = int(head["X-Page-ID"]) if head["X-Page-ID"] else None
                    size = len(body) if kind == "response" else int(head["X-Payload-Length"])
                    when = re.sub(r"\D", "", head["WARC-Date"])
                    rows.append((url_key(head.get("WARC-Target-URI")), when, page if page is not None else -1, offset, length, kind, digest, size, signed(uuid.UUID(refers[10:-1]).int) if refers else None, page))
                rows.sort(key=lambda r: r[:4])
                for n, at in enumerate(range(0, len(rows), BLOCK)):
                    part = rows[at : at + BLOCK]
                    yield pa.RecordBatch.from_pylist([{"run": path, "block": n, "first_key": sort_key(part[0]), "last_key": sort_key(part[-1]), "captures": zlib.compress(json.dumps(part).encode(), 1)}])

    dealt = archives.select("archive").repartition(shuffle_partitions(archives.sparkSession), "archive")
    return written(dealt.mapInArrow(run, "run string, block long, first_key string, last_key string, captures binary"), "runs")


def signed(number: int) -> int:
    """A record id's number as the 64-bit id that it stands for."""
    return number - _IDS if number >= _IDS // 2 else number


def sort_key(capture) -> str:
    """URL key, timestamp and id as one string that sorts like them."""
    return f"{capture[0]}\x00{capture[1]}\x00{capture[2] + (1 << 63):020d}\x00{capture[3]:020d}"


class LoserTree:
    """Merges sorted iterators of tuples; each step replays one path from a leaf to the root."""

    def __init__(self, runs):
        self.runs = [iter(r) for r in runs]
        self.k = max(1, len(self.runs))
        self.heads = [next(r, None) for r in self.runs] + [None] * (self.k - len(self.runs))
        self.losers = [-1] * self.k
        for leaf in reversed(range(self.k)):
            self._replay(leaf)

    def _less(self, a: int, b: int) -> bool:
        """Whether run a's head goes before b's: an unset node before all, a spent run after all."""
        if a < 0 or b < 0:
            return a < 0
        x, y = self.heads[a], self.heads[b]
        return y is None if x is None or y is None and x is not None else (x, a) < (y, b)

    def _replay(self, winner: int) -> None:
        node = (winner + self.k) // 2
        while node:
            if self._less(self.losers[node], winner):
                self.losers[node], winner = winner, self.losers[node]
            node //= 2
        self.losers[0] = winner

    def __iter__(self):
        while (top := self.losers[0]) >= 0 and self.heads[top] is not None:
            yield self.heads[top]
            self.heads[top] = next(self.runs[top], None)
            self._replay(top)


def merge_streams(streams: list):
    """Merges sorted iterators in passes of at most ``FAN_IN`` at a time."""
    while len(streams) > FAN_IN:
        streams = [iter(list(LoserTree(streams[at : at + FAN_IN]))) for at in range(0, len(streams), FAN_IN)]
    return LoserTree(streams)


def range_bounds(runs: DataFrame) -> list[str]:
    """The first keys of ranges of about equal size, from the blocks' first keys; at most one per shuffle partition."""
    ends = runs.select("first_key").repartitionByRange(shuffle_partitions(runs.sparkSession), "first_key").groupBy(F.spark_partition_id().alias("p")).agg(F.min("first_key").alias("k"))
    return sorted(r["k"] for r in ends.collect())[1:]


def cut_runs(runs: DataFrame, bounds: list[str]) -> DataFrame:
    """``(range, run, block, captures)``: the runs' blocks cut at the bounds, so that each capture is shipped once."""

    def run(batches):
        for batch in batches:
            for name, block, data in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("run", "block", "captures")), strict=True):
                captures = json.loads(zlib.decompress(data))
                keys = [sort_key(c) for c in captures]
                at, rows = 0, []
                while at < len(keys):
                    number = bisect.bisect_right(bounds, keys[at])
                    end = bisect.bisect_left(keys, bounds[number], at) if number < len(bounds) else len(keys)
                    rows.append({"range": number, "run": name, "block": block, "captures": zlib.compress(json.dumps(captures[at:end]).encode(), 1)})
                    at = end
                yield pa.RecordBatch.from_pylist(rows, schema)

    schema = pa.schema([("range", pa.int32()), ("run", pa.string()), ("block", pa.int64()), ("captures", pa.binary())])
    return runs.select("run", "block", "captures").mapInArrow(run, "range int, run string, block long, captures binary")


def merge_runs(runs: DataFrame) -> DataFrame:
    """The capture index in its global order: one row per capture, with ``rank`` from 0."""
    placed = cut_runs(runs, range_bounds(runs))

    def merge(table: pa.Table) -> pa.Table:
        number = table.column("range")[0].as_py()
        by_run: dict[str, list] = {}
        for run, block, data in zip(*(table.column(c).to_pylist() for c in ("run", "block", "captures")), strict=True):
            by_run.setdefault(run, []).append((block, data))

        def stream(run: str, blocks: list):
            for _, data in sorted(blocks):
                for capture in json.loads(zlib.decompress(data)):
                    yield sort_key(capture), run, capture

        rows = []
        for place, (_, run, c) in enumerate(merge_streams([stream(r, b) for r, b in sorted(by_run.items())])):
            rows.append({"range": number, "place": place, "url_key": c[0], "timestamp": c[1], "page_id": c[9], "payload_bytes": c[7], "payload_digest": c[6], "record_type": c[5], "refers_to": c[8], "archive": run, "offset": c[3], "length": c[4]})
        return pa.Table.from_pylist(rows, schema)

    schema = pa.schema([("range", pa.int32()), ("place", pa.int64()), ("url_key", pa.string()), ("timestamp", pa.string()), ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])
    kinds = "range int, place long, url_key string, timestamp string, page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, archive string, offset long, length long"
    merged = written(placed.groupBy("range").applyInArrow(merge, kinds), "index")
    sizes = merged.groupBy("range").agg(F.count(F.lit(1)).alias("n"))  # one row per range
    before = sizes.select("range", (F.sum("n").over(W.orderBy("range")) - F.col("n")).alias("before"))
    return merged.join(F.broadcast(before), "range").withColumn("rank", F.col("before") + F.col("place")).drop("range", "place", "before")
