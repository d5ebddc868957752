"""Operator 12: WARC archives and their index, merged from sorted runs by a loser tree.

Pages are dealt by payload digest, so that the copies of a payload meet: the one with the
largest page_id becomes a response record, the others revisit it. A task writes one archive;
reading an archive back gives a run of index entries, sorted locally by URL key and capture
time. Runs are cut at splitters chosen from a bounded sample of keys, into blocks; a range
between two splitters is merged by one task. Blocks reach it in order of their first keys,
which is the order in which a merge needs them, so it holds the open block of each run and
nothing else, whatever the length of the range.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.shared import scratch, stored, text_slices

#: Payload bytes of an archive on average: a reader holds a whole archive.
ARCHIVE_BYTES = 16 << 20
#: A digest that more than this share of all pages have is hot: at most 1000 of them.
HOT_SHARE = 1000
#: Tasks that the copies of a hot payload are dealt over.
HOT_TASKS = 256
#: Entries of a range on average, entries of a block, and keys in the sample.
RANGE_ENTRIES, BLOCK_ENTRIES, SAMPLE = 8192, 256, 4096
#: Capture time of page 0 where the table has none; page n is n seconds later.
FIRST_CAPTURE = datetime(2020, 1, 1, tzinfo=timezone.utc)

_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_ENTRY = [("url_key", pa.string()), ("captured", pa.int64()), ("page_id", pa.int64()), ("record_type", pa.string()),
          ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()),
          ("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64())]
_SQL_ENTRY = ("url_key string, captured long, page_id long, record_type string, payload_bytes long, "
              "payload_digest string, refers_to long, archive string, offset long, length long")


def url_key(url: str | None) -> str:
    """A sortable key: the host's labels reversed, then the path and the sorted query;
    without scheme, default port, leading ``www`` and fragment, in ASCII. Null: empty."""
    try:
        u = urlsplit((url or "").strip())
        host, port = (u.hostname or "").lower(), u.port
    except ValueError:
        return quote(url or "", safe="/:?&=%,;@")
    if host.startswith("www."):
        host = host[4:]
    port = f":{port}" if port and (u.scheme.lower(), port) not in (("http", 80), ("https", 443)) else ""
    query = "&".join(sorted(u.query.split("&"))) if u.query else ""
    key = ",".join(reversed(host.split("."))) + port + (")" if host else "") + (u.path or "/" if host else u.path)
    return quote(key + ("?" + query if query else ""), safe="/:?&=%,;@()+!*'$~.-_")


def _header_value(text: str) -> str:
    """A URL in a header line: white space, controls and other characters percent-encoded."""
    return quote(text, safe="/:?#[]@!$&'()*+,;=%-._~", errors="replace")


def base32_sha1(hexadecimal: str) -> str:
    return base64.b32encode(bytes.fromhex(hexadecimal)).decode()


def _name(page_id: int | None, digest: str, copy: str = "") -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}:{digest}{copy}>"


def render(page_id: int | None, url: str | None, payload: bytes, size: int, digest: str, captured: int,
           refers_to: str | None, copy: str = "") -> bytes:
    """A WARC/1.1 record without the two line ends after it."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    date = (datetime.fromtimestamp(0, timezone.utc) + timedelta(seconds=captured)).strftime("%Y-%m-%dT%H:%M:%SZ")
    lines = ["WARC/1.1", "WARC-Type: " + ("response" if refers_to is None else "revisit"),
             "WARC-Record-ID: " + _name(page_id, digest, copy), "WARC-Date: " + date]
    if url is not None:
        lines.append("WARC-Target-URI: " + _header_value(url))
    lines.append("WARC-Payload-Digest: sha1:" + digest)
    if refers_to is not None:
        lines += ["WARC-Profile: " + _PROFILE, "WARC-Refers-To: " + refers_to]
        payload = b""
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(http) + len(payload)}", "", ""]
    return "\r\n".join(lines).encode() + http + payload


def records(archive: bytes) -> Iterator[tuple[int, int, dict[str, str], memoryview]]:
    """(offset, length, headers, block) of each record; lengths rule, not separators."""
    at, view = 0, memoryview(archive)
    while at < len(archive):
        end = archive.index(b"\r\n\r\n", at)
        version, *lines = archive[at:end].decode().split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        headers = dict(line.split(": ", 1) for line in lines)
        stop = end + 4 + int(headers["Content-Length"])
        yield at, stop - at, headers, view[end + 4:stop]
        at = stop + 4


def plain(content: bytes) -> bytes:
    """An archive file's records; offsets count in these."""
    return gzip.decompress(content) if content[:2] == b"\x1f\x8b" else content


def _page(name: str) -> int | None:
    page = name[1:-1].split(":")[2]
    return None if page == "null" else int(page)


def entry(archive: str, offset: int, length: int, headers: dict[str, str], block: memoryview) -> tuple:
    """An index entry (columns of ``_ENTRY``) of a record, its payload checked."""
    http = bytes(block[:200])  # the HTTP header written by ``render`` is shorter
    split = http.index(b"\r\n\r\n") + 4
    size = int(http[:split].decode().split("Content-Length: ")[1].split("\r\n")[0])
    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
    if headers["WARC-Type"] == "response":
        payload = block[split:]
        if len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
            raise ValueError(f"damaged record at byte {offset} of {archive}")
    stamp = datetime.strptime(headers["WARC-Date"], "%Y-%m-%dT%H:%M:%SZ").replace(tzinfo=timezone.utc)
    refers = headers.get("WARC-Refers-To")
    return (url_key(headers.get("WARC-Target-URI")), int(stamp.timestamp()), _page(headers["WARC-Record-ID"]),
            headers["WARC-Type"], size, digest, _page(refers) if refers else None, archive, offset, length)


def order(e: tuple) -> tuple:
    """The sort key of an entry: URL key, capture time, page_id (nulls first)."""
    return e[0], e[1], e[2] is not None, e[2] or 0


class LoserTree:
    """Merges sorted runs that may join while it runs. A leaf is a run's open block; an
    inner node holds the loser of its match, so the next entry costs a match per level."""

    def __init__(self):
        self.blocks: list[list | None] = []
        self.at: list[int] = []
        self.keys: list[tuple | None] = []  # None: nothing left, loses every match
        self.losers: list[int] = []
        self.winner = -1

    def _beats(self, a: int, b: int) -> bool:
        x, y = self.keys[a], self.keys[b]
        return y is None or (x is not None and (x, a) <= (y, b))

    def add(self, blocks: list[list]) -> None:
        """Let new blocks join, in the places of finished ones first; all matches anew."""
        free = [i for i, k in enumerate(self.keys) if k is None]
        for block in blocks:
            if free:
                i = free.pop()
            else:
                i = len(self.blocks)
                self.blocks.append(None)
                self.at.append(0)
                self.keys.append(None)
            self.blocks[i], self.at[i], self.keys[i] = block, 0, order(block[0])
        n = len(self.blocks)
        self.losers = [0] * n
        best = [0] * n + list(range(n))
        for node in range(n - 1, 0, -1):
            a, b = best[2 * node], best[2 * node + 1]
            best[node], self.losers[node] = (a, b) if self._beats(a, b) else (b, a)
        self.winner = best[1] if n > 1 else 0

    def first(self) -> tuple | None:
        """The key of the next entry."""
        return self.keys[self.winner] if self.blocks else None

    def pop(self) -> tuple:
        i = self.winner
        block, at = self.blocks[i], self.at[i]
        self.at[i] = at + 1
        if at + 1 < len(block):
            self.keys[i] = order(block[at + 1])
        else:
            self.keys[i] = self.blocks[i] = None
        node = (i + len(self.blocks)) // 2
        while node:
            if self._beats(self.losers[node], i):
                self.losers[node], i = i, self.losers[node]
            node //= 2
        self.winner = i
        return block[at]


def _capture_time(column: str | None) -> Column:
    """Seconds since 1970, from 1970 to a year of four digits."""
    seconds = F.col(column) if column else F.lit(int(FIRST_CAPTURE.timestamp())) + F.least(
        F.coalesce("page_id", F.lit(0)), F.lit(1 << 37))
    return F.greatest(F.lit(0), F.least(F.coalesce(seconds, F.lit(0)), F.lit(1 << 37))).cast("long")


def write_archives(pages: DataFrame, out: str, archive_bytes: int = ARCHIVE_BYTES, hot_share: int = HOT_SHARE,
                   captured: str | None = None, compression: str = "gzip") -> None:
    """Write a WARC record per row of ``pages(page_id, url, html)`` to files in ``out``.

    The payload is the html (null: empty). Of rows with equal payloads that with the
    largest page_id (null: smallest; of equal ones the first by url) is a response, the
    others are revisits of it without a body. A null url has no target URI. ``captured``
    names a column of seconds since 1970; without it a page's time follows from its id.
    Other columns are not read. Spark's text writer, with two line ends as separator,
    writes whole files of WARC and commits them; ``compression`` is "gzip" or "none".
    Copies of a hot payload travel without it, as none of them needs it but the response.
    """
    stamp = _capture_time(captured)
    html = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", html.alias("html"), F.sha1(html).alias("digest"), stamp.alias("captured"))
    groups = stored(rows.groupBy("digest").agg(
        F.count("*").alias("n"), F.max("page_id").alias("last"), F.sum(F.length("html").cast("long")).alias("bytes")), "payloads")
    total = groups.agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes")).first()
    # fewer than hot_share digests can have more than the hot_share-th part of all pages
    hot = groups.where((F.col("n") > 1) & (F.col("n") * hot_share > (total.n or 0))).select(
        "digest", "last", F.lit(True).alias("hot"))
    salt = F.when(F.col("hot"), 1 + F.pmod(F.xxhash64("page_id"), F.lit(HOT_TASKS))).otherwise(0)
    dealt = rows.join(F.broadcast(hot), "digest", "left").withColumn("salt", salt).withColumn(
        "size", F.length("html")).withColumn("html", F.when(F.col("hot") & ~F.col("page_id").eqNullSafe(F.col("last")), F.lit(b"")).otherwise(F.col("html")))
    tasks = -(-(total.bytes or 0) // archive_bytes) + 1
    dealt = dealt.repartition(int(tasks), "digest", "salt").sortWithinPartitions(
        "digest", "salt", F.col("page_id").desc_nulls_last(), "url")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, response, count = None, None, 0
        for batch in text_slices(batches, "html"):
            made = []
            for page, url, payload, hexadecimal, when, last, is_hot, part, size in zip(*(c.to_pylist() for c in batch.columns)):
                digest = base32_sha1(hexadecimal)
                if group != (hexadecimal, part):
                    group, count = (hexadecimal, part), 0
                    response = last if is_hot else page
                    leads = not is_hot or page == last
                else:
                    leads, count = False, count + 1
                made.append(render(page, url, payload, size, digest, when,
                                   None if leads else _name(response, digest), "" if leads else f":{part}-{count}"))
            yield pa.record_batch([pa.array(made, pa.binary())], ["value"])

    dealt.select("page_id", "url", "html", "digest", "captured", "last", "hot", "salt", "size").mapInArrow(
        task, "value binary").select(F.col("value").cast("string").alias("value")).write.option(
        "lineSep", "\r\n\r\n").option("compression", compression).text(out)


def _splitters(pages: DataFrame, total: int, range_entries: int) -> list[tuple]:
    """Keys that cut the entries into about equal ranges, from a bounded sample of pages."""
    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch([pa.array([url_key(u and _header_value(u)) for u in batch.column(0).to_pylist()]),
                                   batch.column(1), batch.column(2)], ["k", "t", "p"])

    ranges = min(SAMPLE, total // range_entries + 1)
    if ranges < 2:
        return []
    sample = pages.orderBy(F.xxhash64("url", "captured", "page_id")).limit(SAMPLE).mapInArrow(
        keys, "k string, t long, p long").collect()
    got = sorted((r.k, r.t, r.p is not None, r.p or 0) for r in sample)
    return sorted({got[i * len(got) // ranges] for i in range(1, ranges)})


def runs(spark: SparkSession, folder: str, splitters: list[tuple], block_entries: int = BLOCK_ENTRIES) -> DataFrame:
    """Read the archives back: blocks ``(range, first_key, first_time, first_page, run,
    entries)`` of each archive's sorted run, cut at ``splitters``."""
    kinds = pa.struct(_ENTRY)
    names = ["range", "first_key", "first_time", "first_page", "run", "entries"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                path = batch.column(0)[i].as_py().rsplit("/", 1)[-1]
                run = sorted((entry(path, *r) for r in records(plain(batch.column(1)[i].as_py()))), key=order)
                out, held = [], []
                for e in run:
                    at = bisect_right(splitters, order(e))
                    if held and (at != place or len(held) == block_entries):
                        out.append((place, held))
                        held = []
                    place = at
                    held.append(e)
                if held:
                    out.append((place, held))
                if out:
                    lead = [b[0] for _, b in out]
                    flat = [dict(zip((n for n, _ in _ENTRY), e)) for _, b in out for e in b]
                    ends = [0]
                    for _, b in out:
                        ends.append(ends[-1] + len(b))
                    yield pa.record_batch([
                        pa.array([p for p, _ in out], pa.int32()), pa.array([e[0] for e in lead]),
                        pa.array([e[1] for e in lead], pa.int64()), pa.array([e[2] for e in lead], pa.int64()),
                        pa.array([path] * len(out)),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, kinds))], names)

    # an archive a batch would be best; Arrow batches hold at most what a scan task reads
    return spark.read.format("binaryFile").load(folder).select("path", "content").mapInArrow(
        task, f"range int, first_key string, first_time long, first_page long, run string, "
              f"entries array<struct<{_SQL_ENTRY.replace(' ', ':').replace(',:', ',')}>>")


def merged(blocks: DataFrame, ranges: int) -> DataFrame:
    """The runs' entries in one order: by ``range``, and by ``place`` within a range."""
    schema = pa.schema([("range", pa.int32()), ("place", pa.int64()), *_ENTRY])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, now, place, waiting, out = LoserTree(), None, 0, [], []

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

        def drained(until: tuple | None) -> Iterator[pa.RecordBatch]:
            """Emit what precedes the key ``until`` (None: everything)."""
            nonlocal place, out, waiting
            if waiting:
                tree.add(waiting)
                waiting = []
            while (key := tree.first()) is not None and (until is None or key < until):
                out.append((now, place, *tree.pop()))
                place += 1
                if len(out) == 4096:
                    yield batch_of(out)
                    out = []

        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                at = row.column(0)[0].as_py()
                entries = row.column(1)[0].values.flatten()
                block = list(zip(*(c.to_pylist() for c in entries)))
                if at != now:
                    yield from drained(None)
                    tree, now, place = LoserTree(), at, 0
                elif waiting and order(waiting[-1][0]) < order(block[0]) or not waiting:
                    yield from drained(order(block[0]))
                waiting.append(block)
        yield from drained(None)
        if out:
            yield batch_of(out)

    return blocks.repartitionById(ranges, "range").sortWithinPartitions(
        "range", "first_key", "first_time", F.col("first_page").asc_nulls_first(), "run").select(
        "range", "entries").mapInArrow(task, f"range int, place long, {_SQL_ENTRY}")


def capture_index(pages: DataFrame, archive_bytes: int = ARCHIVE_BYTES, range_entries: int = RANGE_ENTRIES,
                  block_entries: int = BLOCK_ENTRIES, hot_share: int = HOT_SHARE, captured: str | None = None) -> DataFrame:
    """Archive ``pages``, read the archives back and merge their indexes.

    Per page, also for repeated rows: ``page_id, payload_bytes, payload_digest, record_type,
    refers_to``, its ``url_key, captured`` (time), where its record is (``archive, offset,
    length``) and its place in the order of all captures (``range, place``). An empty table
    has an empty index. The archives stay in the shared folder.
    """
    spark = pages.sparkSession
    out = scratch(spark, "warc")
    write_archives(pages, out, archive_bytes, hot_share, captured)
    keyed = pages.select("url", _capture_time(captured).alias("captured"), "page_id")
    cut = _splitters(keyed, pages.count(), range_entries)
    return merged(runs(spark, out, cut, block_entries), len(cut) + 1).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key",
        F.timestamp_seconds("captured").alias("captured"), "archive", "offset", "length", "range", "place")


def archived(pages: DataFrame) -> DataFrame:
    """The contract's columns of ``capture_index``."""
    return capture_index(pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
#: Five hexadecimal digits of a SHA-1 are four base-32 digits.
ORACLE_SQL = f"""SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('{_BASE32}', CAST(1 +
    ((CAST('0x' || substr(sha1(h), CAST(1 + 5 * (i // 4) AS BIGINT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31)
    AS BIGINT), 1)), '') AS payload_digest,
  CASE WHEN r = 1 THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN r > 1 THEN last END AS refers_to
FROM (SELECT *, max(page_id) OVER (PARTITION BY h) AS last,
    row_number() OVER (PARTITION BY h ORDER BY page_id DESC NULLS LAST, url) AS r
  FROM (SELECT page_id, url, coalesce(html, '') AS h FROM pages))"""
