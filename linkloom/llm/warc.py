"""Web archives with revisit records, and their capture index by external merge.

Writing: pages with equal payloads keep one response record, the others become
revisit records that name it. Every record is a gzip member of its own, so a record
can be fetched by its offset. Reading: each archive is read back into a run of index
entries sorted by URL key and time. Merging: entries are dealt over ranges of the
whole key (URL key, time, page), so one busy URL spreads over several ranges, and
each range merges the sorted stretches it gets with a loser tree. Ranges follow
each other, so the index is in global order.

Nulls: a null payload is empty, a null URL has the empty URL key, a null page_id
sorts before others in the index and is never chosen as response if its group has
another page. Rows repeating a page_id and payload are written each, alike.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm import common

# Compressed bytes after which a task begins its next archive.
ARCHIVE_BYTES = 64 << 20
# Index entries that one range merges in memory.
RANGE_ENTRIES = 200_000
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_MANIFEST = pa.schema([("archive", pa.string()), ("n_records", pa.int64()), ("n_bytes", pa.int64())])
_ENTRY = pa.schema([
    ("urlkey", pa.string()), ("captured", pa.string()), ("page_id", pa.int64()), ("payload_bytes", pa.int64()),
    ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
    ("archive", pa.string()), ("offset", pa.int64()), ("size", pa.int64()),
])
_ENTRY_DDL = (
    "urlkey string, captured string, page_id long, payload_bytes long, payload_digest string, record_type string, "
    "refers_to long, archive string, offset long, size long"
)


def url_key(url: str | None) -> str:
    """Sort-friendly key: host parts reversed, then path and query; no scheme, fragment or ``www``."""
    if not url:
        return ""
    found = re.match(r"(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)([^#]*)", url)
    if not found:
        return url.partition("#")[0]
    host = found[1].rpartition("@")[2].lower()
    host, port = re.fullmatch(r"(.*?)((?::\d*)?)", re.sub(r"^www\d*\.", "", host)).groups()
    return ",".join(reversed(host.split("."))) + ("" if port in (":", ":80", ":443") else port) + ")" + (found[2] or "/")


def _one_line(value: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda c: f"%{ord(c[0]):02X}", value)


def record(kind: str, headers: dict[str, str | None], block: bytes) -> bytes:
    """A WARC record as one gzip member."""
    lines = ["WARC/1.1", f"WARC-Type: {kind}"]
    lines += [f"{k}: {v}" for k, v in headers.items() if v is not None]
    lines.append(f"Content-Length: {len(block)}")
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    head = ("\r\n".join(lines) + "\r\n\r\n").encode()
    return pack.compress(head) + pack.compress(block) + pack.compress(b"\r\n\r\n") + pack.flush()


def capture(page_id: int | None, url: str | None, date: str, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    name = lambda i: None if i is None else f"<urn:page:{i}>"
    headers = {
        "WARC-Record-ID": name(page_id), "WARC-Date": date,
        "WARC-Target-URI": None if url is None else _one_line(url),
        "WARC-Payload-Digest": f"sha1:{digest}", "Content-Type": "application/http; msgtype=response",
    }
    if revisit:
        headers |= {"WARC-Profile": REVISIT_PROFILE, "WARC-Refers-To": name(refers_to)}
    return record("revisit" if revisit else "response", headers, http if revisit else http + payload)


def read_archive(data, archive: str) -> Iterator[dict]:
    """Index entries of an archive's captures, in file order; digests are taken from the payloads held."""
    view, at = memoryview(data), 0
    while at < len(view):
        unpack = zlib.decompressobj(31)
        parts, end = [], at
        while not unpack.eof:
            step = view[end:end + 65536]
            if not step:
                raise ValueError(f"{archive} ends inside a record")
            parts.append(unpack.decompress(step))
            end += len(step)
        end -= len(unpack.unused_data)
        member = b"".join(parts)
        head, _, rest = member.partition(b"\r\n\r\n")
        headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        block = rest[:int(headers["Content-Length"])]
        kind = headers["WARC-Type"]
        if kind in ("response", "revisit"):
            http, _, payload = block.partition(b"\r\n\r\n")
            size = int(re.search(rb"Content-Length: (\d+)", http)[1])
            digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
            if kind == "response" and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
                raise ValueError(f"{archive}: the payload at {at} does not match its digest")
            page = lambda field: int(headers[field][10:-1]) if field in headers else None
            yield {
                "urlkey": url_key(headers.get("WARC-Target-URI")), "captured": headers["WARC-Date"],
                "page_id": page("WARC-Record-ID"), "payload_bytes": size, "payload_digest": digest, "record_type": kind,
                "refers_to": page("WARC-Refers-To"), "archive": archive, "offset": at, "size": end - at,
            }
        at = end


def entry_key(entry: dict) -> tuple:
    page = entry["page_id"]
    return entry["urlkey"], entry["captured"], page is not None, page or 0, entry["archive"], entry["offset"]


def decide(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Pages with their record's kind: page_id, url, captured, payload (null for revisits), refers_to, revisit.

    The response of a payload is its smallest page_id, found by an aggregate over
    digests that combines before the shuffle. Only digests with several pages are
    joined back; copies of one payload are alike, so a hot digest may be split.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    # Pages carry no time of capture: they count as fetched one per second in id order.
    captured = F.date_format(
        F.timestamp_seconds(F.lit(1_704_067_200) + F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(10**9))), "yyyy-MM-dd'T'HH:mm:ss'Z'"
    )
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), "url", captured.alias("captured"), payload.alias("payload"),
    ).withColumn("_digest", F.sha1("payload"))
    kept = (
        rows.where(F.octet_length("payload") >= min_bytes).groupBy("_digest")
        .agg(F.min("page_id").alias("_first"), F.count(F.lit(1)).alias("_copies")).where("_copies > 1").drop("_copies")
    )
    revisit = F.col("_first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first"))
    return rows.join(kept.hint("shuffle_hash"), "_digest", "left").select(
        "page_id", "url", "captured", "payload", F.when(revisit, F.col("_first")).alias("refers_to"), revisit.alias("revisit"),
    )


def write_archives(records: DataFrame, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write decided pages as archives in the shared folder; returns the manifest (archive, n_records, n_bytes)."""
    folder = common.shared_folder(records.sparkSession, "warc")

    def write(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        made, held, size = [], [], 0

        def flush() -> None:
            path = f"{folder}/pages-{context.partitionId():06d}-{len(made):04d}-{context.taskAttemptId()}.warc.gz"
            info = record("warcinfo", {"WARC-Filename": path.rpartition("/")[2], "Content-Type": "application/warc-fields"}, b"format: WARC File Format 1.1\r\n")
            total = common.write_file(path, [info, *held])
            made.append({"archive": path, "n_records": len(held), "n_bytes": total})
            held.clear()

        for batch in rows:
            # a slice at a time, so that few payloads are held twice
            for start in range(0, batch.num_rows, 256):
                for row in batch.slice(start, 256).to_pylist():
                    held.append(capture(row["page_id"], row["url"], row["captured"], row["payload"], row["refers_to"], row["revisit"]))
                    size += len(held[-1])
                    if size >= archive_bytes:
                        flush()
                        size = 0
        if held:
            flush()
        if made:
            yield pa.RecordBatch.from_pylist(made, _MANIFEST)

    return common.stored(records.mapInArrow(write, "archive string, n_records long, n_bytes long"), "warc-manifest")


def read_runs(manifest: DataFrame) -> DataFrame:
    """Read archives back, each into a run of entries sorted by URL key and time, kept in the shared folder."""

    def read(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for archive in batch.column(0).to_pylist():
                run = sorted(read_archive(common.read_file(archive), archive), key=entry_key)
                yield from common.batches(iter(run), _ENTRY)

    spread = manifest.select("archive").repartition(common.partitions_for(manifest.sparkSession))
    return common.stored(spread.mapInArrow(read, _ENTRY_DDL), "warc-runs")


def loser_tree_merge(runs: list[list[tuple]]) -> Iterator[tuple]:
    """Merge sorted runs of (key, value).

    Leaves are the runs' heads; every inner node keeps the loser of its match and
    passes the winner up, so replacing the champion replays one path: one
    comparison per level. Equal keys come in the runs' order.
    """
    runs = [run for run in runs if run]
    k = len(runs)
    heads = [run[0][0] for run in runs]
    at = [0] * k

    def before(a: int, b: int) -> bool:
        if heads[a] is None or heads[b] is None:
            return heads[b] is None and heads[a] is not None
        return (heads[a], a) < (heads[b], b)

    winner, loser = [0] * k + list(range(k)), [0] * k
    for node in range(k - 1, 0, -1):
        a, b = winner[2 * node], winner[2 * node + 1]
        winner[node], loser[node] = (a, b) if before(a, b) else (b, a)
    champion = winner[1] if k else None
    while k and heads[champion] is not None:
        run = runs[champion]
        yield run[at[champion]]
        at[champion] += 1
        heads[champion] = run[at[champion]][0] if at[champion] < len(run) else None
        node = (k + champion) // 2
        while node:
            if before(loser[node], champion):
                loser[node], champion = champion, loser[node]
            node //= 2


def merge_index(runs: DataFrame, range_entries: int = RANGE_ENTRIES) -> DataFrame:
    """All captures in global order of URL key, time and page; partitions are consecutive ranges of it."""
    spark = runs.sparkSession
    parts = max(spark.sparkContext.defaultParallelism, -(-runs.count() // range_entries))

    def merge(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stretches: list[list[tuple]] = []
        for batch in rows:
            for entry in batch.to_pylist():
                item = (entry_key(entry), entry)
                # a run's rows arrive in order; where the order breaks, another run begins
                if stretches and stretches[-1][-1][0] <= item[0]:
                    stretches[-1].append(item)
                else:
                    stretches.append([item])
        yield from common.batches((entry for _, entry in loser_tree_merge(stretches)), _ENTRY)

    return runs.repartitionByRange(parts, "urlkey", "captured", "page_id", "archive", "offset").mapInArrow(merge, _ENTRY_DDL)


def archive_pages(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write ``pages(page_id, url, html)`` as archives, read them back, and return the merged index."""
    return merge_index(read_runs(write_archives(decide(pages, min_bytes))))
