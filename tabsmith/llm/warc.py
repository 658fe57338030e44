"""WARC archives: a deterministic sharded writer and a reader.

Writer: records are range-sorted by (page id, payload digest); a shard is the payload bytes before a record divided by the
shard size, so shards depend on the data alone. A shard's files roll when their compressed size reaches a limit. Every record is a gzip member
of its own with regenerated headers and digests. Tasks write under temporary names; their manifest rows are written as
a table, and only then are the files of that manifest renamed and the manifest file put next to them.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabsmith.llm.common import attach, checkpointed, open_fs, q, read, scratch_dir, text_or_empty

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SPACE_ID = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the URL namespace of RFC 4122
CHUNK = 1 << 18


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page: int | None, sha: str, copy: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(SPACE_ID, f'{page}|{sha}|{copy}')}>"


def target_uri(url: str | None, page: int | None) -> str:
    """The url on one line, other characters than RFC 3986 allows percent-encoded; a urn if there is none."""
    return quote(url, safe="%:/?#[]@!$&'()*+,;=-._~") if url else f"urn:page:{page}"


def _header(lines: list[tuple[str, str | None]]) -> bytes:
    return "".join(f"{k}: {v}\r\n" for k, v in lines if v is not None).encode()


def record(row: dict, date: str, copy: int) -> bytes:
    """One WARC/1.1 record, uncompressed."""
    payload = row["html"].encode("utf-8", "surrogatepass")
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    revisit = row["revisit"]
    block = http if revisit else http + payload
    page = row["page"]
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(page, row["sha"], copy)),
            ("WARC-Date", date), ("WARC-Target-URI", target_uri(row["url"], page)),
            ("WARC-Payload-Digest", "sha1:" + digest(payload)), ("WARC-Block-Digest", "sha1:" + digest(block))]
    if revisit:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(row["first"], row["sha"], 0)),
                 ("WARC-Refers-To-Target-URI", target_uri(row["first_url"], row["first"])),
                 ("X-Refers-To-Page", None if row["first"] is None else str(row["first"]))]
    head += [("X-Page", None if page is None else str(page)), ("Content-Type", "application/http; msgtype=response"),
             ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + _header(head) + b"\r\n" + block + b"\r\n\r\n"


def member(data: bytes, level: int) -> bytes:
    """A gzip member without a time stamp, so that equal records give equal bytes."""
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


MANIFEST = "shard long, seq int, temp string, path string, records long, bytes long, sha256 string"


_MANIFEST = pa.schema([("shard", pa.int64()), ("seq", pa.int32()), ("temp", pa.string()), ("path", pa.string()),
                       ("records", pa.int64()), ("bytes", pa.int64()), ("sha256", pa.string())])


def _writer(folder: str, date: str, roll_bytes: int, level: int):
    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = open_fs(folder)
        fs.create_dir(f"{base}/_temporary", recursive=True)
        out = name = None
        shard, seq, n, size, check, last, copy, note = None, 0, 0, 0, None, None, 0, None

        def close() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_pydict({"shard": [shard], "seq": [seq], "temp": [name], "path": [
                f"{base}/shard-{shard:06d}-{seq:05d}.warc.gz"], "records": [n], "bytes": [size], "sha256": [check.hexdigest()]}, schema=_MANIFEST)

        for batch in frames:
            for row in batch.to_pylist():  # Arrow values: a 64-bit id beside a null stays an integer
                key = (row["page"], row["sha"])
                if row["kind"] == 0:
                    note = (key, row["first"], row["first_url"])
                    continue
                row["first"], row["first_url"] = note[1:] if note and note[0] == key else (row["page"], row["url"])
                if out is not None and (row["shard"] != shard or size >= roll_bytes):
                    yield close()
                    out, seq = None, seq + 1 if row["shard"] == shard else 0
                if row["shard"] != shard:
                    shard = row["shard"]
                copy = copy + 1 if key == last else 0
                last = key
                # of rows that repeat page and payload the first in order is the response, the others revisit it
                row["revisit"] = row["dedup"] and (row["page"] != row["first"] or copy > 0)
                if out is None:
                    name, n, size, check = f"{base}/_temporary/{uuid.uuid4().hex}.warc.gz", 0, 0, hashlib.sha256()
                    out = fs.open_output_stream(name, compression=None)
                data = member(record(row, date, copy), level)
                out.write(data)
                check.update(data)
                n, size = n + 1, size + len(data)
        if out is not None:
            yield close()

    return run


def _commit(folder: str):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow.fs import FileType

        fs, _ = open_fs(folder)
        for pdf in frames:
            for temp, path in zip(pdf["temp"], pdf["path"]):
                # a repeated attempt finds the file in place already
                if fs.get_file_info(path).type == FileType.NotFound:
                    fs.move(temp, path)
            yield pdf

    return run


MAX_SHARDS = 100_000  # so many bounds go to the driver at most; beyond that shards get larger


def _bounds(narrow: DataFrame, shard_bytes: int) -> list[tuple]:
    """The first key (no id, id, payload hash) of each shard but the first, in order: at most MAX_SHARDS.

    Spark range-partitions the keys, without payloads; a key's shard is the bytes before it (its partition's start, one
    number a partition, and the running sum inside the partition) by the shard size.
    """
    keys = narrow.groupBy("page", "sha").agg(F.sum("bytes").alias("bytes"))
    order = [F.col("page").asc_nulls_last(), F.col("sha")]
    placed = checkpointed(keys.repartitionByRange(*order).withColumn("part", F.spark_partition_id()))
    totals = placed.groupBy("part").agg(F.sum("bytes").alias("total"))  # a row a partition
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    size = max(shard_bytes, -(-int(totals.agg(F.sum("total")).first()[0] or 0) // (MAX_SHARDS - 1)))
    at = F.col("start") + F.sum("bytes").over(inside) - F.col("bytes")
    rows = placed.join(F.broadcast(starts), "part").select(F.floor(at / size).alias("shard"), F.struct(
        F.col("page").isNull().alias("none"), F.coalesce("page", F.lit(0)).alias("page"), "sha").alias("key"))
    firsts = rows.groupBy("shard").agg(F.min("key").alias("key")).orderBy("shard").collect()
    return [tuple(r.key) for r in firsts[1:]]


def _shard_column(bounds: list[tuple]):
    """Shard of (page is null, page or 0, sha); without nulls pandas keeps 64-bit integers as they are."""
    @F.pandas_udf("long")
    def shard(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for none, page, sha in parts:
            yield pd.Series([bisect_right(bounds, k) for k in zip(none.tolist(), page.tolist(), sha)], dtype="int64")

    return shard(F.col("page").isNull(), F.coalesce("page", F.lit(0)), F.col("sha"))


def write_warc(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url",
               html_col: str = "html", min_revisit_bytes: int = 0, shard_bytes: int = 16 << 20, roll_bytes: int = 64 << 20,
               date: str = "2024-01-01T00:00:00Z", level: int = 6) -> DataFrame:
    """Write a record per row of ``pages`` and return the committed manifest (MANIFEST columns and ``folder``).

    Of records with equal payloads of at least ``min_revisit_bytes`` bytes the one with the largest id is the response
    and the others are revisits of it; smaller payloads are all responses. A null payload is empty, a null id is below
    all others and a null url becomes a urn. Rows that repeat id and payload: the first of them is the response, the
    others revisit it. Ids are exact over all of 64 bits. Records are written in order of id, a shard of about
    ``shard_bytes`` payload bytes to a task (a longer payload is a shard of its own; a record is in memory at once), and
    a shard rolls to a new file beyond ``roll_bytes`` compressed bytes. Shards and bytes of every archive depend on the
    rows alone, not on partitions or retries. An empty table gives no file. Other columns are not written, whatever their
    names.
    """
    folder = folder or scratch_dir(pages.sparkSession, "warc")
    html = text_or_empty(html_col)
    rows = pages.select(F.col(q(id_col)).cast("long").alias("page"), F.col(q(url_col)).cast("string").alias("url"),
                        html.alias("html"), F.sha2(html.cast("binary"), 256).alias("sha"),
                        (F.octet_length(html) >= min_revisit_bytes).alias("dedup"), F.octet_length(html).cast("long").alias("bytes"))
    narrow = checkpointed(rows.select("page", "url", "sha", "dedup", "bytes"))
    n = narrow.count()
    rank = F.struct(F.col("page").isNotNull().alias("known"), "page", "url")
    groups = narrow.filter("dedup").groupBy("sha").agg(F.max(rank).alias("top"), F.count("*").alias("rows")).filter("rows > 1")
    groups = checkpointed(groups.select("sha", "rows", F.col("top.page").alias("first"), F.col("top.url").alias("first_url")))
    bounds = _bounds(narrow, shard_bytes)
    # Payloads are shuffled once, by shard. What a repeated payload refers to is found on the narrow rows and travels as
    # a row of its own that sorts just before the records it is for.
    notes = attach(narrow, groups, "sha", "rows", n).select("page", "sha", "first", "first_url").distinct()
    none = lambda kind: F.lit(None).cast(kind)
    notes = notes.select("page", "sha", F.lit(0).alias("kind"), none("string").alias("url"), none("string").alias("html"),
                         F.lit(True).alias("dedup"), "first", "first_url")
    records = rows.select("page", "sha", F.lit(1).alias("kind"), "url", "html", "dedup", none("long").alias("first"),
                          none("string").alias("first_url"))
    found = records.unionByName(notes).withColumn("shard", _shard_column(bounds))
    order = ["shard", F.col("page").asc_nulls_last(), "sha", "kind", "url"]
    laid = found.repartitionById(len(bounds) + 1, F.col("shard").cast("int")).sortWithinPartitions(*order)
    manifest = checkpointed(laid.mapInArrow(_writer(folder, date, roll_bytes, level), MANIFEST))
    done = checkpointed(manifest.repartition(max(1, min(64, manifest.count())), "path").mapInPandas(_commit(folder), MANIFEST))
    _write_manifest(done, folder)
    return done.withColumn("folder", F.lit(folder))


def _write_manifest(done: DataFrame, folder: str) -> None:
    """The list of committed files, one JSON line each, streamed to a temporary name and renamed last."""
    fs, base = open_fs(folder)
    fs.create_dir(f"{base}/_temporary", recursive=True)
    temp = f"{base}/_temporary/{uuid.uuid4().hex}.manifest"
    with fs.open_output_stream(temp) as out:
        for r in done.orderBy("shard", "seq").toLocalIterator():
            out.write((json.dumps({"file": r["path"].rsplit("/", 1)[1], "records": r["records"], "bytes": r["bytes"],
                                   "sha256": r["sha256"]}) + "\n").encode())
    fs.move(temp, f"{base}/MANIFEST.jsonl")


def members(source) -> Iterator[bytes]:
    """The gzip members of a stream, one after another, each in full."""
    rest, parts, z = b"", [], zlib.decompressobj(31)
    while True:
        data = rest or source.read(CHUNK)
        rest = b""
        if not data:
            if parts:
                raise ValueError("the archive ends inside a record")
            return
        parts.append(z.decompress(data))
        if z.eof:
            rest = z.unused_data
            yield b"".join(parts)
            parts, z = [], zlib.decompressobj(31)


def parse(raw: bytes) -> dict:
    """Headers and block of a record; checks its length and block digest."""
    head, _, body = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines[1:])}
    length = int(fields["content-length"])
    block = body[:length]
    if len(block) != length or body[length:] != b"\r\n\r\n" or fields["warc-block-digest"] != "sha1:" + digest(block):
        raise ValueError(f"damaged record {fields.get('warc-record-id')}")
    return fields | {"block": block}


RECORD = ("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, "
          "record_id string, file string, payload string")
_LENGTH = re.compile(rb"^Content-Length: (\d+)\r$", re.MULTILINE)


_RECORD = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()),
                     ("refers_to", pa.int64()), ("url", pa.string()), ("record_id", pa.string()), ("file", pa.string()), ("payload", pa.string())])


def _reader(with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path, folder in ((x["path"], x["folder"]) for batch in batches for x in batch.to_pylist()):
            fs, _ = open_fs(folder)
            rows, held = [], 0
            with fs.open_input_stream(path, compression=None) as f:
                for raw in members(f):
                    r = parse(raw)
                    http, _, payload = r["block"].partition(b"\r\n\r\n")
                    size = int(_LENGTH.search(http + b"\r\n").group(1))
                    own = r["warc-payload-digest"].removeprefix("sha1:")
                    if r["warc-type"] == "response" and (size != len(payload) or own != digest(payload)):
                        raise ValueError(f"payload differs from its headers: {r['warc-record-id']}")
                    number = lambda k: int(r[k]) if k in r else None  # noqa: E731,B023
                    rows.append((number("x-page"), size, own, r["warc-type"], number("x-refers-to-page"),
                                 r["warc-target-uri"], r["warc-record-id"], path,
                                 payload.decode("utf-8", "surrogatepass") if with_payload and r["warc-type"] == "response" else None))
                    held += len(payload)
                    if len(rows) >= 1000 or held >= 16 << 20:
                        yield _batch(rows)
                        rows, held = [], 0
            if rows:
                yield _batch(rows)

    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _RECORD.types)], schema=_RECORD)


def read_warc(manifest: DataFrame, with_payload: bool = False) -> DataFrame:
    """One row per record of the manifest's archives, digests checked; a revisit has no payload of its own."""
    files = manifest.select("path", "folder")
    return files.repartition(max(1, manifest.count()), "path").mapInArrow(_reader(with_payload), RECORD)


def op6_warc_round_trip(spark, sf_dir: str) -> DataFrame:
    manifest = write_warc(read(spark, sf_dir, "pages"))
    return read_warc(manifest).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def _base32_sql(hex_column: str) -> str:
    quads = [f"('0x' || substr({hex_column}, {5 * g + 1}, 5))::BIGINT" for g in range(8)]
    chars = [f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (({v} >> {s}) & 31)::INTEGER + 1, 1)" for v in quads for s in (15, 10, 5, 0)]
    return " || ".join(chars)


OP6_SQL = f"""
SELECT page_id, strlen(p)::BIGINT AS payload_bytes, {_base32_sql('h')} AS payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
FROM (SELECT page_id, p, sha1(p) AS h, max(page_id) OVER (PARTITION BY p) AS top
      FROM (SELECT page_id, coalesce(html, '') AS p FROM pages))
"""
