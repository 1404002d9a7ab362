"""A deterministic, sharded WARC writer and its reader.

Shards are ranges of page ids with about equal numbers of rows, found by exact counts, so that neither
sampling nor the size of the cluster decides where a record goes. A shard is sorted and written by one
task, one gzip member per record; a file is closed once its compressed size reaches ``file_bytes``.

A task writes below ``_temporary`` under a name of its own and returns what it wrote. Those rows, as
kept by Spark's commit of exactly one attempt per task, are the manifest; only files in it are moved
to their final names. The move can be repeated, and readers follow the manifest alone.

Payloads that occur more than once and are at least ``revisit_bytes`` long are written once, with the
largest page id; the others become revisit records without payload.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from mailsift.session import scratch_path, stored


# --- fixed values -----------------------------------------------------------------------------
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# ----------------------------------------------------------------------------------------------

REVISIT_BYTES = 1000
FILE_BYTES = 64 << 20
# Shards have about this many rows; beyond MAX_SHARDS of them they get larger instead.
SHARD_ROWS = 4_096
MAX_SHARDS = 16_384
# Page ids are counted in ranges of this length to find the shards.
ID_RANGE = 1_024
SALTS = 32
# Where the page without an id is put.
NO_PAGE = -(1 << 62)
LEVEL = 3
# No capture time is known, and a clock would make every run write other bytes.
CAPTURED = "1970-01-01T00:00:00Z"

MANIFEST = "shard long, file int, name string, temporary string, records long, bytes long, sha1 string"
READ = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
    "refers_to long, verified boolean"
)


def _identified(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url`` and ``payload``, with the payload's length and hex digest."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload"))
    return rows.select(
        "*", F.length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest")
    )


def _digests(rows: DataFrame) -> DataFrame:
    """(page_id, payload_digest, payload_bytes, rows), one row per distinct page and payload."""
    keys = ("page_id", "payload_digest", "payload_bytes")
    return stored(rows.groupBy(*keys).agg(F.count("*").alias("rows")), "warc-ids")


def revisits(digests: DataFrame, least_bytes: int) -> DataFrame:
    """(page_id, payload_digest, refers_to) of the pages that repeat the payload of another one.

    Only ids and digests move, and the copies of one payload are dealt over ``SALTS`` keys.
    """
    shared = (
        digests.filter(F.col("payload_bytes") >= least_bytes)
        .groupBy("payload_digest", "payload_bytes")
        .agg(F.max("page_id").alias("refers_to"), F.count("*").alias("_n"))
        .filter((F.col("_n") > 1) & F.col("refers_to").isNotNull())
    )
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt")
    shared = shared.select("payload_digest", "payload_bytes", "refers_to", salts)
    salted = digests.withColumn("_salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int"))
    found = salted.join(shared, ["payload_digest", "payload_bytes", "_salt"])
    found = found.filter(~F.col("page_id").eqNullSafe(F.col("refers_to")))
    return found.select("page_id", "payload_digest", "refers_to")


def shard_starts(digests: DataFrame, shard_rows: int) -> np.ndarray:
    """The least page id of each shard but the first: at most ``MAX_SHARDS`` numbers. Rows are counted
    in short ranges of ids, which follow each other into shards. Null ids come first."""
    first = F.floor(F.coalesce("page_id", F.lit(NO_PAGE)) / ID_RANGE).cast("long")
    counts = digests.groupBy(first.alias("range")).agg(F.sum("rows").alias("n"))
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("n").over(Window.partitionBy())
    size = F.greatest(F.lit(shard_rows), F.ceil(total / MAX_SHARDS))
    shard = F.floor(F.coalesce(F.sum("n").over(earlier), F.lit(0)) / size)
    starts = counts.select("range", shard.alias("shard")).groupBy("shard").agg(F.min("range").alias("range"))
    return np.array(sorted(r["range"] * ID_RANGE for r in starts.collect())[1:], np.int64)


def _digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _name(page_id: int | None) -> str:
    return f"<urn:x-page:{'null' if page_id is None else page_id}>"


def _record(row: dict) -> bytes:
    """One record: WARC headers, HTTP headers, and the payload unless it is a revisit."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {row['payload_bytes']}\r\n\r\n"
    ).encode()
    revisit = row["refers_to"] is not None
    block = http if revisit else http + row["payload"]
    headers = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": _name(row["page_id"]),
        "WARC-Date": CAPTURED,
        "Content-Type": "application/http;msgtype=response",
        "Content-Length": str(len(block)),
        "WARC-Block-Digest": _digest(block),
        "WARC-Payload-Digest": "sha1:" + base64.b32encode(bytes.fromhex(row["payload_digest"])).decode(),
    }
    if row["url"] is not None:
        headers["WARC-Target-URI"] = "".join(
            c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in row["url"]
        )
    if revisit:
        headers["WARC-Refers-To"] = _name(row["refers_to"])
        headers["WARC-Profile"] = REVISIT_PROFILE
    head = "".join(f"{k}: {v}\r\n" for k, v in headers.items())
    return f"{VERSION}\r\n{head}\r\n".encode() + block + b"\r\n\r\n"


def _writer(root: str, revisit_bytes: int, file_bytes: int, level: int):
    """A task that writes rows sorted by shard and yields a manifest row per file. A row without
    payload says that the rows of the same page and digest, which follow it, are revisits."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(root)
        attempt = uuid.uuid4().hex
        done: list[dict] = []
        out, shard, file, temporary, size, records, digest = None, None, 0, "", 0, 0, hashlib.sha1()

        def close() -> None:
            nonlocal out
            out.close()
            out = None
            done.append({
                "shard": shard, "file": file, "name": f"shard-{shard:06d}-{file:04d}.warc.gz",
                "temporary": temporary, "records": records, "bytes": size, "sha1": digest.hexdigest(),
            })

        repeated, refers_to, before = None, None, None
        for batch in batches:
            for row in batch.to_pylist():
                same = (row["page_id"], row["payload_digest"])
                if row["payload"] is None:
                    repeated, refers_to = same, row["refers_to"]
                    continue
                row["refers_to"] = refers_to if same == repeated else None
                if same == before and row["payload_bytes"] >= revisit_bytes and row["refers_to"] is None:
                    row["refers_to"] = row["page_id"]
                before = same
                if out is not None and (row["shard"] != shard or size >= file_bytes):
                    close()
                    file = file + 1 if row["shard"] == shard else 0
                if out is None:
                    shard = row["shard"]
                    temporary = f"_temporary/{attempt}-{shard:06d}-{file:04d}"
                    store.create_dir(f"{base}/_temporary", recursive=True)
                    out = store.open_output_stream(f"{base}/{temporary}", compression=None)
                    size, records, digest = 0, 0, hashlib.sha1()
                packer = zlib.compressobj(level, wbits=31)
                member = packer.compress(_record(row)) + packer.flush()
                out.write(member)
                digest.update(member)
                size, records = size + len(member), records + 1
            if done:
                yield pa.RecordBatch.from_pylist(done, SCHEMA)
                done = []
        if out is not None:
            close()
            yield pa.RecordBatch.from_pylist(done, SCHEMA)

    return write


SCHEMA = pa.schema([
    ("shard", pa.int64()), ("file", pa.int32()), ("name", pa.string()), ("temporary", pa.string()),
    ("records", pa.int64()), ("bytes", pa.int64()), ("sha1", pa.string()),
])
READ_SCHEMA = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
    ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
    ("verified", pa.bool_()),
])


def _commit(root: str):
    """A task that moves listed files to their names; one that is moved already stays."""

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(root)
        for batch in batches:
            for row in batch.to_pylist():
                waiting = store.get_file_info(f"{base}/{row['temporary']}")
                if waiting.type != fs.FileType.NotFound:
                    store.move(f"{base}/{row['temporary']}", f"{base}/{row['name']}")
                elif store.get_file_info(f"{base}/{row['name']}").type == fs.FileType.NotFound:
                    raise FileNotFoundError(f"{row['temporary']} of the manifest is missing")
            yield batch

    return move


def write_archives(
    pages: DataFrame,
    root: str,
    revisit_bytes: int = REVISIT_BYTES,
    file_bytes: int = FILE_BYTES,
    shard_rows: int = SHARD_ROWS,
    level: int = LEVEL,
) -> DataFrame:
    """Write a record per row of ``pages`` below ``root``; returns the manifest, which is also kept as
    the table ``root/manifest``.

    Null html is an empty payload, null urls leave their header out, a null ``page_id`` is written as
    such and never referred to. Of repeated rows the first one is the response. Other columns are
    ignored.
    """
    spark = pages.sparkSession
    rows = _identified(pages)
    digests = _digests(rows.select("page_id", "payload_digest", "payload_bytes"))
    starts = shard_starts(digests, shard_rows)

    @F.pandas_udf("int")
    def shard_of(page: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(starts, page.to_numpy(np.int64), side="right").astype(np.int32))

    leading = revisits(digests, revisit_bytes).select(
        "page_id", F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload"),
        F.lit(0).cast("long").alias("payload_bytes"), "payload_digest", "refers_to",
    )
    everything = rows.withColumn("refers_to", F.lit(None).cast("long")).unionByName(leading)
    page = F.coalesce(F.col("page_id").cast("long"), F.lit(NO_PAGE))
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sorted_rows = (
        everything.withColumn("shard", shard_of(page))
        .repartition(width, "shard")
        .withColumn("_content", F.col("payload").isNotNull())
        .sortWithinPartitions("shard", "page_id", "payload_digest", "_content", "url")
        .drop("_content")
    )
    manifest = stored(sorted_rows.mapInArrow(_writer(root, revisit_bytes, file_bytes, level), MANIFEST), "warc-files")
    committed = manifest.mapInArrow(_commit(root), MANIFEST).drop("temporary")
    committed.write.mode("overwrite").parquet(f"{root}/manifest")
    return spark.read.parquet(f"{root}/manifest")


def _headers(stream: io.BufferedIOBase) -> dict[str, str]:
    found = {}
    while (line := stream.readline()) not in (b"\r\n", b""):
        key, _, value = line.decode().rstrip("\r\n").partition(": ")
        found[key] = value
    return found


def _page(name: str) -> int | None:
    number = name[len("<urn:x-page:"):-1]
    return None if number == "null" else int(number)


def _records(stream: io.BufferedIOBase) -> Iterator[dict]:
    while line := stream.readline():
        if line.strip() != VERSION.encode():
            raise ValueError(f"not the start of a record: {line[:40]!r}")
        headers = _headers(stream)
        block = stream.read(int(headers["Content-Length"]))
        stream.read(4)
        head = io.BytesIO(block)
        head.readline()
        http = _headers(head)
        payload = block[head.tell():]
        label = headers["WARC-Payload-Digest"]
        revisit = headers["WARC-Type"] == "revisit"
        yield {
            "page_id": _page(headers["WARC-Record-ID"]),
            "url": headers.get("WARC-Target-URI"),
            "payload_bytes": int(http["Content-Length"]) if revisit else len(payload),
            "payload_digest": base64.b32decode(label.removeprefix("sha1:")).hex(),
            "record_type": headers["WARC-Type"],
            "refers_to": _page(headers["WARC-Refers-To"]) if revisit else None,
            "verified": _digest(block) == headers["WARC-Block-Digest"]
            and (revisit or _digest(payload) == label),
        }


def _reader(root: str, batch_rows: int = 2_000):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(root)
        for batch in batches:
            for name in batch.column("name").to_pylist():
                rows = []
                with store.open_input_stream(f"{base}/{name}", compression=None) as raw:
                    with gzip.GzipFile(fileobj=io.BufferedReader(raw, 1 << 20)) as packed:
                        for record in _records(io.BufferedReader(packed, 1 << 20)):
                            rows.append(record)
                            if len(rows) == batch_rows:
                                yield pa.RecordBatch.from_pylist(rows, READ_SCHEMA)
                                rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, READ_SCHEMA)

    return read


def read_archives(spark: SparkSession, root: str) -> DataFrame:
    """The records of all files in the manifest, each checked against its digests."""
    names = spark.read.parquet(f"{root}/manifest").select("name")
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = names.repartition(width, "name").mapInArrow(_reader(root), READ)
    wrong = F.raise_error(F.concat(F.lit("damaged record of page "), F.col("page_id").cast("string")))
    return rows.filter(F.when(F.col("verified"), True).otherwise(wrong)).drop("verified")


def round_trip(pages: DataFrame, **options) -> DataFrame:
    """Write ``pages`` to a folder of its own and read the records back."""
    root = scratch_path(pages.sparkSession, "warc")
    write_archives(pages, root, **options)
    return read_archives(pages.sparkSession, root)
