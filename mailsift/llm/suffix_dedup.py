"""Removal of repeated substrings with suffix arrays.

A byte is removed if a string of ``LENGTH`` bytes that covers it starts anywhere else, in the same or
another document. Suffix arrays of the whole corpus would have to be sorted in one piece, so documents
are first cut where equal strings are cut alike:

* Every window of LENGTH bytes has an anchor: the GRAM-byte string in it with the least hash, the last
  one of several. Equal windows have equal anchors at equal places. Consecutive windows with one
  anchor form a stretch, and documents are exactly covered by the windows of their stretches.
* Stretches whose anchor occurs once hold no repeated window. A filter of a fixed number of bits drops
  most of them early.
* Equal stretches (same anchor, place and bytes) repeat all their windows: counted, not gathered.
* What is left are stretches of their own with an anchor that others have too: the borders of matches.
  Only their bytes are fetched. Anchors are dealt to shards, so two equal windows are in one shard; its
  suffix array is made by induced sorting, and permuted common prefixes of LENGTH or more mark the
  windows that start elsewhere.
* An anchor with very many different stretches (the border of a passage that a large part of all
  documents has) would be too much for a shard. Ranges of its windows are hashed and counted instead,
  and halved until they are all repeated or not.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from mailsift.llm.suffix_array import permuted_common_prefixes, suffix_array
from mailsift.session import stored

LENGTH = 200
GRAM = 32
FILTER_BITS = 26
# Different stretches of one anchor beyond which ranges of windows are counted.
HOT_STRETCHES = 2_048
# Bytes of a shard's suffix array.
SHARD_BYTES = 1 << 20

SEED = 2
_TABLE = np.random.default_rng(SEED).integers(0, 1 << 64, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    return np.cumprod(np.append(np.uint64(1), np.full(max(n - 1, 0), base)), dtype=np.uint64)[:n]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


class Hashes:
    """Hashes of all substrings of some bytes, from running sums of weighted bytes."""

    def __init__(self, data: np.ndarray) -> None:
        n = len(data)
        self.inverse = _powers(_INVERSE, n + 1)
        weighted = _TABLE[data] * _powers(_BASE, n)
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum(weighted, dtype=np.uint64)])

    def of(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Of the bytes from ``first`` up to ``last``."""
        return _mixed((self.sums[last] - self.sums[first]) * self.inverse[first])

    def grams(self, size: int) -> np.ndarray:
        n = len(self.sums) - size
        return _mixed((self.sums[size:] - self.sums[:n]) * self.inverse[:n])


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values, by doubling."""
    reach = 1
    while reach < width:
        step = min(reach, width - reach)
        values = np.minimum(values[:-step], values[step:])
        reach += step
    return values


def stretches(data: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(first window, last window, place of the anchor after the first window's start, anchor hash,
    content hash) of the stretches of one text."""
    empty = np.zeros(0, np.int64)
    if len(data) < length:
        return empty, empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
    hashes = Hashes(data)
    grams = hashes.grams(gram)
    # The upper half decides, the place breaks ties in favour of the last.
    n = len(grams)
    ranked = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(n - 1, -1, -1, dtype=np.uint64)
    anchor = n - 1 - (sliding_min(ranked, length - gram + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
    last = np.append(first[1:], len(anchor)) - 1
    at = anchor[first]
    place = at - first
    content = hashes.of(first, last + length)
    content = _mixed(content + place.astype(np.uint64) * np.uint64(0xD1342543DE82EF95) + (last - first).astype(np.uint64))
    return first, last, place, grams[at], content


def _signed(a: np.ndarray) -> np.ndarray:
    return a.view(np.int64)


def stretch_table(documents: DataFrame, length: int) -> DataFrame:
    """(doc_id, text_key, n_bytes, sha256, first, last, place, anchor, content): one row per document, the
    stretches as arrays."""
    kind = documents.schema["doc_id"].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: dict[str, list] = {"n_bytes": [], "sha256": [], "first": [], "last": [], "place": [], "anchor": [],
                                     "content": []}
            for value in batch.column("data"):
                text = value.as_py()
                first, last, place, anchor, content = stretches(np.frombuffer(text, np.uint8), length)
                rows["n_bytes"].append(len(text))
                rows["sha256"].append(hashlib.sha256(text).hexdigest())
                rows["first"].append(first.astype(np.int32))
                rows["last"].append(last.astype(np.int32))
                rows["place"].append(place.astype(np.int32))
                rows["anchor"].append(_signed(anchor))
                rows["content"].append(_signed(content))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(rows["n_bytes"], pa.int64()),
                 pa.array(rows["sha256"]), *[pa.array(rows[c], pa.list_(pa.int32())) for c in ("first", "last", "place")],
                 *[pa.array(rows[c], pa.list_(pa.int64())) for c in ("anchor", "content")]],
                names=["doc_id", "text_key", *rows],
            )

    schema = (
        f"doc_id {kind}, text_key long, n_bytes long, sha256 string, first array<int>, last array<int>, "
        "place array<int>, anchor array<long>, content array<long>"
    )
    return stored(_keyed(documents).mapInArrow(read, schema), "stretches")


def _keyed(documents: DataFrame) -> DataFrame:
    """``doc_id``, a hash of the text that tells rows of one id apart, and the text as bytes."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return documents.select("doc_id", F.xxhash64(text).alias("text_key"), text.cast("binary").alias("data"))


def _bit_filter(keys: DataFrame) -> np.ndarray:
    """A bit for the top FILTER_BITS bits of each ``key``: at most 2 ** (FILTER_BITS - 6) rows reach
    the driver."""
    word = F.shiftrightunsigned("key", 64 - FILTER_BITS + 6)
    bit = F.call_function(
        "shiftleft", F.lit(1).cast("long"),
        F.shiftrightunsigned("key", 64 - FILTER_BITS).bitwiseAND(F.lit(63)).cast("int"),
    )
    words = keys.groupBy(word.alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    found = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    found[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return found.view(np.uint64)


def _passes(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    top = keys.view(np.uint64) >> np.uint64(64 - FILTER_BITS)
    return (bits[(top >> np.uint64(6)).astype(np.int64)] >> (top & np.uint64(63))) & np.uint64(1) == 1


def occurrences(table: DataFrame) -> DataFrame:
    """(doc_id, text_key, first, last, place, anchor, content) of the stretches whose anchor may be repeated."""
    anchors = table.select(F.explode("anchor").alias("key"))
    repeated = anchors.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > 1)
    bits = table.sparkSession.sparkContext.broadcast(_bit_filter(repeated))
    kind = table.schema["doc_id"].dataType.simpleString()

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {c: batch.column(c).flatten() for c in ("first", "last", "place", "anchor", "content")}
            rows = batch.column("anchor").value_lengths().to_numpy()
            good = np.flatnonzero(_passes(bits.value, columns["anchor"].to_numpy()))
            of = pa.array(np.repeat(np.arange(batch.num_rows), rows)[good])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(of), batch.column("text_key").take(of),
                 *[c.take(pa.array(good)) for c in columns.values()]],
                names=["doc_id", "text_key", *columns],
            )

    schema = f"doc_id {kind}, text_key long, first int, last int, place int, anchor long, content long"
    columns = table.select("doc_id", "text_key", "first", "last", "place", "anchor", "content")
    return stored(columns.mapInArrow(kept, schema), "stretch-occurrences")


def _texts_of(documents: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """``wanted`` stretches (doc_id, text_key, first, last, anchor, content, …) with their bytes."""
    carried = [c for c in wanted.columns if c not in ("doc_id", "text_key")]
    by_row = wanted.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct(*carried)).alias("wanted"))
    by_row = stored(by_row.withColumnsRenamed({"doc_id": "_id", "text_key": "_key"}), "stretch-wanted")
    bits = documents.sparkSession.sparkContext.broadcast(_bit_filter(by_row.select(F.col("_key").alias("key"))))

    @F.pandas_udf("boolean")
    def asked(key: pd.Series) -> pd.Series:
        return pd.Series(_passes(bits.value, key.to_numpy(np.int64)))

    rows = _keyed(documents).filter(asked(F.col("text_key"))).dropDuplicates(["doc_id", "text_key"])
    met = rows.join(by_row, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key")))
    each = met.select("doc_id", "text_key", "data", F.explode("wanted").alias("w"))
    size = F.col("w.last") - F.col("w.first") + length
    return each.select(
        "doc_id", "text_key", *[F.col(f"w.{c}").alias(c) for c in carried],
        F.substring("data", F.col("w.first") + 1, size).alias("bytes"),
    )


def _starts_elsewhere(texts: list[bytes], length: int) -> np.ndarray:
    """For the concatenation of ``texts``, each closed by a sign of its own kind: whether the ``length``
    bytes from a position occur at another one."""
    symbols = np.concatenate([np.append(np.frombuffer(t, np.uint8).astype(np.int64) + 2, 1) for t in texts] + [[0]])
    left = np.concatenate([np.arange(len(t), -1, -1) for t in texts] + [[0]])
    before, common = permuted_common_prefixes(symbols, suffix_array(symbols), left)
    twice = common >= length
    twice[before[twice]] = True
    return twice


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last positions of the runs of True."""
    edges = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1) - 1


def shard_repeats(stretch_bytes: DataFrame, length: int) -> DataFrame:
    """(doc_id, text_key, first, last): ranges of window starts that a shard's suffix array finds again.
    All stretches of an anchor are in one shard."""
    kind = stretch_bytes.schema["doc_id"].dataType.simpleString()

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def shard(rows: list[dict]) -> Iterator[pa.RecordBatch]:
            texts = [r["bytes"] for r in rows]
            twice = _starts_elsewhere(texts, length)
            found: dict[str, list] = {"doc_id": [], "text_key": [], "first": [], "last": []}
            at = 0
            for r, t in zip(rows, texts):
                for a, b in zip(*_runs(twice[at : at + len(t) - length + 1])):
                    found["doc_id"].append(r["doc_id"])
                    found["text_key"].append(r["text_key"])
                    found["first"].append(r["first"] + int(a))
                    found["last"].append(r["first"] + int(b))
                at += len(t) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(found["doc_id"], types[0]), pa.array(found["text_key"], pa.int64()),
                 pa.array(found["first"], pa.int32()), pa.array(found["last"], pa.int32())],
                names=list(found),
            )

        rows: list[dict] = []
        size, types = 0, [pa.null()]
        for batch in batches:
            types[0] = batch.schema.field("doc_id").type
            for row in batch.to_pylist():
                if size >= SHARD_BYTES and row["anchor"] != rows[-1]["anchor"]:
                    yield from shard(rows)
                    rows, size = [], 0
                rows.append(row)
                size += len(row["bytes"])
        if rows:
            yield from shard(rows)

    width = int(stretch_bytes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_rows = stretch_bytes.repartition(width, "anchor").sortWithinPartitions("anchor", "content")
    return sorted_rows.mapInArrow(search, f"doc_id {kind}, text_key long, first int, last int")


def hot_repeats(stretch_bytes: DataFrame, length: int) -> DataFrame:
    """(doc_id, text_key, first, last) of repeated windows of anchors with very many stretches.

    Windows are told apart by how far the anchor is from their start. The distances of a stretch are
    halved again and again. Two stretches can only share a window of a range of distances if the bytes
    that all its windows have in common are equal, so a stretch alone with these bytes is done; and
    where all bytes of the range are equal to those of another stretch, the whole range is repeated.
    Both are counts of hashes, and a stretch has a few rows in each of eight rounds.
    """
    kind = stretch_bytes.schema["doc_id"].dataType.simpleString()
    columns = f"doc_id {kind}, text_key long, first int, last int, place int, anchor long, bytes binary"
    span = F.col("last") - F.col("first")
    # The distances that a stretch has: place - span to place.
    state = stretch_bytes.select(
        "doc_id", "text_key", "first", "last", "place", "anchor", "bytes",
        F.lit(0).alias("low"), F.lit(length - GRAM).alias("high"),
    )

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            core, whole = [], []
            for row in batch.to_pylist():
                hashes = Hashes(np.frombuffer(row["bytes"], np.uint8))
                low = max(row["low"], row["place"] - row["last"] + row["first"])
                high = min(row["high"], row["place"])
                ranges = ((row["place"] - row["low"], row["place"] - row["high"]), (row["place"] - high, row["place"] - low))
                first, last = (np.array(x) for x in zip(*ranges))
                both = hashes.of(first, last + length)
                core.append(both[0])
                whole.append(_mixed(both[1:] + np.uint64(low << 16 | high))[0])
            yield batch.append_column("core", pa.array(_signed(np.array(core, np.uint64)))).append_column(
                "whole", pa.array(_signed(np.array(whole, np.uint64)))
            )

    found = []
    while True:
        rows = stored(state.mapInArrow(hashed, f"{columns}, low int, high int, core long, whole long"), "hot-ranges")
        if rows.isEmpty():
            break

        def repeated(key: str, rows: DataFrame = rows) -> DataFrame:
            one = F.min(F.struct("doc_id", "text_key", "first")).alias("one")
            counts = rows.groupBy("anchor", "low", "high", key).agg(F.count("*").alias("n"), one)
            return counts.filter(F.col("n") > 1).drop("n")

        met = rows.join(repeated("core").drop("one"), ["anchor", "low", "high", "core"])
        met = stored(met.join(repeated("whole"), ["anchor", "low", "high", "whole"], "left"), "hot-met")
        done = F.col("one").isNotNull()
        # One of equal rows goes on, for others to find its windows.
        again = ~done | F.col("one").eqNullSafe(F.struct("doc_id", "text_key", "first"))
        found.append(
            met.filter(done).select(
                "doc_id", "text_key",
                (F.col("first") + F.col("place") - F.least("high", "place")).alias("first"),
                (F.col("first") + F.col("place") - F.greatest("low", F.col("place") - span)).alias("last"),
            )
        )
        middle = F.floor((F.col("low") + F.col("high")) / 2).cast("int")
        halves = F.array(
            F.struct(F.col("low").alias("low"), middle.alias("high")),
            F.struct((middle + 1).alias("low"), F.col("high").alias("high")),
        )
        split = met.filter(again & (F.col("low") < F.col("high"))).select(
            "doc_id", "text_key", "first", "last", "place", "anchor", "bytes", F.inline(halves)
        )
        # Halves in which the stretch has no window are left out.
        state = split.filter((F.col("low") <= F.col("place")) & (F.col("high") >= F.col("place") - span))
    none = stretch_bytes.filter(F.lit(False)).select("doc_id", "text_key", "first", "last")
    return reduce(DataFrame.unionByName, found, none)


def repeated_ranges(documents: DataFrame, table: DataFrame, length: int) -> DataFrame:
    """(doc_id, text_key, first, last): ranges of window starts whose string starts elsewhere too."""
    found = occurrences(table)
    kinds = found.groupBy("anchor", "content").agg(
        F.count("*").alias("n"), F.min(F.struct("doc_id", "text_key", "first", "last", "place")).alias("one")
    )
    kinds = stored(kinds, "stretch-kinds")
    # Per anchor: different stretches, and how many of them occur once. Rows are one per kind, and an
    # anchor's kinds are added up before they move.
    anchors = kinds.groupBy("anchor").agg(
        F.count("*").alias("n_kinds"), F.sum((F.col("n") == 1).cast("long")).alias("n_single")
    )
    contested = anchors.filter((F.col("n_kinds") > 1) & (F.col("n_single") > 0)).select("anchor", "n_kinds")
    wanted = kinds.join(contested, "anchor").select(
        "one.doc_id", "one.text_key", "one.first", "one.last", "one.place", "anchor", "content", "n", "n_kinds"
    )
    texts = stored(_texts_of(documents, wanted, length), "stretch-texts")
    hot = F.col("n_kinds") > HOT_STRETCHES
    borders = shard_repeats(texts.filter(~hot).drop("n", "n_kinds"), length).unionByName(
        hot_repeats(texts.filter(hot), length)
    )
    copies = kinds.filter(F.col("n") > 1).select("anchor", "content")
    whole = found.join(copies, ["anchor", "content"]).select("doc_id", "text_key", "first", "last")
    return whole.unionByName(borders)


def remove_repeats(documents: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) for every row of ``documents``.

    ``kept`` is the text's UTF-8 bytes without those covered by a string of ``length`` bytes that also
    starts elsewhere; it is null where nothing was removed. A null text is empty. Repeated rows are
    documents of their own and repeat each other; a null ``doc_id`` is an id like any other.
    """
    if length <= GRAM:
        raise ValueError(f"strings must be longer than {GRAM} bytes")
    table = stretch_table(documents, length)
    ranges = repeated_ranges(documents, table, length)
    by_row = ranges.groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("first", "last")).alias("ranges"))
    by_row = stored(by_row.withColumnsRenamed({"doc_id": "_id", "text_key": "_key"}), "repeat-ranges")
    bits = documents.sparkSession.sparkContext.broadcast(_bit_filter(by_row.select(F.col("_key").alias("key"))))
    kind = documents.schema["doc_id"].dataType.simpleString()

    @F.pandas_udf("boolean")
    def touched(key: pd.Series) -> pd.Series:
        return pd.Series(_passes(bits.value, key.to_numpy(np.int64)))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                data = np.frombuffer(row["data"], np.uint8)
                edges = np.zeros(len(data) + 1, np.int32)
                first = np.array([r["first"] for r in row["ranges"]], np.int64)
                last = np.array([r["last"] for r in row["ranges"]], np.int64)
                np.add.at(edges, first, 1)
                np.add.at(edges, last + length, -1)
                gone = np.cumsum(edges[:-1]) > 0
                kept = data[~gone].tobytes()
                rows.append({
                    "_id": row["doc_id"], "_key": row["text_key"], "n_removed": int(gone.sum()),
                    "n_spans": len(_runs(gone)[0]), "kept_sha256": hashlib.sha256(kept).hexdigest(), "kept": kept,
                })
            yield pa.RecordBatch.from_pylist(rows, pa.schema([
                ("_id", batch.schema.field("doc_id").type), ("_key", pa.int64()), ("n_removed", pa.int64()),
                ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary()),
            ]))

    rows = _keyed(documents).filter(touched(F.col("text_key"))).dropDuplicates(["doc_id", "text_key"])
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key"))
    changed = rows.join(by_row, same).select("doc_id", "text_key", "data", "ranges").mapInArrow(
        cut, f"_id {kind}, _key long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    )
    zero = F.lit(0).cast("long")
    return table.join(changed, same, "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"),
        F.coalesce("n_spans", zero).alias("n_spans"),
        F.coalesce("kept_sha256", "sha256").alias("kept_sha256"), "kept",
    )
