"""Near-duplicates by SimHash.

A fingerprint has 64 bits; a bit is set if it is set in more than half of the XXH64 hashes of the
text's word shingles. Fingerprints within ``DISTANCE`` bits are linked.

Links are searched among distinct fingerprints by pigeonhole: split into DISTANCE + 2 blocks, a close
pair agrees in at least two of them, so each pair of blocks is a join key of half the fingerprint. In
a bucket of a few fingerprints all pairs are compared. A larger bucket is hot: there each fingerprint
also visits the values one bit away from it, and two fingerprints at distance 2 or less meet at one of
these. At most 65 fingerprints can meet at one value, so a group of any size makes a bounded number
of rows for each of its members. Both ways end with the Hamming distance itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from mailsift.llm.common import WORD_BREAKS, kept_rows, row_hash
from mailsift.llm.components import components
from mailsift.session import stored

BITS = 64
DISTANCE = 2
BLOCKS = DISTANCE + 2
SHINGLE_WORDS = 3
SEED = 42
# A bucket with more fingerprints than this searches by neighbouring values instead of by pairs.
PAIRED = 32
# Shingles hashed before their bits are added up.
SLICE = 1 << 14

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_OTHER_BREAKS = str.maketrans({c: " " for c in WORD_BREAKS})


def words_of(text: str) -> list[str]:
    return [w for w in text.translate(_OTHER_BREAKS).split(" ") if w]


def shingles_of(words: list[str], size: int) -> Iterator[str]:
    """Runs of ``size`` words, space-joined; a shorter text is one shingle, an empty one has none."""
    if len(words) < size:
        return iter([" ".join(words)] if words else [])
    return map(" ".join, zip(*[words[i:] for i in range(size)]))


def fingerprint(text: str, size: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """The fingerprint of one whole text, as a signed 64-bit number."""
    digest = xxhash.xxh64_intdigest
    hashes = [digest(s, seed) for s in shingles_of(words_of(text.translate(_LOWER)), size)]
    if not hashes:
        return 0
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), SLICE):
        part = np.array(hashes[at : at + SLICE], dtype="<u8")
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    packed = np.packbits(ones * 2 > len(hashes), bitorder="little")
    return int(packed.view("<i8")[0])


def with_fingerprints(documents: DataFrame, size: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, text_hash, row_hash, fp) for every row; a null text is an empty one, whose fingerprint is 0."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t.as_py() or "", size) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("doc_id", "text_hash", "row_hash")] + [pa.array(found, pa.int64())],
                names=["doc_id", "text_hash", "row_hash", "fp"],
            )

    kind = documents.schema["doc_id"].dataType.simpleString()
    rows = documents.select(
        "doc_id", "text", F.xxhash64("text").alias("text_hash"), row_hash(documents).alias("row_hash")
    )
    return rows.mapInArrow(hashed, f"doc_id {kind}, text_hash long, row_hash long, fp long")


def block_keys(fp: Column) -> Column:
    """One key for each choice of BLOCKS - DISTANCE blocks: which blocks, and their bits."""
    width = BITS // BLOCKS
    keys = []
    for n, chosen in enumerate(combinations(range(BLOCKS), BLOCKS - DISTANCE)):
        mask = sum(((1 << width) - 1) << (width * b) for b in chosen)
        signed = mask - (1 << 64) if mask >= 1 << 63 else mask
        keys.append(F.struct(F.lit(n).alias("choice"), fp.bitwiseAND(F.lit(signed)).alias("bits")))
    return F.array(*keys)


def links(fingerprints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(a, b): edges between distinct ``fp`` values at ``distance`` 2 or less, that connect exactly the
    values that are linked. In small buckets every link is a row; in hot ones values that meet at a
    neighbouring value are linked to the smallest of them if they are near it, and through it else.
    """
    if distance != DISTANCE:
        raise ValueError("blocks and neighbouring values are laid out for a distance of 2")
    keyed = fingerprints.select("fp", F.explode(block_keys(F.col("fp"))).alias("key"))
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > 1)
    placed = keyed.join(sizes, "key")
    small = placed.filter(F.col("n") <= PAIRED).select("key", "fp")
    other = small.select("key", F.col("fp").alias("other"))
    paired = small.join(other, "key").filter(F.col("fp") < F.col("other"))
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= DISTANCE
    paired = paired.filter(near).select(F.col("fp").alias("a"), F.col("other").alias("b"))

    hot = placed.filter(F.col("n") > PAIRED).select("fp").distinct()
    one = F.lit(1).cast("long")
    flips = F.transform(
        F.sequence(F.lit(0), F.lit(BITS - 1)), lambda i: F.col("fp").bitwiseXOR(F.call_function("shiftleft", one, i))
    )
    visits = hot.select("fp", F.explode(F.concat(F.array("fp"), flips)).alias("at"))
    # Who meets at a value is within one bit of it, so any two of them are within two bits.
    met = visits.groupBy("at").agg(F.collect_set("fp").alias("all"), F.min("fp").alias("a"))
    met = met.filter(F.size("all") > 1).select("a", F.explode("all").alias("b"))
    met = met.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= DISTANCE)
    return paired.union(met.filter(F.col("a") != F.col("b"))).distinct()


def grouped(documents: DataFrame) -> DataFrame:
    """(doc_id, text_hash, row_hash, fp, root, component_id) for every row; ``root`` is a fingerprint."""
    prints = stored(with_fingerprints(documents), "fingerprints")
    classes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprint-classes")
    linked = stored(components(links(classes)), "fingerprint-components").select(
        F.col("node").alias("fp"), "component_id"
    )
    named = classes.join(linked, "fp", "left").withColumn("root", F.coalesce("component_id", "fp"))
    smallest = named.groupBy("root").agg(F.min("least").alias("component"))
    named = named.join(smallest, "root").select("fp", "root", F.col("component").alias("component_id"))
    return prints.join(named, "fp")


def near_duplicates(documents: DataFrame) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``documents``.

    ``component_id`` is the smallest ``doc_id`` that links reach. Texts without words have fingerprint
    0 and are linked like any other. Repeated rows get a row each; a null ``doc_id`` is never a
    component's name unless all of it are null.
    """
    return grouped(documents).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each(documents: DataFrame) -> DataFrame:
    """``documents`` without near-duplicates: of each component of texts exactly one row, that with the
    smallest ``doc_id`` (a null one is the largest), then fingerprint and hash of the text."""
    return kept_rows(documents, grouped(documents).withColumn("mark", F.col("fp")))
