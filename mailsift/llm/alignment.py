"""Alignment of two tokenizers over the same texts.

Tokenizer A is a byte-level BPE, tokenizer B a BPE of pieces with byte fallback. Both see a space and the text. Where
tokens of both end at the same byte, the text is cut into groups: the hash set of the ends of one side is
intersected with those of the other, the common ends, sorted, slice both lists of ids, and each slice gives the link
of the tokens that end with it.

Neither tokenizer joins what stands before and after a break (white space that follows anything else), as long as
no piece of B holds one inside, which is checked when it is loaded. Texts are therefore cut at breaks, and what is
found for a stretch is kept for its next occurrence: tokens, groups and links of a text are those of its
stretches.

A pair's count runs over the corpus. Most links belong to few pairs: of these (``HOT``, a fixed number) every task
gets the counts; links of other pairs, none of which can be frequent, meet them in a shuffle.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import chain, compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from mailsift.session import stored

TOKENIZER_A = "/opt/tokenizers/byte_bpe_50k.json"
TOKENIZER_B = "/opt/tokenizers/piece_bpe_32k.model"

SPACE = "▁"
BREAKS = " \t\n\x0b\x0c\r"
# Pairs whose counts are sent to every task: 17 bytes each.
HOT = 1 << 18
# Stretches a worker keeps, the longest one, characters it works on at once, and links it adds up before it passes
# them on. None of them changes a result.
KEPT, LONGEST = 1 << 19, 200
SLICE = 1 << 21
SUMMED = 1 << 22
# A pair's key: A's id above these bits, B's below.
B_BITS = 32


def aligned(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where groups end: the ends that tokens of both sides share, and how many tokens of A and of B end up to each."""
    ends = np.array(sorted(set(a_ends.tolist()).intersection(b_ends.tolist())), np.int64)
    return ends, np.searchsorted(a_ends, ends, side="right"), np.searchsorted(b_ends, ends, side="right")


def joined(parts: pa.Array, upto: np.ndarray, by: str) -> pa.Array:
    """Strings put together: the parts up to the first of ``upto``, those from there up to the second, and so on."""
    offsets = pa.array(np.concatenate([[0], upto]), pa.int32())
    return pc.binary_join(pa.ListArray.from_arrays(offsets, parts), pa.scalar(by, pa.large_string()))


class Known(dict):
    """The number of each stretch met so far. One that is looked up for the first time gets the next number, and is
    ``new`` until it is learnt."""

    def __init__(self):
        self.new: list[str] = []
        self.next = 0

    def __missing__(self, stretch: str) -> int:
        number = self[stretch] = self.next
        self.next += 1
        self.new.append(stretch)
        return number


class Pair:
    """Both tokenizers, and what is known of the stretches met so far."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks are what runs side by side
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        with open(path_a, encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        letters = byte_letters()
        self.a_bytes = {
            i: bytes(letters[c] for c in entry) for entry, i in vocabulary.items() if set(entry) <= letters.keys()
        }
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in pieces):
            raise ValueError("a piece holds a space after other characters, so texts cannot be cut there")
        self.b_bytes = [
            bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.a_lengths = np.array([len(self.a_bytes.get(i, b"")) for i in range(max(self.a_bytes) + 1)])
        self.b_lengths = np.array([len(p) for p in self.b_bytes])
        alone = "".join(c for c in BREAKS if c == " " or not any(c in p for p in pieces))
        inner = f"[^\\S{alone}]"
        self.stretch = re.compile(rf"\s*+\S++(?:{inner}\s*+\S++)*+(?:{inner}\s*+\Z)?|\s++\Z")
        # What stands before a stretch, so that B adds no space of its own to it.
        self.before = "a"
        self.n_before = len(self.b.encode(self.before))
        self.forget()

    def forget(self) -> None:
        self.known = Known()
        self.texts: list[str] = []
        self.sizes = np.zeros((0, 4), np.int64)  # of each stretch: tokens of A and B, groups, whether tokens spell it
        self.keys, self.starts = np.zeros(0, np.int64), np.zeros(1, np.int64)

    def learn(self, stretches: list[str]) -> None:
        """Groups and links of new stretches, by their numbers. Those that tokens do not spell have none."""
        a_all = [e.ids for e in self.a.encode_batch_fast(stretches, add_special_tokens=False)]
        b_all = self.b.encode([self.before + s for s in stretches], num_threads=1)
        n_a, a = self.flat(a_all, 0)
        n_b, b = self.flat(b_all, self.n_before)
        good = np.ones(len(stretches), bool)
        if not self.spell(a, b, "".join(stretches)):
            each = zip(np.split(a, np.cumsum(n_a)), np.split(b, np.cumsum(n_b)), stretches, strict=False)
            good = np.array([self.spell(x, y, s) for x, y, s in each], bool)
            a, b = a[np.repeat(good, n_a)], b[np.repeat(good, n_b)]
        # New stretches are aligned together, one behind the other: each of their ends is common to both sides.
        ends, to_a, to_b = aligned(np.cumsum(self.a_lengths[a]), np.cumsum(self.b_lengths[b]))
        last = np.cumsum(np.fromiter(map(len, map(str.encode, stretches)), np.int64, len(stretches)))
        if not good.all():
            last = np.cumsum(np.diff(last, prepend=0) * good)
        upto = np.searchsorted(ends, last, side="right")
        said = [joined(pa.array(v).cast(pa.large_string()), to, ",") for v, to in ((a, to_a), (b, to_b))]
        texts = joined(pc.binary_join_element_wise(*said, pa.scalar("|", pa.large_string())), upto, ";")
        sizes = np.column_stack([n_a, n_b, np.diff(upto, prepend=0), np.ones(len(stretches), np.int64)])
        # A link for each group: a token has a byte at least, so of each side only the group's last one ends with it.
        keys = (a[to_a - 1] << B_BITS) | b[to_b - 1]
        self.texts.extend(texts.to_numpy(zero_copy_only=False).tolist())
        self.sizes = np.concatenate([self.sizes, sizes * good[:, None]])
        self.keys = np.concatenate([self.keys, keys])
        self.starts = np.concatenate([self.starts, self.starts[-1] + upto])

    def spell(self, a: np.ndarray, b: np.ndarray, text: str) -> bool:
        """Whether the tokens of both sides are the bytes of ``text``."""
        whole = text.encode()
        return all(
            b"".join(map(names.__getitem__, ids.tolist())) == whole
            for ids, names in ((a, self.a_bytes), (b, self.b_bytes))
        )

    def flat(self, every: list[list[int]], skipped: int) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each stretch has behind the first ``skipped``, and these in a row."""
        sizes = np.fromiter(map(len, every), np.int64, len(every))
        ids = np.fromiter(chain.from_iterable(every), np.int64, sizes.sum())
        place = np.arange(len(ids)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        return np.maximum(sizes - skipped, 0), ids[place >= skipped]

    def rows(self, texts: list[str | None]) -> Iterator[tuple[int, int, int, str, np.ndarray, np.ndarray]]:
        """(n_a, n_b, n_groups, groups_sha256, keys of the distinct links, their numbers) of each whole text."""
        if len(self.texts) > KEPT:
            self.forget()
        number = self.known.__getitem__
        cut = [list(map(number, self.stretch.findall(" " + t))) if t else [] for t in texts]
        if new := self.known.new:
            self.learn(new)
            for stretch in compress(new, (np.fromiter(map(len, new), np.int64, len(new)) > LONGEST).tolist()):
                del self.known[stretch]
            self.known.new = []
        said, sizes, starts, keys = self.texts, self.sizes, self.starts, self.keys
        for ids in cut:
            kinds, times = np.unique(np.array(ids, np.int64), return_counts=True)
            if not len(ids) or not sizes[kinds, 3].all():
                yield 0, 0, 0, "", keys[:0], keys[:0]
                continue
            n_a, n_b, n_groups, _ = times @ sizes[kinds]
            digest = hashlib.sha256(";".join([said[i] for i in ids]).encode()).hexdigest()
            lengths = starts[kinds + 1] - starts[kinds]
            at = np.repeat(starts[kinds] - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())
            distinct, which = np.unique(keys[at], return_inverse=True)
            numbers = np.bincount(which, np.repeat(times, lengths), len(distinct)).astype(np.int64)
            yield int(n_a), int(n_b), int(n_groups), digest, distinct, numbers


def byte_letters() -> dict[str, int]:
    """The letters by which a byte-level vocabulary writes bytes: printable ones themselves, others from 256 on."""
    printable = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def slices(texts: list[str | None]) -> Iterator[list[str | None]]:
    """Neighbouring texts of about ``SLICE`` characters together."""
    part, size = [], 0
    for text in texts:
        part.append(text)
        size += len(text or "")
        if size >= SLICE:
            yield part
            part, size = [], 0
    yield part


@functools.cache
def pair(path_a: str, path_b: str) -> Pair:
    """One for each worker."""
    return Pair(path_a, path_b)


def encoded_texts(documents: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, groups_sha256, keys, numbers) for every row."""

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = pair(path_a, path_b)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            rows = [row for part in slices(texts) for row in both.rows(part)]
            long = [pa.array([r[i] for r in rows], pa.int64()) for i in range(3)]
            lists = [pa.array([r[i] for r in rows], pa.list_(pa.int64())) for i in (4, 5)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *long, pa.array([r[3] for r in rows], pa.string()), *lists],
                names=["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "keys", "numbers"],
            )

    kind = documents.schema["doc_id"].dataType.simpleString()
    kinds = f"doc_id {kind}, n_a long, n_b long, n_groups long, groups_sha256 string, keys array<long>"
    return documents.select("doc_id", "text").mapInArrow(encoded, f"{kinds}, numbers array<long>")


def flat(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False)


def pair_counts(texts: DataFrame) -> DataFrame:
    """(key, n, best): how many links hold each pair, and whether no pair of its B id has more."""

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def summed() -> pa.RecordBatch:
            keys, which = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
            numbers = np.bincount(which, np.concatenate([n for _, n in held]), len(keys)).astype(np.int64)
            held[:] = [(keys, numbers)]
            return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(numbers)], names=["key", "n"])

        for batch in batches:
            held.append((flat(batch.column("keys")), flat(batch.column("numbers"))))
            size += len(held[-1][0])
            if size > SUMMED:
                whole, size = summed(), len(held[0][0])
                if size > SUMMED // 2:
                    yield whole
                    held, size = [], 0
        if held:
            yield summed()

    sums = texts.select("keys", "numbers").mapInArrow(added, "key long, n long")
    counts = stored(sums.groupBy("key").agg(F.sum("n").alias("n")), "pair-counts")
    b = F.col("key").bitwiseAND(F.lit((1 << B_BITS) - 1))
    most = counts.groupBy(b.alias("b")).agg(F.max("n").alias("most"))
    marked = counts.withColumn("b", b).join(most, "b")
    return stored(marked.select("key", "n", (F.col("n") == F.col("most")).alias("best")), "pair-counts")


def frequent(counts: DataFrame, bound: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``bound`` most frequent pairs, by key."""
    rows = counts.orderBy(F.desc("n"), "key").limit(bound).toArrow()
    keys, n, best = (rows.column(c).to_numpy() for c in ("key", "n", "best"))
    order = np.argsort(keys)
    return keys[order], n[order], best[order].astype(np.int64)


def align(
    documents: DataFrame, path_a: str = TOKENIZER_A, path_b: str = TOKENIZER_B, hot: int = HOT
) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) for every row of ``documents``.

    ``n_best`` counts the links whose pair is as frequent as any of its B id, ``count_sum`` adds up their pairs'
    counts. Null and empty texts, and texts that the tokens of one side do not spell, have no tokens: zeros and ''.
    Rows may be repeated and ids null; each counts. Further columns do not count. An empty table has no rows.
    ``hot`` is the number of pairs whose counts are sent to every task; it changes no result.
    """
    texts = encoded_texts(documents, path_a, path_b).withColumn("row", F.monotonically_increasing_id())
    texts = stored(texts, "aligned-texts")
    counts = pair_counts(texts)
    known, known_n, known_best = frequent(counts, hot)

    def looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, numbers = flat(batch.column("keys")), flat(batch.column("numbers"))
            sizes = batch.column("keys").value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            of = np.repeat(np.arange(batch.num_rows), sizes)
            at = np.minimum(np.searchsorted(known, keys), max(len(known) - 1, 0))
            hit = known[at] == keys if len(known) else np.zeros(len(keys), bool)
            at, mine, times = at[hit], of[hit], numbers[hit]
            exact = np.zeros((2, batch.num_rows), np.int64)
            np.add.at(exact[0], mine, known_best[at] * times)
            np.add.at(exact[1], mine, known_n[at] * times)
            rest = np.flatnonzero(~hit)
            ends = np.searchsorted(of[rest], np.arange(batch.num_rows + 1))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(v[rest])) for v in (keys, numbers)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(exact[0]), pa.array(exact[1]), *lists],
                names=["row", "n_best", "count_sum", "keys", "numbers"],
            )

    kinds = "row long, n_best long, count_sum long, keys array<long>, numbers array<long>"
    found = stored(texts.select("row", "keys", "numbers").mapInArrow(looked_up, kinds), "aligned-counts")
    rest = found.select("row", F.explode(F.arrays_zip("keys", "numbers")).alias("link"))
    rest = rest.select("row", F.col("link.keys").alias("key"), F.col("link.numbers").alias("times")).join(counts, "key")
    parts = found.select("row", "n_best", "count_sum").union(
        rest.select("row", F.when(F.col("best"), F.col("times")).otherwise(0), F.col("times") * F.col("n"))
    )
    sums = parts.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return texts.join(sums, "row").select(
        "doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), "n_best", "count_sum", "groups_sha256"
    )
