"""Language-model scoring by context-tree weighting over bytes.

A text is read as its words, each closed by a space, and an end: the bytes a model predicts. Every
byte is eight binary decisions, and a decision has a node for each depth d: the last d bytes and the
bits of the byte decided so far. A node estimates its next bit from its two counts (Krichevsky and
Trofimov). Weighting gives every node the probability that its own estimate, rather than the nodes of
longer contexts below it, is the right one for what it has seen:

    P_w = 1/2 P_e + 1/2 product of P_w over the children        P_w = P_e at the greatest depth

so a prediction mixes the estimates of all depths along a path. The counts of a trained model do not
change while texts are scored, and a path ends at the deepest node that training has seen.

Training counts strings of DEPTH + 1 bytes over all texts. The tree is built in parallel: one task has
whole subtrees below the last two bytes, and only sums per last byte, at most 256 * 255 of them, meet
on the driver for the top. The finished model is a table. It is sent to the tasks that score in blocks
of a checked size, and texts are scanned once for each block.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from mailsift.session import stored


DEPTH = 5
FOLDS = 7
HELD_OUT = 2
# Rows of the model (strings, nodes) in one block.
BLOCK_STRINGS = 1 << 21
BLOCK_NODES = 1 << 22
# Tokens whose counts every task knows; the others are looked up in a join.
COMMON_TOKENS = 1 << 19
# Bytes of text handled at a time.
SLICE = 1 << 20
# Distinct strings a task holds before it passes its counts on.
HELD = 1 << 20

END = b"\n"
LN10 = math.log(10.0)


# --- counting --------------------------------------------------------------------------------


def text_bytes() -> Column:
    return F.coalesce(F.col("text"), F.lit("")).cast("binary")


def crc_remainder(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text modulo ``folds``; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def token_key(word: bytes) -> int:
    """A 64-bit key of a word. Words have no white space, so the end has a key of its own."""
    return xxhash.xxh64_intdigest(word) - (1 << 63)


END_KEY = token_key(END)


def words_of(text: bytes) -> list[bytes]:
    """The words of a text, A-Z in lower case. Both methods know ASCII only: white space is 0x20 and
    0x09 to 0x0D."""
    return text.lower().split()


def stream_of(words: list[bytes]) -> bytes:
    """The bytes that are predicted: each word and a space, then the end."""
    return b" ".join(words) + b" " + END if words else END


def _texts(column: pa.Array) -> Iterator[bytes]:
    return (value.as_py() for value in column)


def _slices(texts: Iterator[bytes]) -> Iterator[tuple[int, list[list[bytes]], list[bytes]]]:
    """(first text, words of each, streams) of consecutive texts with about SLICE bytes."""
    first, size, words = 0, 0, []
    for i, text in enumerate(texts):
        words.append(words_of(text))
        size += len(text)
        if size >= SLICE:
            yield first, words, [stream_of(w) for w in words]
            first, size, words = i + 1, 0, []
    if words:
        yield first, words, [stream_of(w) for w in words]


def _pieces(streams: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(strings, text numbers): for each predicted byte the DEPTH bytes before it, the last one in the
    highest place, and the byte. Before its first byte a text has END bytes."""
    pad = END * DEPTH
    lengths = np.array([len(x) for x in streams], np.int64)
    data = np.frombuffer(b"".join(pad + x for x in streams), np.uint8)
    of = np.repeat(np.arange(len(streams)), lengths + DEPTH)
    runs = np.stack([np.full(len(streams), DEPTH), lengths], axis=1).reshape(-1)
    predicted = np.repeat(np.tile([False, True], len(streams)), runs)
    for start in range(DEPTH, len(data), SLICE):
        end = min(start + SLICE, len(data))
        strings = data[start:end].astype(np.int64)
        for back in range(1, DEPTH + 1):
            strings |= data[start - back : end - back].astype(np.int64) << (8 * (DEPTH + 1 - back))
        here = predicted[start:end]
        yield strings[here], of[start:end][here]


class _Counts:
    """Counts of keys, handed on when there are many of them."""

    def __init__(self) -> None:
        self.keys, self.n = [], []
        self.size = 0

    def add(self, keys: np.ndarray, n: np.ndarray) -> None:
        self.keys.append(keys)
        self.n.append(n)
        self.size += len(keys)
        if self.size > HELD + HELD // 2:
            self.merge()

    def merge(self) -> None:
        keys, n = np.concatenate(self.keys), np.concatenate(self.n)
        order = np.argsort(keys)
        keys, n = _grouped(keys[order], n[order])
        self.keys, self.n, self.size = [keys], [n], len(keys)

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.keys:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.merge()
        keys, n = self.keys[0], self.n[0]
        self.keys, self.n, self.size = [], [], 0
        return keys, n


def _coded(words: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct keys, code of each word, words per text)."""
    codes: dict[bytes, int] = {}
    found = [codes.setdefault(w, len(codes)) for text in words for w in text]
    keys = np.array([token_key(w) for w in codes], np.int64)
    return keys, np.array(found, np.int64), np.array([len(t) for t in words], np.int64)


def counts(documents: DataFrame) -> DataFrame:
    """(kind, key, n): how often each token (kind 0) and string (kind 1) occurs in ``documents``."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (_Counts(), _Counts())

        def flush(least: int) -> Iterator[pa.RecordBatch]:
            for kind, some in enumerate(kinds):
                if some.size > least:
                    keys, n = some.take()
                    for at in range(0, len(keys), 1 << 18):
                        part = keys[at : at + (1 << 18)]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(part), kind, np.int8)), pa.array(part),
                             pa.array(n[at : at + (1 << 18)])],
                            names=["kind", "key", "n"],
                        )

        for batch in batches:
            for _, words, streams in _slices(_texts(batch.column("data"))):
                found = Counter(chain.from_iterable(words))
                keys, n = [token_key(w) for w in found], [*found.values()]
                kinds[0].add(np.array([*keys, END_KEY], np.int64), np.array([*n, len(words)], np.int64))
                for strings, _ in _pieces(streams):
                    kinds[1].add(*np.unique(strings, return_counts=True))
                yield from flush(HELD)
        yield from flush(0)

    rows = documents.select(text_bytes().alias("data"))
    parts = rows.mapInArrow(counted, "kind byte, key long, n long")
    return parts.groupBy("kind", "key").agg(F.sum("n").alias("n"))


# --- the tree --------------------------------------------------------------------------------


def log_gamma_half(n: np.ndarray) -> np.ndarray:
    """ln Gamma(n + 1/2) of whole numbers."""
    return _log_gamma(n + 0.5)


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """ln Gamma(x), x > 0: Stirling's series after stepping small arguments up."""
    x = np.asarray(x, float).copy()
    shift = np.zeros_like(x)
    for _ in range(10):
        small = x < 10
        shift[small] += np.log(x[small])
        x[small] += 1
    series = 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5)
    return (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + series - shift


def log_estimate(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """ln P_e: what the Krichevsky-Trofimov estimator gives a sequence with these counts."""
    return log_gamma_half(n0) + log_gamma_half(n1) - _log_gamma(n0 + n1 + 1.0) - math.log(math.pi)


@dataclass
class Level:
    """The nodes of one depth in rising order of key: context * 256 + bits decided so far, with a
    leading one. ``below`` is ln of the product of P_w over the children, None at the greatest depth.
    """

    key: np.ndarray
    n0: np.ndarray
    n1: np.ndarray
    below: np.ndarray | None = None

    def __post_init__(self) -> None:
        self.log_e = log_estimate(self.n0, self.n1)
        self.kt = (self.n1 + 0.5) / (self.n0 + self.n1 + 1.0)
        if self.below is None:
            self.log_w, self.own = self.log_e, np.ones(len(self.key))
        else:
            half = math.log(0.5)
            self.log_w = np.logaddexp(half + self.log_e, half + self.below)
            self.own = np.exp(half + self.log_e - self.log_w)

    def parents(self) -> np.ndarray:
        return (self.key >> 16 << 8) | (self.key & 255)

    def descend(self, mixed: np.ndarray, left: np.ndarray) -> None:
        """``mixed``: the weighted estimates of the depths above, ``left``: the weight left for this
        depth and below. ``bit`` is the chance of a 1 where the path ends here."""
        self.mixed, self.left = mixed, left
        self.bit = np.clip(mixed + left * self.kt, 1e-12, 1 - 1e-12)

    def handed_down(self) -> tuple[np.ndarray, np.ndarray]:
        return self.mixed + self.left * self.own * self.kt, self.left * (1 - self.own)


def _level(strings: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Node keys and counts of contexts followed by bytes: (context * 256 + byte) in rising order."""
    context, byte = strings >> 8 << 8, strings & 255
    keys, zeros, ones = [], [], []
    for b in range(8):
        node = context | (1 << b) | (byte >> (8 - b))
        start = np.flatnonzero(np.append(True, node[1:] != node[:-1]))
        total = np.add.reduceat(n, start)
        one = np.add.reduceat(n * ((byte >> (7 - b)) & 1), start)
        keys.append(node[start])
        zeros.append(total - one)
        ones.append(one)
    key = np.concatenate(keys)
    order = np.argsort(key)
    return key[order], np.concatenate(zeros)[order], np.concatenate(ones)[order]


def _grouped(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums over equal neighbours."""
    if not len(keys):
        return keys, n
    start = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[start], np.add.reduceat(n, start)


def subtrees(strings: np.ndarray, n: np.ndarray, top: int) -> dict[int, Level]:
    """Levels DEPTH to ``top`` of the contexts in ``strings`` (in rising order), weighted bottom-up."""
    raw = {DEPTH: (strings, n)}
    for d in range(DEPTH - 1, top - 1, -1):
        # Contexts begin with the last byte, so dropping the earliest one keeps them in order; the
        # bytes that follow do not stay in order.
        longer, m = raw[d + 1]
        shorter = (longer >> 16 << 8) | (longer & 255)
        order = np.argsort(shorter, kind="stable")
        raw[d] = _grouped(shorter[order], m[order])
    levels: dict[int, Level] = {}
    for d in range(DEPTH, top - 1, -1):
        key, n0, n1 = _level(*raw[d])
        below = None
        if d < DEPTH:
            child = levels[d + 1]
            below = np.bincount(
                np.searchsorted(key, child.parents()), weights=child.log_w, minlength=len(key)
            )
        levels[d] = Level(key, n0, n1, below)
    return levels


def _whole(batches: Iterator[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray]:
    parts = [(b.column("key").to_numpy(), b.column("n").to_numpy()) for b in batches]
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    keys, n = (np.concatenate(p) for p in zip(*parts))
    order = np.argsort(keys)
    return keys[order], n[order]


def _by_subtree(strings: DataFrame) -> DataFrame:
    width = int(strings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    last_two = F.shiftright("key", 8 * (DEPTH - 1))
    return strings.select("key", "n").repartition(width, last_two)


def upper_levels(strings: DataFrame) -> tuple[Level, Level]:
    """Depths 0 and 1, from sums over the subtrees below them."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n = _whole(batches)
        if not len(keys):
            return
        level = subtrees(keys, n, 2)[2]
        parent, where = np.unique(level.parents(), return_inverse=True)
        sums = [np.bincount(where, weights=w) for w in (level.n0, level.n1, level.log_w)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(parent), *map(pa.array, sums)], names=["key", "n0", "n1", "below"]
        )

    parts = _by_subtree(strings).mapInArrow(summed, "key long, n0 double, n1 double, below double")
    table = parts.groupBy("key").agg(*[F.sum(c).alias(c) for c in ("n0", "n1", "below")]).orderBy("key").toArrow()
    one = Level(*(table.column(c).to_numpy() for c in ("key", "n0", "n1", "below")))
    key, where = np.unique(one.parents(), return_inverse=True)
    zero = Level(key, *(np.bincount(where, weights=w) for w in (one.n0, one.n1, one.log_w)))
    zero.descend(np.zeros(len(key)), np.ones(len(key)))
    mixed, left = zero.handed_down()
    one.descend(mixed[where], left[where])
    return zero, one


def node_key(depth: int, key: np.ndarray) -> np.ndarray:
    return key | (depth << 56)


def model_table(strings: DataFrame) -> DataFrame:
    """(kind, key, value, spread): for kind 1 the ln probability of the string's last byte after the
    others, for kind 2 the ``signed_chance`` of a 1 at a node where a path ends. ``spread`` deals contexts to
    blocks by their last three bytes; it is null for the nodes of depths 0 to 2, which every block has.
    """
    zero, one = upper_levels(strings)
    above, mixed, left = one.key, *one.handed_down()

    def finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n = _whole(batches)
        if not len(keys):
            return
        levels = subtrees(keys, n, 2)
        parent = np.searchsorted(above, levels[2].parents())
        levels[2].descend(mixed[parent], left[parent])
        for d in range(3, DEPTH + 1):
            parent = np.searchsorted(levels[d - 1].key, levels[d].parents())
            a, b = levels[d - 1].handed_down()
            levels[d].descend(a[parent], b[parent])
        logs = _string_logs(keys, levels[DEPTH])
        yield from _rows(1, keys, logs, spread_of(keys >> (8 * (DEPTH - 2))))
        for d, level in levels.items():
            spread = spread_of(level.key >> (8 * (d - 2))) if d > 2 else None
            yield from _rows(2, node_key(d, level.key), level.bit, spread)

    schema = "kind byte, key long, value float, spread int"
    table = _by_subtree(strings).mapInArrow(finished, schema)
    spark = strings.sparkSession
    upper = [b for d, level in ((0, zero), (1, one)) for b in _rows(2, node_key(d, level.key), level.bit, None)]
    if upper:
        table = table.union(spark.createDataFrame(pa.Table.from_batches(upper)).select(*table.columns))
    return stored(table, "ctw-model")


def spread_of(last_three: np.ndarray) -> np.ndarray:
    """A number below 2 ** 16 from the last three bytes of a context."""
    mixed = last_three.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(48)).astype(np.int32)


def signed_chance(chance: np.ndarray) -> np.ndarray:
    """A chance above 1/2 as the negative of what it lacks to 1: a short float holds both ends, so that neither a 0 nor
    a 1 ever has the probability 0."""
    return np.where(chance > 0.5, chance - 1.0, chance)


def _rows(kind: int, key: np.ndarray, value: np.ndarray, spread) -> Iterator[pa.RecordBatch]:
    if kind == 2:
        value = signed_chance(value)
    for at in range(0, len(key), 1 << 18):
        part = slice(at, at + (1 << 18))
        many = len(key[part])
        dealt = pa.nulls(many, pa.int32()) if spread is None else pa.array(spread[part])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(many, kind, np.int8)), pa.array(key[part]),
             pa.array(value[part].astype(np.float32)), dealt],
            names=["kind", "key", "value", "spread"],
        )


def _string_logs(strings: np.ndarray, level: Level) -> np.ndarray:
    """ln of the eight decisions of each string's last byte, all at nodes of the greatest depth."""
    context, byte = strings >> 8 << 8, strings & 255
    total = np.zeros(len(strings))
    for b in range(8):
        chance = level.bit[np.searchsorted(level.key, context | (1 << b) | (byte >> (8 - b)))]
        total += np.log(np.where((byte >> (7 - b)) & 1, chance, 1 - chance))
    return total


# --- scoring ---------------------------------------------------------------------------------

MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Block:
    """A part of the model: strings and nodes in rising order of key, the strings found by an open
    hash table of their places. Chances may be signed."""

    part: int
    parts: int
    strings: np.ndarray
    values: np.ndarray
    nodes: np.ndarray
    chances: np.ndarray

    def __post_init__(self) -> None:
        size = 1 << max(10, int(len(self.strings) * 2 - 1).bit_length())
        self.slots = np.full(size, -1, np.int32)
        left, self.probes = np.arange(len(self.strings), dtype=np.int32), 0
        while len(left):
            at = self.home(self.strings[left], self.probes)
            free = self.slots[at] < 0
            self.slots[at[free]] = left[free]
            left = left[self.slots[at] != left]
            self.probes += 1

    def home(self, strings: np.ndarray, probe: int) -> np.ndarray:
        mixed = strings.view(np.uint64) * MULTIPLIER
        mixed >>= np.uint64(64 - len(self.slots).bit_length() + 1)
        return (mixed.view(np.int64) + probe) & (len(self.slots) - 1)

    def logs(self, strings: np.ndarray) -> np.ndarray:
        """ln probability of the last byte of each string; 0 for strings of other blocks."""
        if self.parts > 1:
            own = self.own(strings)
            total = np.zeros(len(strings))
            total[own] = self._own_logs(strings[own])
            return total
        return self._own_logs(strings)

    def own(self, strings: np.ndarray) -> np.ndarray:
        """The places of the strings that this block has. The number of blocks is a power of two."""
        return np.flatnonzero(spread_of(strings >> (8 * (DEPTH - 2))) & (self.parts - 1) == self.part)

    def sums(self, strings: np.ndarray, of: np.ndarray, many: int) -> np.ndarray:
        """``logs`` added up by text."""
        if self.parts > 1:
            own = self.own(strings)
            strings, of = strings[own], of[own]
        return np.bincount(of, weights=self._own_logs(strings), minlength=many)

    def _own_logs(self, strings: np.ndarray) -> np.ndarray:
        found = np.full(len(strings), np.nan)
        left = np.arange(len(strings))
        for probe in range(self.probes):
            there = self.slots[self.home(strings[left], probe)]
            left, there = left[there >= 0], there[there >= 0]
            hit = self.strings[there] == strings[left]
            found[left[hit]] = self.values[there[hit]]
            left = left[~hit]
            if not len(left):
                break
        unseen = np.flatnonzero(np.isnan(found))
        if len(unseen):
            distinct, where = np.unique(strings[unseen], return_inverse=True)
            found[unseen] = self._unseen_logs(distinct)[where]
        return found

    def _unseen_logs(self, strings: np.ndarray) -> np.ndarray:
        """Each decision at the deepest node that training has seen; 1/2 where it has seen none."""
        byte, total = strings & 255, np.zeros(len(strings))
        for b in range(8):
            chance, left = np.full(len(strings), 0.5), np.arange(len(strings))
            for d in range(DEPTH, -1, -1):
                context = strings[left] >> (8 * (DEPTH + 1 - d)) << 8
                asked = node_key(d, context | (1 << b) | (byte[left] >> (8 - b)))
                at = np.minimum(np.searchsorted(self.nodes, asked), max(len(self.nodes) - 1, 0))
                hit = self.nodes[at] == asked if len(self.nodes) else np.zeros(len(left), bool)
                chance[left[hit]] = self.chances[at[hit]]
                left = left[~hit]
                if not len(left):
                    break
            one = (byte >> (7 - b)) & 1 == 1
            total += np.log(np.where(one == (chance >= 0), np.abs(chance), 1 - np.abs(chance)))
        return total


def block_count(table: DataFrame) -> int:
    """Into how many blocks the model must be cut for each to keep within its bounds."""
    sizes = table.groupBy("kind", "spread").agg(F.count("*").alias("n")).toArrow()
    kind, n = (sizes.column(c).to_numpy() for c in ("kind", "n"))
    everywhere = sizes.column("spread").is_null().to_numpy()
    spread = sizes.column("spread").fill_null(0).to_numpy()
    parts = 1
    while parts < 1 << 16:
        held = {
            k: np.bincount(spread[(kind == k) & ~everywhere] % parts, weights=n[(kind == k) & ~everywhere],
                           minlength=1).max() + n[(kind == k) & everywhere].sum()
            for k in (1, 2)
        }
        if held[1] <= BLOCK_STRINGS and held[2] <= BLOCK_NODES:
            break
        parts *= 2
    return parts


def load_block(table: DataFrame, part: int, parts: int) -> tuple:
    """The fields of one block, of a size that ``block_count`` has checked."""
    own = F.col("spread").isNull() | (F.col("spread") % parts == part)
    arrays = []
    for kind in (1, 2):
        rows = table.filter(own & (F.col("kind") == kind)).select("key", "value").toArrow()
        key, value = (rows.column(c).to_numpy() for c in ("key", "value"))
        order = np.argsort(key)
        arrays += [key[order], value[order]]
    return part, parts, *arrays


def common_tokens(tokens: DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    """(least count, keys, log10(count + 1)) of the tokens that occur at least so often; the least
    count is the lowest power of two that leaves no more than COMMON_TOKENS."""
    size = F.floor(F.log2(F.col("n").cast("double"))).cast("int").alias("size")
    sizes = {r["size"]: r["m"] for r in tokens.groupBy(size).agg(F.count("*").alias("m")).collect()}
    least, held = 0, 0
    for size in sorted(sizes, reverse=True):
        held += sizes[size]
        if held > COMMON_TOKENS:
            least = size + 1
            break
    rows = tokens.filter(F.col("n") >= 2**least).select("key", "n").orderBy("key").toArrow()
    return 2**least, rows.column("key").to_numpy(), np.log10(rows.column("n").to_numpy() + 1.0)


def score(documents: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte) for every
    row of ``documents``; ``score`` is the log10 probability of the text.

    The model learns from the rows that are not held out. Null and empty texts are an end alone; a
    null ``doc_id`` counts as an empty text in the split. Without any training row every bit has
    probability 1/2 and the base score is 0. Repeated rows are scored, and learned from, each.
    """
    remainder = crc_remainder(F.col("doc_id"), FOLDS)
    learned = stored(counts(documents.filter(remainder != HELD_OUT)), "ctw-counts")
    tokens = learned.filter(F.col("kind") == 0).select("key", "n")
    total = tokens.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    table = model_table(learned.filter(F.col("kind") == 1))
    least, keys, logs = common_tokens(tokens)
    parts = block_count(table)
    sc = documents.sparkSession.sparkContext
    known = sc.broadcast((keys, logs))
    model = sc.broadcast(load_block(table, 0, parts))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, (keys, logs) = Block(*model.value), known.value
        for batch in batches:
            for first, words, streams in _slices(_texts(batch.column("data"))):
                yield _scored_slice(batch.slice(first, len(words)), words, streams, block, keys, logs)

    rows = documents.select(
        "doc_id", (remainder == HELD_OUT).alias("held_out"), F.xxhash64(text_bytes()).alias("text_key"), text_bytes().alias("data")
    )
    kind = documents.schema["doc_id"].dataType.simpleString()
    first = stored(
        rows.mapInArrow(
            scored,
            f"doc_id {kind}, held_out boolean, text_key long, n_tokens long, n_bytes long, n_common long, "
            "logs double, score double, rare array<long>",
        ).withColumn("row", F.monotonically_increasing_id()),
        "ctw-scores",
    )
    rare = tokens.filter(F.col("n") < least)
    more = (
        first.select("row", F.explode("rare").alias("key"))
        .join(rare, "key")
        .groupBy("row")
        .agg(F.count("*").alias("_n"), F.sum(F.log10(F.col("n") + 1.0)).alias("_logs"))
    )
    found = first.drop("rare").join(more, "row", "left")
    for part in range(1, parts):
        more = _block_scores(documents, table, part, parts)
        found = found.join(
            more, F.col("doc_id").eqNullSafe(F.col(f"_id{part}")) & (F.col("text_key") == F.col(f"_key{part}"))
        )
    whole = sum((F.col(f"_score{p}") for p in range(1, parts)), F.col("score"))
    smoothed = math.log10(total.n + total.v + 1)
    return found.select(
        "doc_id", "held_out", "n_tokens",
        (F.col("n_common") + F.coalesce("_n", F.lit(0))).alias("n_known"),
        F.lit(total.n).cast("long").alias("train_tokens"),
        (F.col("logs") + F.coalesce("_logs", F.lit(0.0)) - F.col("n_tokens") * F.lit(smoothed)).alias("base_score"),
        whole.alias("score"),
        (-whole / F.col("n_bytes") * (LN10 / math.log(2.0))).alias("bits_per_byte"),
    )


def _block_scores(documents: DataFrame, table: DataFrame, part: int, parts: int) -> DataFrame:
    """What one block of the model adds to the score of each (doc_id, text)."""
    model = documents.sparkSession.sparkContext.broadcast(load_block(table, part, parts))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Block(*model.value)
        for batch in batches:
            for first, words, streams in _slices(_texts(batch.column("data"))):
                here = batch.slice(first, len(words))
                yield pa.RecordBatch.from_arrays(
                    [here.column(0), here.column(1), pa.array(_model_scores(streams, block))],
                    names=[f"_id{part}", f"_key{part}", f"_score{part}"],
                )

    rows = documents.select("doc_id", F.xxhash64(text_bytes()).alias("text_key"), text_bytes().alias("data"))
    kind = documents.schema["doc_id"].dataType.simpleString()
    added = rows.mapInArrow(scored, f"_id{part} {kind}, _key{part} long, _score{part} double")
    return stored(added.dropDuplicates([f"_id{part}", f"_key{part}"]), "ctw-block")


def _model_scores(streams: list[bytes], block: Block) -> np.ndarray:
    total = np.zeros(len(streams))
    for strings, of in _pieces(streams):
        total += block.sums(strings, of, len(streams))
    return total / LN10


def _scored_slice(batch, words, streams, block, keys, logs) -> pa.RecordBatch:
    distinct, codes, lengths = _coded(words)
    of = np.repeat(np.arange(len(words)), lengths)

    def looked_up(asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(keys):
            return np.zeros(len(asked), bool), np.zeros(len(asked))
        at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
        hit = keys[at] == asked
        return hit, np.where(hit, logs[at], 0.0)

    hit, value = looked_up(distinct)
    end_hit, end_value = looked_up(np.array([END_KEY], np.int64))
    n_common = np.bincount(of, weights=hit[codes], minlength=len(words)) + end_hit[0]
    sums = np.bincount(of, weights=value[codes], minlength=len(words)) + end_value[0]
    rare = np.flatnonzero(~hit[codes])
    ends = np.searchsorted(of[rare], np.arange(len(words) + 1))
    asked = distinct[codes[rare]]
    if not end_hit[0]:
        asked, ends = np.insert(asked, ends[1:], END_KEY), ends + np.arange(len(words) + 1)
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id"), batch.column("held_out"), batch.column("text_key"), pa.array(lengths + 1),
         pa.array([len(s) for s in streams], pa.int64()), pa.array(n_common.astype(np.int64)),
         pa.array(sums), pa.array(_model_scores(streams, block)),
         pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(asked))],
        names=["doc_id", "held_out", "text_key", "n_tokens", "n_bytes", "n_common", "logs", "score", "rare"],
    )
