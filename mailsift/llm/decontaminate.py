"""Benchmark decontamination by templates.

Texts become template tokens: words in lower case without outer punctuation, and the signs of arithmetic, with
numbers, units after numbers, and names (capitalised words inside a sentence) replaced by typed placeholders. Windows of
template tokens are hashed; windows of documents and benchmark items are joined on the hash. Names are
replaced in a second reading of the text only, so that a text in other letter case still matches, and
capitalised words that open a sentence in a third.

A match counts while the values in the placeholders stay consistent: along a run of matching windows
each value of the item must stand for one value in the document. A question with other numbers or
names passes, one whose placeholders contradict each other does not.

A filter of a fixed number of bits, set by the benchmark's windows, keeps most document windows from
being shuffled. It lets through too much, never too little; with a large benchmark more rows travel.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from mailsift.session import stored


WINDOW = 8
# A run of this many template tokens, or a whole shorter item, is a leak; so is this share of an item.
RUN = 13
COVERED = 0.5
FILTER_BITS = 22
SALTS = 16
# Words handled at a time, and words remembered between texts; both bound a task's memory only.
SLICE_WORDS = 1 << 17
REMEMBERED = 1 << 19

# --- fixed values -----------------------------------------------------------------------------
NUMBER_WORDS = frozenset(
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen "
    "sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred "
    "thousand million billion".split()
)
UNITS = frozenset(
    "mm cm m km in inch inches ft foot feet yd yard yards mi mile miles mg g kg gram grams kilogram "
    "kilograms oz ounce ounces lb lbs pound pounds ton tons ml l liter liters litre litres gallon "
    "gallons ms s sec second seconds min minute minutes h hr hour hours day days week weeks month "
    "months year years percent cent cents dollar dollars euro euros usd eur kb mb gb tb meter meters "
    "metre metres kilometer kilometers hz khz mhz ghz watt watts kw volt volts degree degrees".split()
)
# ----------------------------------------------------------------------------------------------

# What stands between numbers is a token: always these, and a minus between two numbers.
OPERATORS = frozenset("+ * / = × ÷ ^ < >".split())
MINUS = frozenset("- – −".split())
NUMBER = re.compile(r"\d[\d.,:/]*%?")
EDGES = re.compile(r"^\W+|\W+$")
PUNCTUATION = ".,;:!?\"'()[]{}"
# A unit behind its number, and an operator between two numbers, without a space.
ATTACHED = re.compile(r"(\d)(?:(?=[^\W\d_])|([-+*=×÷^])(?=\d))")
SENTENCE_END = (".", "!", "?", ":", "…")
PLACEHOLDERS = {"number": np.uint64(0x9E3779B97F4A7C15), "unit": np.uint64(0xC2B2AE3D27D4EB4F),
                "name": np.uint64(0x165667B19E3779F9)}
STEP = np.uint64(0x100000001B3)
MIX = np.uint64(0xFF51AFD7ED558CCD)


WORD, IS_NUMBER, IS_UNIT, IS_NAME, ENDS, IS_MINUS = (1 << i for i in range(6))


class _Words(dict):
    """Word -> index of its digest and kinds, filled on demand."""

    def __init__(self) -> None:
        super().__init__()
        self.digests, self.kinds = array("Q"), array("B")

    def __missing__(self, word: str) -> int:
        core = word.strip(PUNCTUATION)
        if not core.isalnum():
            core = EDGES.sub("", word)
        lower, kind = core.lower(), 0
        if not core:
            if word in OPERATORS:
                lower, kind = word, WORD
            elif word in MINUS:
                lower, kind = "-", WORD | IS_MINUS
        elif core[0].isdigit() and NUMBER.fullmatch(core) or lower in NUMBER_WORDS:
            kind = WORD | IS_NUMBER
        else:
            kind = WORD
            if core[0].isupper() and any(c.islower() for c in core):
                kind |= IS_NAME
        if lower in UNITS:
            kind |= IS_UNIT
        if not word[-1].isalnum() and word.rstrip("\"')]}»”").endswith(SENTENCE_END):
            kind |= ENDS
        self.digests.append(xxhash.xxh64_intdigest(lower.encode("utf-8", "surrogatepass")))
        self.kinds.append(kind)
        found = len(self)
        self[word] = found
        return found


@dataclass(frozen=True)
class Tokens:
    """The tokens of some texts: the text each is in, its place there, its digest, and the templates: plain, with
    names inside sentences, with every capitalised word as a name."""

    of: np.ndarray
    at: np.ndarray
    digest: np.ndarray
    plain: np.ndarray
    named: np.ndarray
    every: np.ndarray


@dataclass(frozen=True)
class Windows:
    """Hashed windows of some texts: the text and token each begins at, and the values in its
    placeholders (0 elsewhere)."""

    text: np.ndarray
    start: np.ndarray
    hashes: np.ndarray
    values: np.ndarray


class Reader:
    """Turns texts into tokens; keeps what it knows about words from one text to the next."""

    def __init__(self) -> None:
        self.words = _Words()

    def tokens(self, texts: list[str]) -> Tokens:
        if len(self.words) > REMEMBERED:
            self.words = _Words()
        known, codes, sizes = self.words, [], []
        for text in texts:
            split = ATTACHED.sub(r"\1 \2 ", text).split()
            codes.extend([known[w] for w in split])
            sizes.append(len(split))
        code = np.array(codes, np.int64)
        digest, kind = np.array(known.digests, np.uint64)[code], np.array(known.kinds, np.uint8)[code]
        sizes = np.array(sizes, np.int64)
        of = np.repeat(np.arange(len(texts)), sizes)
        opens = np.zeros(len(code), bool)
        opens[1:] = (kind[:-1] & ENDS) > 0
        opens[(np.cumsum(sizes) - sizes)[sizes > 0]] = True
        number = (kind & IS_NUMBER) > 0
        between = np.zeros(len(code), bool)
        between[1:-1] = number[:-2] & number[2:] & (of[:-2] == of[2:])
        keep = ((kind & WORD) > 0) & (((kind & IS_MINUS) == 0) | between)
        digest, kind, of, opens, number = digest[keep], kind[keep], of[keep], opens[keep], number[keep]
        after_number = np.zeros(len(kind), bool)
        after_number[1:] = number[:-1] & (of[1:] == of[:-1])
        plain = digest.copy()
        plain[((kind & IS_UNIT) > 0) & after_number] = PLACEHOLDERS["unit"]
        plain[number] = PLACEHOLDERS["number"]
        name = (kind & IS_NAME) > 0
        named, every = plain.copy(), plain.copy()
        named[name & ~opens] = PLACEHOLDERS["name"]
        every[name] = PLACEHOLDERS["name"]
        first = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(texts)))])
        return Tokens(of, np.arange(len(of)) - first[of], digest, plain, named, every)


def rolled(template: np.ndarray, size: int) -> np.ndarray:
    """The hash of each window of ``size`` tokens."""
    n = len(template) - size + 1
    hashes = np.zeros(n, np.uint64)
    for j in range(size):
        hashes = hashes * STEP + template[j : n + j]
    hashes ^= hashes >> np.uint64(29)
    hashes *= MIX
    return hashes ^ (hashes >> np.uint64(32))


def windows_of(tokens: Tokens, size: int, passed=None) -> Windows:
    """All windows of ``size`` tokens that ``passed`` lets through: in templates if at least half of the tokens are no
    placeholders, and as they stand if numbers and units are more than half. Windows that a reading leaves as an
    earlier one has them are not repeated."""
    n = len(tokens.of) - size + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return Windows(none, none, none.astype(np.uint64), np.zeros((0, size), np.uint64))
    digest, plain, named, every = tokens.digest, tokens.plain, tokens.named, tokens.every

    def within(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags)])
        return sums[size:] - sums[:-size]

    inside = tokens.of[:n] == tokens.of[size - 1 :]
    found = []
    for template, before in ((plain, ()), (named, (plain,)), (every, (plain, named)), (digest, ())):
        as_it_stands = template is digest
        mostly = within((plain if as_it_stands else template) != digest) * 2 > size
        good = inside & (mostly if as_it_stands else ~mostly)
        for earlier in before:
            good &= within(template != earlier) > 0
        if not good.any():
            continue
        hashes = rolled(template, size)
        if passed is not None:
            good &= passed(hashes)
        at = np.flatnonzero(good)
        spread = at[:, None] + np.arange(size)
        values = np.where(template[spread] != digest[spread], digest[spread], np.uint64(0))
        found.append((tokens.of[at], tokens.at[at], hashes[at], values))
    if not found:
        return windows_of(Tokens(*[v[:0] for v in vars(tokens).values()]), size)
    return Windows(*(np.concatenate(parts) for parts in zip(*found)))


def _slices(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about SLICE_WORDS words; a long text is a range of its own."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text) // 6 + 1
        if size >= SLICE_WORDS:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def _signed(a: np.ndarray) -> pa.Array:
    return pa.array(a.view(np.int64))


def _lists(values: np.ndarray) -> pa.Array:
    ends = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), _signed(np.ascontiguousarray(values).reshape(-1)))


def text_key(text: str) -> int:
    """What Spark's ``xxhash64`` gives for the text: XXH64 with seed 42, signed."""
    digest = xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"), 42)
    return digest - (1 << 64) if digest >= 1 << 63 else digest


def item_windows(benchmark: DataFrame) -> DataFrame:
    """(hash, size, item_id, item, n_tokens, at, item_values): every window of every item. An item
    shorter than a window is one window of its own size. ``item`` tells repeated ids apart."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader()
        for batch in batches:
            for i in range(batch.num_rows):
                text = batch.column("text")[i].as_py() or ""
                tokens = reader.tokens([text])
                n = len(tokens.of)
                if n == 0:
                    continue
                size = min(WINDOW, n)
                w = windows_of(tokens, size)
                if not len(w.start):
                    continue
                many = len(w.start)
                key = text_key(text)
                yield pa.RecordBatch.from_arrays(
                    [_signed(w.hashes), pa.array([size] * many, pa.int32()),
                     pa.array([batch.column("item_id")[i].as_py()] * many, batch.schema.field("item_id").type),
                     pa.array([key] * many, pa.int64()), pa.array([n] * many, pa.int64()),
                     pa.array(w.start), _lists(w.values)],
                    names=["hash", "size", "item_id", "item", "n_tokens", "at", "item_values"],
                )

    kind = benchmark.schema["item_id"].dataType.simpleString()
    return benchmark.select("item_id", "text").mapInArrow(
        read,
        f"hash long, size int, item_id {kind}, item long, n_tokens long, at long, item_values array<long>",
    )


def _filter_of(windows: DataFrame) -> np.ndarray:
    """One bit per value of a window hash's top bits. The driver gets at most 2 ** FILTER_BITS rows."""
    top = F.shiftrightunsigned("hash", 64 - FILTER_BITS).alias("bit")
    bits = np.zeros(1 << FILTER_BITS, bool)
    for batch in windows.select(top).distinct().toArrow().to_batches():
        bits[batch.column(0).to_numpy()] = True
    return np.packbits(bits)


def document_windows(documents: DataFrame, sizes: list[int], packed: np.ndarray) -> DataFrame:
    """(hash, size, doc_id, doc, start, doc_values): the windows that the filter lets through. ``doc``
    tells rows of one id by their text."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, bits = Reader(), np.unpackbits(packed).astype(bool)
        shift = np.uint64(64 - FILTER_BITS)

        def passed(hashes: np.ndarray) -> np.ndarray:
            return bits[(hashes >> shift).astype(np.int64)]

        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            ids = batch.column("doc_id")
            for low, high in _slices(texts):
                part = texts[low:high]
                tokens = reader.tokens(part)
                for size in sizes:
                    w = windows_of(tokens, size, passed)
                    if not len(w.start):
                        continue
                    keys = {i: text_key(part[i]) for i in np.unique(w.text).tolist()}
                    yield pa.RecordBatch.from_arrays(
                        [_signed(w.hashes), pa.array([size] * len(w.start), pa.int32()),
                         ids.take(pa.array(w.text + low)),
                         pa.array([keys[i] for i in w.text.tolist()], pa.int64()), pa.array(w.start),
                         _lists(w.values)],
                        names=["hash", "size", "doc_id", "doc", "start", "doc_values"],
                    )

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(
        read, f"hash long, size int, doc_id {kind}, doc long, start long, doc_values array<long>"
    )


def longest_run(matches: list[dict], size: int) -> tuple[int, int]:
    """Template tokens in the longest run of windows at consecutive places whose placeholder values are consistent,
    and the tokens of runs that are also consistent with longer ones.

    Of several readings of a window the one with the fewest values counts: it allows whatever another one allows.
    """
    said: dict[int, dict] = {}
    for m in matches:
        own = _agreed({}, [(a, b) for a, b in zip(m["item_values"], m["doc_values"]) if a and b])
        if own is not None and (m["at"] not in said or len(own) < len(said[m["at"]])):
            said[m["at"]] = own
    runs: list[tuple[int, int, dict]] = []  # first, last, values: each as long as it can be
    first, values = 0, None
    for at in sorted(said):
        joined = _agreed(values, said[at].items()) if values is not None and at - 1 in said else None
        if joined is None:
            # The longest consistent run that ends here; none that ends earlier reaches further back.
            if values is not None:
                runs.append((first, last, values))
            low = first if values is not None and at - 1 in said else at
            first, joined = at, said[at]
            while first > low and (longer := _agreed(joined, said[first - 1].items())) is not None:
                first, joined = first - 1, longer
        last, values = at, joined
    if values is not None:
        runs.append((first, last, values))
    together, covered = {}, set()
    for first, last, values in sorted(runs, key=lambda r: (r[0] - r[1], r[0])):
        joined = _agreed(together, values.items())
        if joined is not None:
            together = joined
            covered.update(range(first, last + size))
    return max((last - first + size for first, last, _ in runs), default=0), len(covered)


def _agreed(said: dict, pairs) -> dict | None:
    """``said`` with further pairs, or None if one value would stand for two."""
    merged = dict(said)
    return merged if all(merged.setdefault(a, b) == b for a, b in pairs) else None


def leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, doc, item_id, matched, covered): documents that hold a benchmark item or a run of it.

    ``matched`` counts the template tokens of the longest consistent run, ``covered`` is the share of
    the item's tokens in such runs. One row per (document row with its text, item id). Null and empty
    texts match nothing; what is mostly numbers and units matches only itself; repeated rows give one result.
    """
    items = stored(item_windows(benchmark), "benchmark-windows")
    sizes = sorted(r[0] for r in items.select("size").distinct().collect())
    found = document_windows(documents, sizes, _filter_of(items))
    salt = F.pmod(F.xxhash64("doc"), F.lit(SALTS)).cast("int")
    salted = items.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    hits = found.withColumn("salt", salt).join(salted, ["hash", "size", "salt"])
    # One group is one way of laying an item over a document: no longer than the item.
    laid = hits.groupBy(
        "doc_id", "doc", "item_id", "item", "n_tokens", "size", (F.col("start") - F.col("at")).alias("shift")
    ).agg(F.collect_set(F.struct("at", "item_values", "doc_values")).alias("matches"))

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, matches = batch.column("size").to_pylist(), batch.column("matches").to_pylist()
            runs = [longest_run(m, s) for m, s in zip(matches, sizes)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("doc_id", "doc", "item_id", "n_tokens")]
                + [pa.array([r[0] for r in runs], pa.int64()), pa.array([r[1] for r in runs], pa.int64())],
                names=["doc_id", "doc", "item_id", "n_tokens", "matched", "tokens"],
            )

    kinds = [f"{c} {laid.schema[c].dataType.simpleString()}" for c in ("doc_id", "doc", "item_id", "n_tokens")]
    runs = laid.mapInArrow(judged, ", ".join([*kinds, "matched long", "tokens long"]))
    share = F.col("tokens") / F.col("n_tokens")
    leaking = (F.col("matched") >= F.least(F.lit(RUN), F.col("n_tokens"))) | (share >= COVERED)
    return runs.filter(leaking).groupBy("doc_id", "doc", "item_id").agg(
        F.max("matched").alias("matched"), F.max(share).alias("covered")
    )


def clean_documents(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``documents`` that hold no benchmark item."""
    found = leaks(documents, benchmark).select(F.col("doc_id").alias("_id"), F.col("doc").alias("_doc")).distinct()
    same = F.xxhash64(F.coalesce(documents["text"], F.lit(""))) == found["_doc"]
    return documents.join(found, documents["doc_id"].eqNullSafe(found["_id"]) & same, "left_anti")
