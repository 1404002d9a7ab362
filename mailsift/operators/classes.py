"""Class names, class ids and class sizes. Classes are rows, however many there are."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from mailsift.operators.words import with_word_values
from mailsift.session import stored

# Sums that a task holds at once: documents times classes.
SUMS_AT_ONCE = 1 << 22
# Models of at most so many classes have a column for each.
CLASS_COLUMNS = 64


def class_map(messages: DataFrame) -> DataFrame:
    """(class_id, class_name): class names numbered 1..n in byte order."""
    names = messages.select("class_name").filter(F.col("class_name").isNotNull()).distinct()
    # Only the distinct names meet in one place.
    rank = F.row_number().over(Window.orderBy("class_name"))
    return names.select(rank.alias("class_id"), "class_name")


def with_class_id(messages: DataFrame, classes: DataFrame) -> DataFrame:
    """Replace ``class_name`` by ``class_id``; null where the class is not in the map. A map that is
    small goes to every task by itself; a class with most of the messages is split otherwise."""
    carried = [c for c in messages.columns if c != "class_name"]
    return messages.join(classes, "class_name", "left").select("class_id", *carried)


def class_doc_counts(messages: DataFrame, n_tokens: Column) -> DataFrame:
    """(class_id, n_docs): messages that have at least one token, per class. ``n_tokens`` is worked
    out in the row."""
    return messages.filter(n_tokens > 0).groupBy("class_id").agg(F.count("*").alias("n_docs"))


@dataclass(frozen=True)
class Places:
    """The classes of a model in the order of their ids, and constants of each: as many values as a model has
    classes, kept on the driver."""

    ids: np.ndarray
    constants: dict[str, np.ndarray]

    @classmethod
    def of(cls, classes: DataFrame, *constants: str) -> Places:
        found = classes.select("class_id", *constants).dropDuplicates(["class_id"]).orderBy("class_id").toArrow()
        return cls(found["class_id"].to_numpy(), {c: found[c].to_numpy().astype(float) for c in constants})


def class_lists(table: DataFrame, on: str, value: Column, frequency: Column) -> DataFrame:
    """(<on>, by_class, frequency): the (class_id, value) pairs of each <on>, one per class it has, and how
    often it occurs."""
    pair = F.struct("class_id", value.cast("double").alias("value"))
    return table.groupBy(on).agg(F.collect_list(pair).alias("by_class"), F.sum(frequency).alias("frequency"))


def vector_sums(rows: DataFrame, places: Places, start: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """(doc_id, sums): for each document the ``weight`` times ``by_class`` of its rows added up class by class.

    ``rows`` (doc_id, weight, by_class): the rows of a document are gathered in its row, and a batch of documents
    becomes one matrix; no row is made per class. ``by_class`` may be null. ``start`` gives a document's sums
    without any row from the total of its weights, as a matrix with a line for each total.
    """
    ids, n = places.ids, max(len(places.ids), 1)
    step = max(1, SUMS_AT_ONCE // n)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, step):
                batch = whole.slice(at, step)
                listed = batch.column("rows")
                of = np.repeat(np.arange(batch.num_rows), listed.value_lengths().to_numpy(zero_copy_only=False))
                rows = listed.flatten()
                weight, by_class = rows.field("weight").to_numpy(zero_copy_only=False), rows.field("by_class")
                sizes = by_class.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                entries = by_class.flatten()
                place = np.searchsorted(ids, entries.field("class_id").to_numpy(zero_copy_only=False))
                products = np.repeat(weight, sizes) * entries.field("value").to_numpy(zero_copy_only=False)
                sums = np.bincount(np.repeat(of, sizes) * n + place, products, batch.num_rows * n)
                totals = np.bincount(of, weight, batch.num_rows)
                sums = sums.reshape(-1, n)[:, : len(ids)] + start(totals)
                offsets = pa.array(np.arange(len(sums) + 1, dtype=np.int32) * len(ids))
                lists = pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(sums).ravel()))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists], names=["doc_id", "sums"])

    row = F.struct(F.col("weight").cast("double").alias("weight"), "by_class")
    gathered = rows.groupBy("doc_id").agg(F.collect_list(row).alias("rows"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return gathered.mapInArrow(added, f"doc_id {kind}, sums array<double>")


def class_sums(
    rows: DataFrame,
    table: DataFrame,
    value: Column,
    on: str,
    places: Places,
    start: np.ndarray,
    per_weight: np.ndarray,
    frequency: Column | None = None,
) -> DataFrame:
    """(doc_id, sums): for each document and class ``start``, ``per_weight`` times the sum of its ``weight``, and the
    ``weight`` times the class's ``value`` of each of its rows whose <on> the class has.

    ``rows`` (doc_id, <on>, weight), stored; ``table`` (class_id, <on>, …), one row per class and <on>. ``frequency``, summed
    over the classes, is how often <on> occurs in a corpus like the rows (see ``with_word_values``). Rows are
    added up per document where they lie before anything travels, and those without a value do not travel at all.
    """
    often = None if frequency is None else "frequency"
    if len(places.ids) > CLASS_COLUMNS:
        lists = class_lists(table, on, value, F.lit(1) if frequency is None else frequency)
        lists = stored(lists if often else lists.drop("frequency"), "class-lists")
        found = with_word_values(rows.select("doc_id", on, "weight"), lists, often, on, keep_unknown=True)
        return vector_sums(
            found.select("doc_id", "weight", "by_class"), places, lambda totals: start + totals[:, None] * per_weight
        )
    names = [f"_class{i}" for i in range(len(places.ids))]
    own = [
        F.coalesce(F.sum(F.when(F.col("class_id") == int(c), value.cast("double"))), F.lit(0.0)).alias(name)
        for c, name in zip(places.ids, names)
    ]
    counted = [] if frequency is None else [F.sum(frequency).alias("frequency")]
    values = stored(table.groupBy(on).agg(F.count("*").alias("_n"), *own, *counted), "class-values")
    known = with_word_values(rows.select("doc_id", on, "weight"), values, often, on)
    weight = F.col("weight").cast("double")
    parts = known.select("doc_id", F.lit(0.0).alias("_total"), *[(weight * F.col(c)).alias(c) for c in names])
    totals = rows.select("doc_id", weight.alias("_total"), *[F.lit(0.0).alias(c) for c in names])
    sums = parts.unionByName(totals).groupBy("doc_id").agg(*[F.sum(c).alias(c) for c in ("_total", *names)])
    ends = [
        F.col(c) + (F.lit(float(s)) + F.col("_total") * F.lit(float(p))) for c, s, p in zip(names, start, per_weight)
    ]
    return sums.select("doc_id", F.array(*ends).cast("array<double>").alias("sums"))


def _ids(places: Places) -> Column:
    return F.lit([int(i) for i in places.ids] or None)


def by_class(sums: DataFrame, places: Places, name: str) -> DataFrame:
    """(doc_id, class_id, <name>): a row for every document and class, from (doc_id, sums)."""
    rows = sums.select("doc_id", F.posexplode("sums").alias("_at", name))
    return rows.select("doc_id", F.get(_ids(places), F.col("_at")).alias("class_id"), name)


def likeliest(sums: DataFrame, places: Places) -> DataFrame:
    """(doc_id, best, class_id): the largest sum of each document and its class, the smallest id among equals."""
    best = F.array_max("sums")
    at = F.array_position("sums", best).cast("int") - 1
    return sums.select("doc_id", best.alias("best"), F.get(_ids(places), at).alias("class_id"))
