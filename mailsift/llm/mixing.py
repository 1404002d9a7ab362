"""Mixing sources to target weights by entropy balancing.

Every document gets a rate between 0 and ``CEILING``, the expected number of its copies. Among all
rates that give each source its target number of words, the ones of highest entropy (binary entropy
of rate / CEILING per document) are exponentially tilted in the document's size:

    rate / (CEILING - rate) = exp(lambda_s * size / mean size of the source)

The multipliers lambda solve the convex dual. Newton steps on it are sums over a histogram of sizes,
one aggregation for all sources at a time; a step that leaves the bracket found so far is replaced by
its middle. Rates become copies by rounding the running sum of rates along the sizes of a source, so
that a source's words miss the target by less than its longest document. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from mailsift.llm.common import gapless_rank, word_count
from mailsift.session import stored

CEILING = 2.0
SHARE = 1.5
# The weights of the sources in order, repeating.
SOURCE_WEIGHTS = (3.0, 1.0, 2.0)

# Steps after which halving alone has narrowed any bracket to the digits that are kept.
MAX_STEPS = 200
DIGITS = 10
TOLERANCE = 1e-9
# Starting points of the running sum that are tried for each source.
OFFSETS = 64
LIMIT = 1e9


def targets(sizes: DataFrame) -> DataFrame:
    """(source, weight, source_size, target) from (source, source_size), one row per source.

    The sources share ``SHARE`` of all words by weight; a target stops at ``CEILING`` times the size
    of its source and what it leaves is shared again. With the sources in the order in which they
    stop, the level (words per unit of weight) that is reached when the first k have stopped grows
    up to the last one that stops and falls from there, so the final level is the highest one.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    position = F.row_number().over(by_name) - 1
    weights = F.array(*[F.lit(w) for w in SOURCE_WEIGHTS])
    listed = sizes.withColumn("weight", F.get(weights, position % len(SOURCE_WEIGHTS)))
    listed = listed.withColumn("_cap", CEILING * F.col("source_size"))
    stops = Window.orderBy(F.col("_cap") / F.col("weight"), F.col("source").asc_nulls_last())
    earlier = stops.rowsBetween(Window.unboundedPreceding, -1)
    onwards = stops.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    left = SHARE * F.sum("source_size").over(everything) - F.coalesce(
        F.sum("_cap").over(earlier), F.lit(0.0)
    )
    return (
        listed.withColumn("_level", left / F.sum("weight").over(onwards))
        .withColumn("_level", F.max("_level").over(everything))
        .withColumn("target", F.least("_cap", F.col("weight") * F.col("_level")))
        .select("source", "weight", "source_size", "target")
    )


def _odds(share: Column) -> Column:
    return F.log(share / (1 - share))


def _left_over() -> Column:
    """Whether a multiplier can still be told apart from the ends of its bracket at the digits that are kept."""
    return F.round(F.col("high"), DIGITS) != F.round(F.col("low"), DIGITS)


def solve(histogram: DataFrame) -> DataFrame:
    """(source_no, lambda) for the sources whose target lies strictly between 0 and the ceiling.

    ``histogram``: (source_no, size, n, x, source_size, target). Steps are taken on the log odds of
    the words taken, which is a straight line in lambda when all documents have one size.
    """
    aim = F.col("target") / (CEILING * F.col("source_size"))
    state = stored(
        histogram.groupBy("source_no").agg(F.first(_odds(aim)).alias("lambda")).select(
            "source_no", "lambda", F.lit(-LIMIT).alias("low"), F.lit(LIMIT).alias("high"),
            F.lit(1.0).alias("miss"),
        ),
        "mixing-state",
    )
    chance = 1 / (1 + F.exp(-F.col("lambda") * F.col("x")))
    words = F.col("n") * F.col("size") / F.col("source_size")
    for _ in range(MAX_STEPS):
        taken = (
            histogram.join(state, "source_no")
            .groupBy("source_no")
            .agg(
                F.sum(words * chance).alias("share"),
                F.sum(words * F.col("x") * chance * (1 - chance)).alias("slope"),
                F.first(aim).alias("aim"),
                *[F.first(c).alias(c) for c in ("lambda", "low", "high")],
            )
        )
        too_much = F.col("share") > F.col("aim")
        taken = taken.select(
            "source_no", "lambda", "share", "slope", "aim",
            F.when(too_much, F.col("low")).otherwise(F.col("lambda")).alias("low"),
            F.when(too_much, F.col("lambda")).otherwise(F.col("high")).alias("high"),
            (F.abs(F.col("share") - F.col("aim")) / F.col("aim")).alias("miss"),
        )
        spread = F.col("share") * (1 - F.col("share")) / F.col("slope")
        step = F.col("lambda") + (_odds(F.col("aim")) - _odds(F.col("share"))) * spread
        inside = (step > F.col("low")) & (step < F.col("high")) & ~F.isnan(step)
        middle = (F.col("low") + F.col("high")) / 2
        following = (
            F.when(F.col("miss") <= TOLERANCE, F.col("lambda"))
            .when(inside, step)
            .otherwise(middle)
        )
        state = stored(
            taken.select("source_no", following.alias("lambda"), "low", "high", "miss"), "mixing-state"
        )
        worst, widest = state.filter(F.col("miss") > TOLERANCE).agg(F.max("miss"), F.max(_left_over())).first()
        if worst is None or not widest:
            break
    else:
        raise RuntimeError(f"the multipliers did not settle in {MAX_STEPS} steps")
    # Sums may run in another order in another run; what that changes is rounded away.
    return state.select("source_no", F.round("lambda", DIGITS).alias("lambda"))


def rates(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents as (doc_id, source, size), and one row per (source, size) with ``rate``, the words of
    the source, its target and where the running sum of rates starts."""
    sized = stored(documents.select("doc_id", "source", word_count(F.col("text")).alias("size")), "sizes")
    counts = sized.groupBy("source", "size").agg(F.count("*").alias("n"))
    sources = counts.groupBy("source").agg(
        F.sum(F.col("n") * F.col("size")).alias("source_size"),
        F.sum(F.when(F.col("size") > 0, F.col("n"))).alias("_filled"),
    )
    aims = targets(sources.select("source", "source_size"))
    aims = aims.withColumn("source_no", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    named = aims.select(F.col("source").alias("_source"), "source_no", "source_size", "target")
    filled = sources.select(F.col("source").alias("_of"), "_filled")
    named = named.join(filled, F.col("_source").eqNullSafe(F.col("_of")))
    mean = F.col("source_size") / F.greatest(F.col("_filled"), F.lit(1))
    histogram = stored(
        counts.join(named, F.col("source").eqNullSafe(F.col("_source"))).select(
            "source", "source_no", "size", "n", "source_size", "target",
            F.when(F.col("source_size") > 0, F.col("size") / mean).otherwise(0.0).alias("x"),
        ),
        "mixing-histogram",
    )
    share = F.col("target") / (CEILING * F.col("source_size"))
    free = (F.col("source_size") > 0) & (share > 0) & (share < 1 - 1e-12)
    solved = solve(histogram.filter(free))
    rate = (
        F.when(F.col("lambda").isNotNull(), CEILING / (1 + F.exp(-F.col("lambda") * F.col("x"))))
        .when(F.col("source_size") == 0, F.lit(1.0))
        .when(share > 0, F.lit(CEILING))
        .otherwise(0.0)
    )
    tilted = histogram.join(solved, "source_no", "left").withColumn("rate", rate)
    smaller = Window.partitionBy("source_no").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    running = F.coalesce(F.sum(F.col("n") * F.col("rate")).over(smaller), F.lit(0.0))
    tilted = stored(tilted.withColumn("_before", running), "mixing-rates")
    return sized, tilted.join(_offsets(tilted), "source_no").withColumn(
        "start", F.col("_before") + F.col("_offset")
    ).select("source", "size", "rate", "start", "source_size", "target")


def _offsets(tilted: DataFrame) -> DataFrame:
    """(source_no, _offset): the starting point whose rounding comes nearest to the target. The
    copies of all documents of one size are a difference of two floors."""
    tried = tilted.withColumn(
        "_offset", F.explode(F.transform(F.sequence(F.lit(0), F.lit(OFFSETS - 1)), lambda k: k / OFFSETS))
    )
    first = F.floor(F.col("_before") + F.col("_offset"))
    last = F.floor(F.col("_before") + F.col("n") * F.col("rate") + F.col("_offset"))
    words = tried.groupBy("source_no", "_offset").agg(
        F.abs(F.sum((last - first) * F.col("size")) - F.first("target")).alias("_miss")
    )
    best = F.min(F.struct("_miss", "_offset"))
    return words.groupBy("source_no").agg(best.alias("b")).select("source_no", F.col("b._offset").alias("_offset"))


def _copies() -> Column:
    """How many whole numbers the running sum of rates passes on a document."""
    low = F.floor(F.col("start") + F.col("_rank") * F.col("rate"))
    high = F.floor(F.col("start") + (F.col("_rank") + 1) * F.col("rate"))
    return (high - low).cast("long")


def mix(documents: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken, rate, copies) for every row of ``documents``.

    ``size`` counts words, 0 for a null text. A null source is a source, the last one. A source
    without words has target 0 and its documents are taken once. Documents of equal size in one
    source are told apart by ``doc_id`` only, so repeated rows may get different copies, but the rows
    as a whole are the same in every run. No document is taken more than twice.
    """
    sized, classes = rates(documents)
    ranked = gapless_rank(sized, ["source", "size"], [F.col("doc_id")], F.col("doc_id"), "_rank", classes)
    return ranked.withColumn("copies", _copies()).select(
        "doc_id", "size", "source_size", F.col("target").cast("double").alias("target"),
        (F.col("copies") * F.col("size")).cast("long").alias("taken"), "rate", "copies",
    )


def mixed_documents(documents: DataFrame) -> DataFrame:
    """``documents`` with every row as often as the mix takes it, all columns as they are."""
    _, classes = rates(documents)
    carried = F.struct(*[F.col(c) for c in documents.columns]).alias("_document")
    sized = documents.select(
        F.col("source"), word_count(F.col("text")).alias("size"), F.col("doc_id").alias("_id"), carried
    )
    ranked = gapless_rank(sized, ["source", "size"], [F.col("_id")], F.col("_id"), "_rank", classes)
    times = F.array_repeat(F.lit(1), _copies().cast("int"))
    return ranked.select("_document", F.explode(times)).select("_document.*")
