"""Mixing sources to target weights by a low-discrepancy schedule.

Each source's documents stand in a shuffled order and form a stream of words that is
read at most ``max_repeats`` times. The stream is cut into blocks of ``block_words``
words. The mix is a sequence of slots; slot ``k`` maps the golden-ratio point of ``k``
through the sources' cumulative weights, and a source's n-th slot takes its n-th block.

Defined results: a null text has size 0; a null source is a source of its own and comes
last; documents of size 0 take no words; repeated rows are documents of their own; ties
in the shuffled order go by id, then text size. An empty table gives an empty mix.
Columns other than the three that are named are never read, so their names can't clash.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import bounded_batches, saved
from .text import pieces, words

#: The golden-ratio step over a circle of 2^31 points, odd so that the points visit all of them.
CIRCLE = 1 << 31
GOLDEN_STEP = 1327217885
_BINS = 1024
_ORDER_BUCKETS = 1024
_SLOT_CHUNK = 1 << 16
#: Among any n golden-ratio points, gaps are under 2.62/n: three times the slots reach every quota.
_OVERSHOOT = 3


def _count_words(column: pa.Array) -> pa.Array:
    out = []
    for first, end, data, offsets in pieces(column):
        _, _, row = words(data, offsets)
        counts = [0] * (end - first)
        if len(row):
            import numpy as np

            counts = np.bincount(row, minlength=end - first).tolist()
        out += counts
    return pa.array(out, pa.int64())


def word_count(text: Column) -> Column:
    """Runs of bytes other than ASCII white space; 0 for null."""

    def count(column: pa.Array) -> pa.Array:
        return _count_words(column)

    return F.arrow_udf(count, "long")(text)


def source_targets(sized: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, max_repeats: int = 2) -> DataFrame:
    """source, source_size, target: water-filling of ``share`` of all words by weight, under ``max_repeats`` times a source.

    A source is at its cap exactly if its cap per weight is not above the level that is
    left after all sources with a smaller cap per weight, so one sorted pass decides.
    The table has a row for each source, not for each document.
    """
    by = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy(F.lit(1))
    ranked = (
        sized.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(by) - 1) % len(weights) + 1).cast("int")))
        .withColumn("cap", F.col("source_size") * F.lit(float(max_repeats)))
        .withColumn("total", F.sum("source_size").over(everything) * F.lit(float(share)))
    )
    rising = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = (
        ranked.withColumn("cap_before", F.sum("cap").over(rising) - F.col("cap"))
        .withColumn("weight_left", F.sum("weight").over(everything) - F.sum("weight").over(rising) + F.col("weight"))
        .withColumn("capped", F.col("cap") * F.col("weight_left") <= (F.col("total") - F.col("cap_before")) * F.col("weight"))
    )
    level = (F.col("total") - F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))).over(everything), F.lit(0.0))) / F.sum(F.when(~F.col("capped"), F.col("weight"))).over(everything)
    return filled.select("source", "source_size", F.when(F.col("capped"), F.col("cap")).otherwise(F.col("weight") * level).alias("target"))


def stream_positions(sized: DataFrame, seed: int) -> DataFrame:
    """doc_id, source, size, pos: where a document begins in its source's shuffled stream.

    Running sums go by (source, hash bucket) with the buckets' own running sums added,
    so a source with a third of all rows is spread over many tasks.
    """
    keyed = sized.withColumn("order_key", F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))))
    keyed = keyed.withColumn("bucket", (F.conv(F.substring("order_key", 1, 5), 16, 10).cast("long") % _ORDER_BUCKETS).cast("int"))
    totals = keyed.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    upto = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = totals.select("source", "bucket", (F.sum("words").over(upto) - F.col("words")).alias("before"))
    inside = Window.partitionBy("source", "bucket").orderBy("order_key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = keyed.withColumn("inner", F.sum("size").over(inside) - F.col("size"))
    same = placed["source"].eqNullSafe(totals["source"]) & (placed["bucket"] == totals["bucket"])
    return placed.join(totals, same).select("doc_id", placed["source"], "size", (F.col("before") + F.col("inner")).alias("pos"))


def schedule(targets: DataFrame, block_words: int) -> DataFrame:
    """slot, source, block: the first slots of each source, ranked, until its target is met."""
    spark = targets.sparkSession
    upto = Window.orderBy(F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    quota = targets.select("source", F.ceil(F.round("target") / block_words).cast("long").alias("quota")).filter("quota > 0")
    quota = quota.withColumn("before", F.sum("quota").over(upto) - F.col("quota")).withColumn("all", F.sum("quota").over(Window.partitionBy(F.lit(1))))
    n = int(quota.agg(F.coalesce(F.sum("quota"), F.lit(0))).first()[0])
    edge = lambda q: F.floor(q * F.lit(float(CIRCLE)) / F.col("all")).cast("long")
    arcs = quota.select("source", "quota", edge(F.col("before")).alias("low"), edge(F.col("before") + F.col("quota")).alias("high"))
    width = CIRCLE // _BINS
    arcs = arcs.withColumn("bin", F.explode(F.sequence(F.floor(F.col("low") / width).cast("long"), F.floor((F.col("high") - 1) / width).cast("long"))))
    slots = spark.range(_OVERSHOOT * n).select(F.col("id").alias("slot"), (((F.col("id") + 1) % CIRCLE) * F.lit(GOLDEN_STEP) % CIRCLE).alias("point"))
    slots = slots.withColumn("bin", F.floor(F.col("point") / width).cast("long"))
    mapped = slots.join(arcs, "bin").filter("point >= low and point < high").withColumn("chunk", F.floor(F.col("slot") / _SLOT_CHUNK).cast("long"))
    counts = mapped.groupBy("source", "chunk").agg(F.count(F.lit(1)).alias("n"))
    chunks = Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = counts.select(F.col("source").alias("s"), F.col("chunk").alias("c"), (F.sum("n").over(chunks) - F.col("n")).alias("earlier"))
    within = Window.partitionBy("source", "chunk").orderBy("slot")
    ranked = mapped.withColumn("inner", F.row_number().over(within) - 1)
    ranked = ranked.join(counts, ranked["source"].eqNullSafe(counts["s"]) & (ranked["chunk"] == counts["c"]))
    return ranked.withColumn("block", F.col("earlier") + F.col("inner")).filter("block < quota").select("slot", "source", "block")


def mix(docs: DataFrame, *, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, max_repeats: int = 2, block_words: int = 1024, seed: int = 0) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents, targets, pieces) of the mix of ``docs`` (doc_id, source, text).

    documents: doc_id, source, size. targets: see ``source_targets``. pieces: slot, source,
    doc_id, size, turn, start, n_words: the words that a slot takes of a document, in one row for each
    document that its block touches; ``turn`` counts the passes over the source. Sorting by slot gives the mix.
    """
    bounded_batches(docs.sparkSession)
    sized = saved(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "mix-sizes")
    targets = saved(source_targets(sized, weights, share, max_repeats), "mix-targets", narrow=True)
    plan = schedule(targets, block_words)
    stream = stream_positions(sized.filter("size > 0"), seed)
    t = targets.select(F.col("source").alias("t_source"), "source_size", F.round("target").cast("long").alias("words"))
    stream = stream.join(t, F.col("source").eqNullSafe(F.col("t_source")))
    stream = stream.withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(max_repeats - 1)))).withColumn("at", F.col("pos") + F.col("turn") * F.col("source_size"))
    stream = stream.withColumn("stop", F.least(F.col("at") + F.col("size"), F.col("words"))).filter("at < stop")
    first, last = F.floor(F.col("at") / block_words).cast("long"), F.floor((F.col("stop") - 1) / block_words).cast("long")
    stream = stream.withColumn("block", F.explode(F.sequence(first, last)))
    start, end = F.greatest(F.col("at"), F.col("block") * block_words), F.least(F.col("stop"), (F.col("block") + 1) * block_words)
    cut = stream.select(F.col("source").alias("d_source"), F.col("block").alias("d_block"), "doc_id", "size", "turn", (start - F.col("at")).alias("start"), (end - start).alias("n_words"))
    # the stream's own salt: a source's blocks are spread over tasks because the block is part of the key
    pieces_ = plan.join(cut, plan["source"].eqNullSafe(F.col("d_source")) & (F.col("block") == F.col("d_block")))
    return sized, targets, pieces_.select("slot", "source", "doc_id", "size", "turn", "start", "n_words")


def placements(docs: DataFrame, **options) -> tuple[DataFrame, int]:
    """(doc_id, size, turn, slot of the document for each pass of the mix that takes half of its words or more; slots in all)."""
    _, targets, taken = mix(docs, **options)
    placed = taken.groupBy("doc_id", "size", "turn").agg(F.min("slot").alias("slot"), F.sum("n_words").alias("n_words")).filter(F.col("n_words") * 2 >= F.col("size"))
    placed = saved(placed.drop("n_words"), "mix-slots", narrow=True)
    return placed, int(placed.agg(F.coalesce(F.max("slot"), F.lit(0))).first()[0]) + 1


def taken_words(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source, source_size, target, taken, slot of every row of ``docs``; slot is the first that takes a word of it.

    Repeated rows with one doc_id share their words evenly by size, the first of them by order.
    """
    sized, targets, taken = mix(docs, **options)
    taken = taken.groupBy(F.col("doc_id").alias("p_id"), F.col("source").alias("p_source"), F.col("size").alias("p_size")).agg(F.sum("n_words").alias("taken"), F.min("slot").alias("slot"))
    copies = Window.partitionBy("doc_id", "source", "size")
    numbered = sized.withColumn("copy", F.row_number().over(copies.orderBy("doc_id"))).withColumn("copies", F.count(F.lit(1)).over(copies))
    t = targets.withColumnRenamed("source", "t_source")
    out = numbered.join(t, F.col("source").eqNullSafe(F.col("t_source")))
    out = out.join(taken, F.col("doc_id").eqNullSafe(F.col("p_id")) & F.col("source").eqNullSafe(F.col("p_source")) & (F.col("size") == F.col("p_size")), "left")
    words_ = F.coalesce(F.col("taken"), F.lit(0))
    each = F.floor(words_ / F.col("copies")).cast("long")
    return out.select("doc_id", "size", "source", "source_size", "target", (each + F.when(F.col("copy") <= words_ - each * F.col("copies"), 1).otherwise(0)).cast("long").alias("taken"), "slot")
