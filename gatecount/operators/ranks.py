"""Quantiles and running sums of groups of any size: nothing here orders a whole group in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..stored import once

BINS = 1 << 14


def _position(value, low, high):
    """The bin of a value between two others: rises with the value, 0 to ``BINS`` - 1; 0 if they are equal."""
    share = F.when(high > low, (value - low) / (high - low)).otherwise(0.0)
    return F.least(F.floor(share * BINS), F.lit(BINS - 1)).cast("int")


def _bent(value):
    """A scale on which values of all magnitudes get bins: rises with the value."""
    return F.signum(value) * F.log1p(F.abs(value))


def _with_target(bins: DataFrame, targets: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Of the bins of each group and target (rank from 0 within the keys), the one that holds the rank, and the rank in it.

    ``bins``: keys, order, n and more. ``targets``: keys, p, side, rank. Windows run over at most ``BINS`` rows.
    """
    before = F.sum("n").over(Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n")
    placed = bins.withColumn("_before", before).join(F.broadcast(targets), keys)  # groups times probabilities rows
    return placed.filter((F.col("rank") >= F.col("_before")) & (F.col("rank") < F.col("_before") + F.col("n"))).withColumn("rank", F.col("rank") - F.col("_before")).drop("_before")


def quantiles(values: DataFrame, group: str, value: str, probabilities: list[float]) -> DataFrame:
    """group, n, q: the exact quantiles, linear between neighbours, of each group's numbers; nulls don't count.

    Two passes count rows in bins: first over the whole range, bent so that outliers don't empty the rest, then within the bins
    that hold a wanted rank, between the least and greatest value met there. What is left, the distinct values of one bin of a bin, is
    counted exactly. A rank is found by sums of counts, so the result is that of sorting. Meant for groups that are few and large.
    """
    rows = values.select(F.col(group).alias("g"), F.col(value).cast("double").alias("v")).filter("v is not null")
    ends = once(rows.groupBy("g").agg(F.count(F.lit(1)).alias("total"), F.min("v").alias("low"), F.max("v").alias("high")))
    asked = ends.select("g", F.explode(F.array(*map(F.lit, probabilities))).alias("p"), "total").withColumn("h", F.col("p") * (F.col("total") - 1))
    sides = F.array(F.struct(F.lit(0).alias("side"), F.floor("h").alias("rank")), F.struct(F.lit(1).alias("side"), F.ceil("h").alias("rank")))
    targets = asked.select("g", "p", F.inline(sides))

    coarse = rows.join(F.broadcast(ends), "g").select("g", "v", _position(_bent(F.col("v")), _bent(F.col("low")), _bent(F.col("high"))).alias("b"))
    counted = coarse.groupBy("g", "b").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
    first = once(_with_target(counted, targets, ["g"], "b"))
    held = first.select("g", "b", "low", "high").distinct()
    fine = coarse.join(F.broadcast(held), ["g", "b"]).withColumn("c", _position(F.col("v"), F.col("low"), F.col("high")))
    counted = fine.groupBy("g", "b", "c").agg(F.count(F.lit(1)).alias("n"))
    second = once(_with_target(counted, first.select("g", "b", "p", "side", "rank"), ["g", "b"], "c"))
    last = fine.join(F.broadcast(second.select("g", "b", "c").distinct()), ["g", "b", "c"]).groupBy("g", "b", "c", "v").agg(F.count(F.lit(1)).alias("n"))
    found = _with_target(last, second.select("g", "b", "c", "p", "side", "rank"), ["g", "b", "c"], "v")
    pair = found.groupBy("g", "p").agg(F.max(F.when(F.col("side") == 0, F.col("v"))).alias("a"), F.max(F.when(F.col("side") == 1, F.col("v"))).alias("z"))
    between = asked.join(pair, ["g", "p"]).withColumn("q", F.col("a") + (F.col("h") - F.floor("h")) * (F.col("z") - F.col("a")))
    rank = F.array_position(F.array(*map(F.lit, probabilities)), F.col("p"))
    listed = between.groupBy("g").agg(F.max("total").alias("n"), F.array_sort(F.collect_list(F.struct(rank.alias("k"), "q"))).alias("q"))  # one item a probability
    return listed.select(F.col("g").alias(group), "n", F.transform("q", lambda x: x["q"]).alias("q"))


def running_sums(rows: DataFrame, group: str, order: str, value: str) -> DataFrame:
    """``rows`` with ``before``: the sum of ``value`` over the rows of the group that come first; (group, order) occurs once.

    Rows are cut into ranges of (group, order). A range's own sums are windows over the range; what stands before a range is
    a running sum over one row a range. So a group with very many rows is spread over all tasks.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = once(rows.repartitionByRange(parts, group, order).withColumn("_part", F.spark_partition_id()))
    sums = ranged.groupBy(group, "_part").agg(F.sum(value).alias("_sum"))
    up_to = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(group, "_part", F.coalesce(F.sum("_sum").over(up_to), F.lit(0)).alias("_earlier"))
    inside = Window.partitionBy(group, "_part").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    own = F.coalesce(F.sum(value).over(inside), F.lit(0))
    return ranged.join(F.broadcast(sums), [group, "_part"]).withColumn("before", F.col("_earlier") + own).drop("_part", "_earlier")
