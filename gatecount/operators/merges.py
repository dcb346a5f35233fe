"""Joins that check what they assume, inside their own plan: unique keys, and a partner for every row.

No job counts anything beforehand. A side that must be unique is aggregated by the key, and a group of more than one row raises
an error when it is met; a row without a partner raises one when it leaves the join. Both come with the key that is at fault.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ONE_TO_ONE, MANY_TO_ONE = "one_to_one", "many_to_one"


def shuffled(df: DataFrame) -> DataFrame:
    """``df``, a side that grows with the data, for joins that sort and merge.

    Left alone, Spark broadcasts a table by its compressed size: 4 MB of Parquet with 900,000 members are 74 MB in the driver, a join.
    """
    return df.hint("merge")


class _Message:
    @staticmethod
    def of(text: str, on: list[str]) -> Column:
        return F.concat(F.lit(f"{text}: "), F.concat_ws(", ", *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in on]))


def _refuse(broken: Column, message: Column) -> Column:
    """True where nothing is broken; raises where it is, so that a filter on it drops no row."""
    return F.when(F.coalesce(broken, F.lit(False)), F.raise_error(message).cast("boolean")).otherwise(F.lit(True))


def _grouped(df: DataFrame, on: list[str], name: str) -> DataFrame:
    """One row a key, with ``_n``, how often it occurs; the plan raises where that is more than once."""
    rest = [c for c in df.columns if c not in on]
    for c in on:
        df = df.filter(F.col(c).isNotNull())
    row = F.first(F.struct(*rest)) if rest else F.first(F.lit(True))
    once = df.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"), row.alias("_row"))
    once = once.filter(_refuse(F.col("_n") > 1, _Message.of(f"{name} repeats a key", on)))
    return once.select(*on, "_n", *([f"_row.{c}" for c in rest]))


def unique(df: DataFrame, on: list[str], name: str = "table") -> DataFrame:
    """``df``, whose rows have keys of their own; a key that occurs twice is an error. Rows without a key never meet a partner and are left out."""
    return _grouped(df, on, name).drop("_n")


def merge(left: DataFrame, right: DataFrame, on: list[str], *, validate: str = MANY_TO_ONE, complete: bool = False, name: str = "right side") -> DataFrame:
    """Every row of ``left`` with its one partner of ``right``, or nulls.

    ``validate``: keys of the right side occur once, for ``one_to_one`` those of the left too. ``complete``: a row without a
    partner is an error. Nulls of a key meet nothing.
    """
    if validate not in (ONE_TO_ONE, MANY_TO_ONE):
        raise ValueError(validate)
    clash = (set(left.columns) & set(right.columns)) - set(on)
    if clash:
        raise ValueError(f"both sides have {', '.join(sorted(clash))}")
    if validate == ONE_TO_ONE:
        left = unique(left, on, "left side")
    out = left.join(shuffled(_grouped(right, on, name)), on, "left")
    broken = F.col("_n").isNull() if complete else F.col("_n") > 1  # read above the join, which so can't be left out where only the left side is asked for
    return out.filter(_refuse(broken, _Message.of(f"{name} lacks a key", on))).drop("_n")
