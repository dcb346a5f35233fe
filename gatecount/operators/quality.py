"""Data quality: profiles, quarantine with reasons, integrity, reconciliation, leakage, splits, checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import rounded
from ..stored import once
from .ranks import quantiles


def blanks(df: DataFrame) -> DataFrame:
    """column_name, blanks: null or blank cells of every column, in one pass."""
    counted = df.agg(*[F.sum(F.when(F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) == "", 1).otherwise(0)).alias(c) for c in df.columns])
    return counted.unpivot([], df.columns, "column_name", "blanks")


def numeric_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """column_name, n, n_distinct, low, q1, median, q3, high, outliers of numbers; outliers lie beyond 1.5 quartile ranges."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot([], columns, "column_name", "value").filter("value is not null")
    stats = long.groupBy("column_name").agg(F.count_distinct("value").alias("n_distinct"), F.min("value").alias("low"), F.max("value").alias("high"))
    stats = stats.join(quantiles(long, "column_name", "value", [0.25, 0.5, 0.75]), "column_name")
    stats = stats.select("column_name", "n", "n_distinct", "low", F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"), "high")
    stats = once(stats)
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    beyond = long.join(F.broadcast(stats), "column_name").filter((F.col("value") < F.col("q1") - reach) | (F.col("value") > F.col("q3") + reach))
    return stats.join(beyond.groupBy("column_name").agg(F.count(F.lit(1)).alias("o")), "column_name", "left").select(*stats.columns, F.coalesce("o", F.lit(0)).alias("outliers"))


def categories(df: DataFrame, columns: list[str], least: int = 2, most: int = 20) -> DataFrame:
    """column_name, value, n of columns with ``least`` to ``most`` distinct values."""
    long = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot([], columns, "column_name", "value")
    counts = long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    kinds = counts.groupBy("column_name").agg(F.count(F.lit(1)).alias("kinds")).filter(F.col("kinds").between(least, most))
    return counts.join(F.broadcast(kinds), "column_name", "left_semi")


def exact_duplicates(df: DataFrame) -> DataFrame:
    """Whole rows once."""
    return df.distinct()


def key_quarantine(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """``df`` with quality_issue: rows without a key, and all rows of a key but the first in a declared order."""
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    missing = F.lit(False)
    for k in key:
        missing = missing | F.col(k).isNull()
    return df.withColumn("_rank", rank).withColumn("quality_issue", F.when(missing, "MISSING_KEY").when(F.col("_rank") > 1, "DUPLICATE_KEY")).drop("_rank")


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """``child`` with quality_issue where the parent is missing."""
    known = parent.select(F.col(parent_key).alias("_parent")).distinct()
    return child.join(known, F.col(key) == F.col("_parent"), "left").withColumn("quality_issue", F.when(F.col("_parent").isNull(), F.lit(f"ORPHAN_{key.upper()}"))).drop("_parent")


def key_mismatch(ticket: DataFrame, sale: DataFrame) -> DataFrame:
    """Tickets whose event is not their sale's."""
    own = sale.select("sale_id", F.col("event_id").alias("sale_event_id"))
    return ticket.join(own, "sale_id").filter(F.col("event_id") != F.col("sale_event_id"))


def reconcile_sales(sale: DataFrame, ticket: DataFrame) -> DataFrame:
    """Sales with quantity and subtotal as their tickets have them, and what was corrected."""
    own = ticket.groupBy("sale_id").agg(F.count(F.lit(1)).alias("n"), F.sum("price").alias("total"))
    out = sale.join(own, "sale_id", "left")
    n, total = F.coalesce("n", F.lit(0)), F.coalesce("total", F.lit(0))
    return out.select("sale_id", n.alias("qty"), total.alias("subtotal"), (F.col("qty") != n).alias("qty_corrected"), (F.col("subtotal") != total).alias("subtotal_corrected"))


def reconcile_events(event: DataFrame, ticket: DataFrame) -> DataFrame:
    """Events with sold, revenue, fill, whether all tickets are labelled, and attendance if so."""
    own = ticket.groupBy("event_id").agg(
        F.count(F.lit(1)).alias("sold"), F.sum("price").alias("revenue"), F.sum(F.when(F.col("checked_in"), 1).otherwise(0)).alias("entered"), F.bool_and(F.col("checked_in").isNotNull()).alias("whole")
    )
    out = event.join(own, "event_id", "left")
    sold, whole = F.coalesce("sold", F.lit(0)), F.coalesce("whole", F.lit(False))
    return out.select(
        "event_id", sold.alias("tickets_sold"), F.coalesce("revenue", F.lit(0)).alias("gross_revenue"), rounded(sold / F.nullif(F.col("capacity"), F.lit(0)), 4).alias("fill_rate"),
        whole.alias("fully_labelled"), F.when(whole, F.col("entered")).alias("checked_in_count"), F.when(whole, rounded(F.col("entered") / F.col("sold"), 4)).alias("attendance_rate"),
    )


def reconcile_artists(artist: DataFrame, events: DataFrame) -> DataFrame:
    """Artists with how many events they have, how many are labelled, and tickets sold."""
    own = events.groupBy("artist_id").agg(F.count(F.lit(1)).alias("n"), F.sum(F.when(F.col("checked_in_count").isNotNull(), 1).otherwise(0)).alias("labelled"), F.sum("tickets_sold").alias("sold"))
    return artist.join(own, "artist_id", "left").select("artist_id", F.coalesce("n", F.lit(0)).alias("events"), F.coalesce("labelled", F.lit(0)).alias("labelled_events"), F.coalesce("sold", F.lit(0)).alias("tickets_sold"))


def leak_flags(history: DataFrame, as_of: str, mature_until: str) -> DataFrame:
    """History with future_use (used after ``as_of``), mature (created by ``mature_until``) and eligible."""
    leak = F.coalesce(F.col("date_used") > F.lit(as_of).cast("timestamp_ntz"), F.lit(False))
    mature = F.coalesce(F.col("created_at") <= F.lit(mature_until).cast("timestamp_ntz"), F.lit(False))
    return history.withColumns({"future_use": leak, "mature": mature, "eligible": mature & ~leak})


def safe_history(flagged: DataFrame) -> DataFrame:
    """Per member: eligible tickets, used ones, their rate (0 without any), last use and leaks, in one aggregation."""
    used = F.col("eligible") & F.col("used")
    own = flagged.groupBy("member_id").agg(
        F.sum(F.col("eligible").cast("int")).alias("tickets_total"), F.sum(used.cast("int")).alias("tickets_used"), F.max(F.when(used, F.col("date_used"))).alias("last_used_at"), F.sum(F.col("future_use").cast("int")).alias("leaks")
    )
    return own.withColumn("use_rate", F.coalesce(rounded(F.col("tickets_used") / F.nullif(F.col("tickets_total"), F.lit(0)), 4), F.lit(0.0))).withColumn("history_available", F.col("tickets_total") > 0)


def leak_report(flagged: DataFrame) -> DataFrame:
    """One row on uses in the future: rows, members, first and last."""
    return flagged.filter("future_use").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("member_id").alias("members"), F.min("date_used").alias("first_use"), F.max("date_used").alias("last_use"))


def leak_examples(flagged: DataFrame, key: str, n: int = 10) -> DataFrame:
    """The first ``n`` uses in the future by key, for a report."""
    return flagged.filter("future_use").orderBy(key).limit(n)


def train_score_split(ticket: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Labelled tickets, and unlabelled ones without the target columns."""
    return ticket.filter(F.col("checked_in").isNotNull()), ticket.filter(F.col("checked_in").isNull()).drop("checked_in", "checked_in_at")


def sale_issue(channels: tuple[str, ...]) -> Column:
    """The first rule that a sale breaks, or null."""
    return (
        F.when(F.col("sale_id").isNull(), "MISSING_KEY")
        .when(F.col("event_id").isNull(), "MISSING_EVENT")
        .when(~F.coalesce(F.col("qty") >= 1, F.lit(False)), "BAD_QUANTITY")
        .when(~F.coalesce(F.col("subtotal") >= 0, F.lit(False)), "BAD_SUBTOTAL")
        .when(~F.coalesce(F.col("channel").isin(*channels), F.lit(False)), "BAD_CHANNEL")
        .when(F.col("purchased_at").isNull(), "MISSING_DATE")
    )


def ticket_issue(types: tuple[str, ...]) -> Column:
    """The first rule that a ticket breaks, or null; a label needs no entry time, an entry time needs a label of yes."""
    return (
        F.when(F.col("sale_id").isNull() | F.col("event_id").isNull(), "MISSING_PARENT")
        .when(~F.coalesce(F.col("ticket_type").isin(*types), F.lit(False)), "BAD_TYPE")
        .when(~F.coalesce(F.col("price") >= 0, F.lit(False)), "BAD_PRICE")
        .when(F.col("checked_in_at").isNotNull() & ~F.coalesce(F.col("checked_in"), F.lit(False)), "ENTRY_WITHOUT_LABEL")
    )


def checks(**conditions: tuple[DataFrame, Column]) -> DataFrame:
    """check, passed, failing: how many rows of each frame break its condition."""
    out = None
    for name, (df, holds) in conditions.items():
        one = df.agg(F.coalesce(F.sum(F.when(F.coalesce(holds, F.lit(False)), 0).otherwise(1)), F.lit(0)).alias("failing")).select(F.lit(name).alias("check"), (F.col("failing") == 0).alias("passed"), "failing")
        out = one if out is None else out.unionByName(one)
    if out is None:
        raise ValueError("no checks")
    return out
