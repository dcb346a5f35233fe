"""Attendance analytics: rates, lift, dispersion, regression, cuts, arrivals, histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import arrival_bucket, rounded
from ..schema import TICKET_TYPES

#: Fixed value: tickets of prior weight in a shrunken lift.
SHRINK = 120.0


def _ratio(a: Column, b: Column) -> Column:
    return rounded(a / F.greatest(b, F.lit(1)), 4)


def rate_by_type(ticket: DataFrame) -> DataFrame:
    """ticket_type, issued, attended, rate over past events, for every type."""
    types = ticket.sparkSession.createDataFrame([(t,) for t in TICKET_TYPES], "ticket_type string")
    own = ticket.groupBy("ticket_type").agg(F.count(F.lit(1)).alias("issued"), F.sum(F.when(F.col("checked_in"), 1).otherwise(0)).alias("attended"))
    out = F.broadcast(types).join(own, "ticket_type", "left").fillna(0, ["issued", "attended"])
    return out.withColumn("rate", _ratio(F.col("attended"), F.col("issued")))


def rate_by(df: DataFrame, key: str, hit: Column) -> DataFrame:
    """key, n, hits, rate."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.sum(F.when(hit, 1).otherwise(0)).alias("hits")).withColumn("rate", _ratio(F.col("hits"), F.col("n")))


def event_rows(event: DataFrame, ticket: DataFrame, rates: DataFrame) -> DataFrame:
    """Past events with mix, attendance, what their mix would let expect, binomial variance and lift."""
    own = ticket.groupBy("event_id", "ticket_type").agg(F.count(F.lit(1)).alias("n"), F.sum(F.when(F.col("checked_in"), 1).otherwise(0)).alias("entered"))
    r = F.col("rate")
    own = own.join(F.broadcast(rates.select("ticket_type", "rate")), "ticket_type").groupBy("event_id").agg(
        F.sum("n").alias("issued"), F.sum("entered").alias("attended"), F.sum(F.when(F.col("ticket_type") == TICKET_TYPES[3], F.col("n")).otherwise(0)).alias("courtesy"),
        F.sum(F.col("n") * r).alias("expected"), F.sum(F.col("n") * r * (1 - r)).alias("variance"),
    )
    out = event.join(own, "event_id").withColumn("mix_expected", rounded(F.col("expected"), 4))
    return out.withColumns({"attendance_rate": _ratio(F.col("attended"), F.col("issued")), "courtesy_share": _ratio(F.col("courtesy"), F.col("issued")), "lift": F.when(F.col("mix_expected") > 0, rounded(F.col("attended") / F.col("mix_expected"), 4))}).drop("expected")


def lift_by(rows: DataFrame, keys: list[str], shrink: float = SHRINK) -> DataFrame:
    """dimension, key, events, raw and shrunken lift, for all keys in one pass over unpivoted rows."""
    long = rows.select(*[F.col(k).cast("string").alias(k) for k in keys], "attended", "mix_expected").unpivot(["attended", "mix_expected"], keys, "dimension", "key").filter("key is not null")
    own = long.groupBy("dimension", "key").agg(F.count(F.lit(1)).alias("events"), F.sum("attended").alias("a"), F.sum("mix_expected").alias("e"))
    return own.select("dimension", "key", "events", _ratio(F.col("a"), F.col("e")).alias("raw"), rounded((F.col("a") + shrink) / (F.col("e") + shrink), 4).alias("lift"))


def overdispersion(rows: DataFrame, least_issued: int = 20) -> DataFrame:
    """One row: events, phi = max(1, mean squared residual over binomial variance)."""
    phi = F.when(F.col("variance") > 0, (F.col("attended") - F.col("mix_expected")) ** 2 / F.col("variance")).otherwise(1.0)
    return rows.filter(F.col("issued") >= least_issued).agg(F.count(F.lit(1)).alias("events"), rounded(F.greatest(F.lit(1.0), F.coalesce(F.avg(phi), F.lit(0.0))), 4).alias("phi"))


def dilution(rows: DataFrame, y: str, x: str = "courtesy_share", least_issued: int = 20) -> DataFrame:
    """One row: least squares of ``y`` on ``x``; 0 where x or y does not vary."""
    grid = lambda c: F.rint(F.coalesce(c, F.lit(0.0)) * 1e6) / F.lit(1e6)
    c, d = F.col(y), F.col(x)
    out = rows.filter((F.col("issued") >= least_issued) & c.isNotNull())
    return out.agg(F.count(F.lit(1)).alias("n"), grid(F.regr_slope(c, d)).alias("slope"), grid(F.coalesce(F.regr_intercept(c, d), F.avg(c))).alias("intercept"), grid(F.regr_r2(c, d)).alias("r2"))


def cuts(rows: DataFrame, keys: list[str]) -> DataFrame:
    """dimension, key, events, issued, attended, capacity, courtesy, rate, fill, courtesy share."""
    measures = ["issued", "attended", "capacity", "courtesy"]
    long = rows.select(*[F.col(k).cast("string").alias(k) for k in keys], *measures).unpivot(measures, keys, "dimension", "key")
    own = long.groupBy("dimension", "key").agg(F.count(F.lit(1)).alias("events"), *[F.sum(F.coalesce(m, F.lit(0))).alias(m) for m in measures])
    return own.withColumns({"rate": _ratio(F.col("attended"), F.col("issued")), "fill": _ratio(F.col("issued"), F.col("capacity")), "courtesy_share": _ratio(F.col("courtesy"), F.col("issued"))})


def top(df: DataFrame, n: int, by: str, key: str) -> DataFrame:
    return df.orderBy(F.desc(by), F.asc(key)).limit(n)


def in_word_order(df: DataFrame, column: str, words: tuple[str, ...]) -> DataFrame:
    """``df`` with ``place`` and in its order: the place of a word in a list from 1, other words after all of them."""
    place = F.array_position(F.array(*map(F.lit, words)), F.col(column))
    return df.withColumn("place", F.coalesce(F.nullif(place, F.lit(0)), F.lit(len(words) + 1)).cast("int")).orderBy("place", column)


def fullest(summary: DataFrame, n: int) -> DataFrame:
    """The ``n`` events that sold the most of their room, then those that begin first; top of partitions, then of those."""
    return summary.orderBy(F.desc_nulls_last("fill_rate"), F.asc_nulls_last("starts_at"), F.asc("event_id")).limit(n)


def channel_cut(ticket: DataFrame, sale: DataFrame) -> DataFrame:
    return rate_by(ticket.join(sale.select("sale_id", "channel"), "sale_id"), "channel", F.col("checked_in"))


def arrival_curve(minutes: DataFrame) -> DataFrame:
    """minutes, n, share of arrivals in quarters of an hour around the start, ends closed."""
    own = minutes.select(arrival_bucket(F.col("minutes_from_start")).alias("minutes")).groupBy("minutes").agg(F.count(F.lit(1)).alias("n"))
    total = own.agg(F.sum("n").alias("total"))
    return own.join(F.broadcast(total)).select("minutes", "n", _ratio(F.col("n"), F.col("total")).alias("share"))


def histogram(df: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """bin, n of shares from 0 to 1; the last bin is closed, empty bins are there."""
    own = df.filter(F.col(column).isNotNull()).select(F.least(F.floor(F.col(column) * bins), F.lit(bins - 1)).cast("long").alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    return df.sparkSession.range(bins).select(F.col("id").alias("bin")).join(F.broadcast(own), "bin", "left").fillna(0, ["n"])


def totals(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias("events"), *[F.coalesce(F.sum(F.coalesce(m, F.lit(0))), F.lit(0)).alias(m) for m in ("issued", "attended", "capacity", "courtesy")])


def no_shows(rows: DataFrame, ticket: DataFrame) -> DataFrame:
    """One row: no-shows, the share of them that are courtesies, paid over courtesy rate."""
    free = F.col("ticket_type") == TICKET_TYPES[3]
    absent = ~F.coalesce(F.col("checked_in"), F.lit(False))
    n = lambda c: F.sum(F.when(c, 1).otherwise(0))
    own = ticket.join(rows.select("event_id"), "event_id", "left_semi").agg(n(absent).alias("absent"), n(absent & free).alias("free_absent"), n(free).alias("free"), n(~free).alias("paid"))
    paid_rate = (F.col("paid") - F.col("absent") + F.col("free_absent")) / F.nullif(F.col("paid"), F.lit(0))
    free_rate = (F.col("free") - F.col("free_absent")) / F.nullif(F.col("free"), F.lit(0))
    return own.select("absent", rounded(F.col("free_absent") / F.nullif(F.col("absent"), F.lit(0)), 4).alias("courtesy_part"), rounded(paid_rate / F.nullif(free_rate, F.lit(0.0)), 4).alias("rate_ratio"))


def correlation(df: DataFrame, x: str, y: str) -> DataFrame:
    return df.agg((F.rint(F.corr(x, y) * 1e6) / F.lit(1e6)).alias("r"), F.count(F.lit(1)).alias("n"))
