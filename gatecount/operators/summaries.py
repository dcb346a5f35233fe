"""Summary views: members with their history, events with their tickets, artists with their events.

Facts are aggregated before they are joined, so each join is on a key that is unique on one side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import rounded
from .merges import shuffled


def _count(condition: Column) -> Column:
    return F.sum(F.when(condition, 1).otherwise(0))


def member_profile(member: DataFrame, history: DataFrame, social: DataFrame) -> DataFrame:
    """Members with tickets_total, tickets_used, use_rate (null without tickets), last_used_at and friends_count."""
    own = history.groupBy("member_id").agg(F.count(F.lit(1)).alias("total"), _count(F.col("used")).alias("used_n"), F.max(F.when(F.col("used"), F.col("date_used"))).alias("last_used_at"))
    out = member.join(shuffled(own), "member_id", "left").join(shuffled(social), "member_id", "left")
    total, used = F.coalesce("total", F.lit(0)), F.coalesce("used_n", F.lit(0))
    return out.select(
        *member.columns,
        total.alias("tickets_total"),
        used.alias("tickets_used"),
        rounded(used / F.nullif(total, F.lit(0)), 4).alias("use_rate"),
        "last_used_at",
        F.coalesce("friends_count", F.lit(0)).alias("friends_count"),
    )


def event_summary(event: DataFrame, artist: DataFrame, ticket: DataFrame) -> DataFrame:
    """Events with their artist's name, tickets sold, attendance (null while upcoming or unlabelled) and revenue."""
    own = ticket.groupBy("event_id").agg(F.count(F.lit(1)).alias("sold"), F.count("checked_in").alias("labelled"), _count(F.col("checked_in")).alias("entered"), F.sum("price").alias("revenue"))
    out = event.join(artist.select("artist_id", F.col("name").alias("artist_name")), "artist_id").join(own, "event_id", "left")
    closed = ~F.col("is_upcoming") & (F.coalesce("labelled", F.lit(0)) > 0)
    return out.select(
        "event_id",
        "artist_id",
        "artist_name",
        "city",
        "venue",
        "weekday",
        "is_residency",
        "is_upcoming",
        "month",
        "capacity",
        F.coalesce("sold", F.lit(0)).alias("tickets_sold"),
        F.when(closed, F.col("entered")).alias("checked_in_count"),
        F.when(closed, rounded(F.col("entered") / F.col("sold"), 4)).alias("attendance_rate"),
        rounded(F.coalesce("sold", F.lit(0)) / F.nullif(F.col("capacity"), F.lit(0)), 4).alias("fill_rate"),
        F.coalesce("revenue", F.lit(0)).alias("gross_revenue"),
    )


def artist_summary(artist: DataFrame, summary: DataFrame) -> DataFrame:
    """Artists with past and upcoming events and their attendance over past, labelled tickets."""
    past = ~F.col("is_upcoming") & F.col("checked_in_count").isNotNull()
    own = summary.groupBy("artist_id").agg(
        _count(~F.col("is_upcoming")).alias("past_n"),
        _count(F.col("is_upcoming")).alias("upcoming_n"),
        F.sum(F.when(past, F.col("checked_in_count"))).alias("entered"),
        F.sum(F.when(past, F.col("tickets_sold"))).alias("sold"),
    )
    out = artist.join(own, "artist_id", "left")
    return out.select("artist_id", "name", F.coalesce("past_n", F.lit(0)).alias("past_events"), F.coalesce("upcoming_n", F.lit(0)).alias("upcoming_events"), rounded(F.col("entered") / F.nullif(F.col("sold"), F.lit(0)), 4).alias("attendance_rate"))
