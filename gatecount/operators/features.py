"""Ticket features: event mix, lead times, prices, and member history blended by match uncertainty."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import hours_between
from ..schema import NO_MATCH, TICKET_TYPES
from .merges import ONE_TO_ONE, merge, shuffled

#: What a member's profile adds to a buyer, in order: rates and counts of the past, and what is known of the person.
MEASURES = ("use_rate", "tickets_total", "tickets_used", "membership", "points", "friends_count")


def _grid(c: Column) -> Column:
    return F.rint(c * 1e6) / F.lit(1e6)


def event_mix(ticket: DataFrame) -> DataFrame:
    """event_id, issued, one count and one share for each ticket type, mean price."""
    counts = [F.sum(F.when(F.col("ticket_type") == t, 1).otherwise(0)).alias(f"n_{k}") for k, t in enumerate(TICKET_TYPES)]
    own = ticket.groupBy("event_id").agg(F.count(F.lit(1)).alias("issued"), *counts, F.avg("price").alias("mean_price"))
    return own.select("event_id", "issued", *[f"n_{k}" for k in range(4)], *[_grid(F.col(f"n_{k}") / F.col("issued")).alias(f"share_{k}") for k in range(4)], _grid(F.col("mean_price")).alias("mean_price"))


def lead_features(purchased: Column, starts: Column) -> dict[str, Column]:
    """Hours and days from purchase to start, hour of the day as a fraction, day and week of the month, weekday (Monday 0), weekend."""
    hours = hours_between(starts, purchased)
    return {
        "lead_hours": _grid(hours),
        "lead_days": _grid(hours / 24),
        "start_hour": F.hour(starts) + F.minute(starts) / F.lit(60.0),
        "day_of_month": F.dayofmonth(starts),
        "week_of_month": (F.floor((F.dayofmonth(starts) - 1) / 7) + 1).cast("int"),
        "weekday_number": F.weekday(starts),
        "is_weekend": F.weekday(starts) >= 5,
    }


def weighted_profile(candidates: DataFrame, profile: DataFrame, priors: DataFrame) -> DataFrame:
    """Per sale: weight, and rates blended as sum(w x) + (1 - sum(w)) prior, the sum of weights held to 0..1.

    ``candidates``: sale_id, member_id, model_history_weight. ``profile``: member_id, use_rate, tickets_total.
    ``priors``: one row with the means of both.
    """
    w = F.col("model_history_weight")
    own = candidates.filter(w > 0).join(shuffled(profile), "member_id").groupBy("sale_id").agg(
        F.sum(w).alias("w"), F.sum(w * F.coalesce("use_rate", F.lit(0.0))).alias("x1"), F.sum(w * F.col("tickets_total")).alias("x2"), F.count_distinct("member_id").alias("members"), F.max(w).alias("top")
    )
    held = F.least(F.greatest(F.col("w"), F.lit(0.0)), F.lit(1.0))
    return own.join(F.broadcast(priors)).select("sale_id", _grid(held).alias("history_weight"), _grid(F.col("x1") + (1 - held) * F.col("prior_use_rate")).alias("use_rate"), _grid(F.col("x2") + (1 - held) * F.col("prior_tickets")).alias("tickets_total"), "members", _grid(F.col("top")).alias("top_weight"))


def profile_priors(profile: DataFrame) -> DataFrame:
    """One row: mean use rate of members with tickets, mean tickets."""
    return profile.agg(F.coalesce(F.avg("use_rate"), F.lit(0.0)).alias("prior_use_rate"), F.coalesce(F.avg("tickets_total"), F.lit(0.0)).alias("prior_tickets"))


def measures(profile: DataFrame) -> DataFrame:
    """member_id, the measures as numbers, history_available as 0 or 1."""
    number = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c)
    return profile.select(
        "member_id", *[number(c) for c in ("use_rate", "tickets_total", "tickets_used", "points", "friends_count")],
        F.coalesce(F.col("has_membership").cast("double"), F.lit(0.0)).alias("membership"), (F.coalesce(F.col("tickets_total"), F.lit(0)) > 0).cast("double").alias("history_available"),
    )


def measure_priors(known: DataFrame) -> DataFrame:
    """One row, prior_<measure>: means over all members, of the use rate over those with a past."""
    means = [F.avg(F.when(F.col("history_available") == 1, F.col("use_rate"))) if m == "use_rate" else F.avg(m) for m in MEASURES]
    return known.agg(*[F.coalesce(c, F.lit(0.0)).alias(f"prior_{m}") for m, c in zip(MEASURES, means, strict=True)])


def identity_features(sale: DataFrame, ranked: DataFrame, diagnoses: DataFrame, profile: DataFrame) -> DataFrame:
    """One row for each sale: whom it was matched to and how, how sure that is, and the measures expected of the buyer.

    ``ranked``: candidates with probability and history weight, no-match state included; ``diagnoses``: the accepted member.
    An expected measure is the sum of weight times measure over the candidates, and the prior for the weight that is left;
    use rates weigh only candidates with a past. Every candidate must have a profile, and profiles and diagnoses are unique:
    the joins assert it. Sales without candidates have priors.
    """
    known = measures(profile)
    own = ranked.filter(F.col("member_id") != NO_MATCH).withColumn("member", F.col("member_id").try_cast("bigint"))
    met = merge(own, known.withColumnRenamed("member_id", "member"), ["member"], complete=True, name="profile")
    w = F.col("model_history_weight")
    past = w * F.col("history_available")
    sums = [F.sum((past if m == "use_rate" else w) * F.col(m)).alias(f"sum_{m}") for m in MEASURES]
    blended = met.groupBy("sale_id").agg(F.count_distinct("member").alias("candidates"), F.max("candidate_probability").alias("top_probability"), F.sum(w).alias("identity_weight"), F.sum(past).alias("history_weight"), *sums)
    nobody = ranked.filter(F.col("member_id") == NO_MATCH).select("sale_id", F.col("candidate_probability").alias("no_match_probability"))
    of_match = ranked.select("sale_id", "member_id", F.col("candidate_source").alias("match_source"))
    out = merge(sale.select("sale_id"), blended, ["sale_id"], validate=ONE_TO_ONE)
    out = merge(out, nobody, ["sale_id"], validate=ONE_TO_ONE)
    out = merge(out, diagnoses.select("sale_id", "member_id", "confidence"), ["sale_id"], validate=ONE_TO_ONE, complete=True, name="diagnoses")
    out = merge(out, of_match, ["sale_id", "member_id"]).join(F.broadcast(measure_priors(known)))
    held = lambda c: F.least(F.greatest(F.coalesce(c, F.lit(0.0)), F.lit(0.0)), F.lit(1.0))
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    identity, history = held(F.col("identity_weight")), held(F.col("history_weight"))
    n = F.coalesce("candidates", F.lit(0))
    status = F.when(F.col("member_id") == NO_MATCH, F.when(n == 0, "NEW_OR_UNKNOWN").otherwise("UNRESOLVED_IDENTITY")).when(F.col("match_source").contains("LEARNED_ALIAS"), "ALIAS_PROBABLE").when(F.col("confidence") >= 0.90, "DIRECT_HIGH").otherwise("DIRECT_PROBABLE")
    expected = [_grid(zero(F.col(f"sum_{m}")) + (1 - (history if m == "use_rate" else identity)) * F.col(f"prior_{m}")).alias(f"expected_{m}") for m in MEASURES]
    return out.select(
        "sale_id", "member_id", "confidence", status.alias("match_status"), F.when(F.col("member_id") != NO_MATCH, F.col("match_source")).alias("match_source"), n.alias("candidates"), zero(F.col("top_probability")).alias("top_probability"),
        F.coalesce("no_match_probability", F.lit(1.0)).alias("no_match_probability"), _grid(identity).alias("identity_weight"), _grid(history).alias("history_weight"), *expected,
    )


def training_rows(tickets: DataFrame, sale: DataFrame, event: DataFrame, mix: DataFrame, identity: DataFrame, priors: DataFrame) -> DataFrame:
    """The star of each ticket with what is expected of its buyer, held back by the size of the party.

    Companions are unknown, so an expected measure is prior + (measure - prior) / quantity, and weights are divided by it.
    """
    party = F.greatest(F.coalesce("qty", F.lit(1)), F.lit(1))
    rows = merge(star(tickets, sale, event, mix), identity.drop("member_id", "match_source"), ["sale_id"], name="identity").join(F.broadcast(priors))
    shrunk = {f"expected_{m}": _grid(companion_shrink(F.coalesce(F.col(f"expected_{m}"), F.col(f"prior_{m}")), F.col(f"prior_{m}"), party)) for m in MEASURES}
    weights = {f"ticket_{c}": _grid(F.coalesce(c, F.lit(0.0)) / party) for c in ("identity_weight", "history_weight")}
    return rows.withColumns({**shrunk, **weights}).drop(*[f"prior_{m}" for m in MEASURES])


def companion_shrink(x: Column, prior: Column, quantity: Column) -> Column:
    """A buyer's value held against a party of ``quantity``: prior + (x - prior) / quantity."""
    return prior + (x - prior) / F.greatest(quantity, F.lit(1))


def match_status(matched: Column, weight: Column) -> Column:
    return F.when(matched & (weight >= 0.95), "FIRME").when(matched, "PROBABLE").when(weight > 0, "INCIERTO").otherwise("SIN_HISTORIAL")


def star(ticket: DataFrame, sale: DataFrame, event: DataFrame, mix: DataFrame) -> DataFrame:
    """One feature row for each ticket; dimensions are unique on their keys and grow with the tickets, so none is broadcast."""
    out = ticket.join(shuffled(sale.select("sale_id", "qty", "channel", "purchased_at")), "sale_id", "left")
    out = out.join(shuffled(event.select("event_id", "capacity", "starts_at", "is_residency")), "event_id", "left").join(shuffled(mix), "event_id", "left")
    lead = lead_features(F.col("purchased_at"), F.col("starts_at"))
    return out.select(
        "ticket_id", "event_id", "sale_id", "ticket_type", "channel", "price", "qty", "is_residency", "issued", "share_3",
        _grid(F.when(F.col("mean_price") > 0, F.col("price") / F.col("mean_price")).otherwise(0.0)).alias("price_ratio"),
        (F.col("capacity") - F.col("issued")).alias("remaining_capacity"),
        lead["lead_hours"].alias("lead_hours"), lead["weekday_number"].alias("weekday_number"), lead["is_weekend"].alias("is_weekend"),
    )


def missing_dimensions(ticket: DataFrame, sale: DataFrame, event: DataFrame) -> DataFrame:
    """dimension, rows: tickets that a star join would leave without a sale or an event."""
    lost = lambda df, key: ticket.join(df, key, "left_anti").agg(F.count(F.lit(1)).alias("rows")).select(F.lit(key).alias("dimension"), "rows")
    return lost(sale, "sale_id").unionByName(lost(event, "event_id"))
