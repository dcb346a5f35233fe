"""What-if projections: levers of free tickets, sweeps, recommendation, staffing, risk.

A projection is a set of column expressions over events with their mix; sweeps explode a grid
of lever values and project all events at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import normal_cdf

#: Normal deviate of the 10 and 90 per cent points; risk limits.
Z90, WARNING, CRITICAL = 1.2816, 0.15, 0.35
LEVERS = ("courtesy", "membership", "consumption", "converted")
PROJECTION = ("expected", "demand", "p10", "p90", "sd", "overflow_risk", "emitted", "fill_rate", "tickets_per_head", "scanners", "security", "peak_quarter", "risk_class", "turned_away")


def half_up(c: Column) -> Column:
    return F.floor(c + 0.5)


def project(events: DataFrame, *, convert_adjusts_baseline: bool = False, peak_share: float = 0.25) -> DataFrame:
    """Events with levers projected.

    Columns read: capacity, n_0..n_3 (general, preferential, VIP, courtesy), rate_0..rate_3,
    rate_membership, rate_consumption, lift, phi, the four LEVERS, and baseline and baseline_sd, which
    take the place of the own estimate where they are not null. Converting courtesies does not
    move a baseline unless ``convert_adjusts_baseline``.
    """
    n, rate = [F.col(f"n_{k}") for k in range(4)], [F.col(f"rate_{k}") for k in range(4)]
    convert = F.least(F.col("converted"), n[3])
    paid_n = n[0] + n[1] + n[2]
    paid_rate = F.when(paid_n > 0, (n[0] * rate[0] + n[1] * rate[1] + n[2] * rate[2]) / paid_n).otherwise(rate[0])
    free = ((F.col("courtesy"), rate[3]), (F.col("membership"), F.col("rate_membership")), (F.col("consumption"), F.col("rate_consumption")))
    issued = (((n[0], rate[0]), (n[1], rate[1]), (n[2], rate[2]), (n[3] - convert, rate[3]), (convert, paid_rate)))
    add = lambda parts: sum((a for a in parts), F.lit(0.0))
    own = add(c * r for c, r in issued) * F.col("lift")
    fixed = F.col("baseline") + (convert * (paid_rate - rate[3]) * F.col("lift") if convert_adjusts_baseline else F.lit(0.0))
    spread = lambda parts: add(c * r * (1 - r) for c, r in parts)
    sd = F.when(F.col("baseline_sd").isNotNull(), F.sqrt(F.col("baseline_sd") ** 2 + spread(free) * F.col("phi"))).otherwise(F.sqrt(F.greatest(spread([*issued, *free]), F.lit(1.0)) * F.col("phi")))
    out = events.withColumn("x_demand", F.coalesce(fixed, own) + add(c * r for c, r in free) * F.col("lift")).withColumn("x_sd", sd)
    demand, cap = F.col("x_demand"), F.col("capacity")
    out = out.withColumn("x_expected", F.least(demand, cap.cast("double"))).withColumn("emitted", add(c for c, _ in [*issued, *free]).cast("long"))
    expected = F.col("x_expected")
    risk = F.when(F.col("x_sd") > 0, 1 - normal_cdf((cap - demand) / F.col("x_sd"))).otherwise(F.when(demand > cap, 1.0).otherwise(0.0))
    out = out.withColumn("overflow_risk", F.rint(risk * 1e6) / F.lit(1e6))
    return out.withColumns(
        {
            "expected": half_up(expected), "demand": half_up(demand), "sd": F.rint(F.col("x_sd") * 1e6) / F.lit(1e6),
            "p10": half_up(F.greatest(F.lit(0.0), F.least(demand - Z90 * F.col("x_sd"), cap.cast("double")))), "p90": half_up(F.least(demand + Z90 * F.col("x_sd"), cap.cast("double"))),
            "fill_rate": F.rint(expected / F.greatest(F.lit(1), cap) * 1e6) / F.lit(1e6), "tickets_per_head": F.rint(F.col("emitted") / F.greatest(F.lit(1.0), expected) * 1e6) / F.lit(1e6),
            **staffing(expected, peak_share), "risk_class": risk_class(F.col("overflow_risk")), "turned_away": half_up(F.greatest(demand - cap, F.lit(0.0))),
        }
    ).drop("x_demand", "x_sd", "x_expected")


def staffing(expected: Column, peak_share: float) -> dict[str, Column]:
    """People at the peak quarter of an hour, scanners (60 people each) and security (120 each)."""
    peak = half_up(expected * max(peak_share, 0.2))
    return {"peak_quarter": peak, "scanners": F.greatest(F.lit(2), F.ceil(peak / 60)), "security": F.greatest(F.lit(1), F.ceil(expected / 120))}


def risk_class(risk: Column) -> Column:
    return F.when(risk > CRITICAL, "critical").when(risk > WARNING, "warning").otherwise("good")


def sweep_volume(events: DataFrame, steps: int = 28, **options) -> DataFrame:
    """Each event over volumes of free tickets at its present split of levers, or courtesies alone without any."""
    free = F.col("courtesy") + F.col("membership") + F.col("consumption")
    most = F.greatest(F.lit(20), F.ceil((F.col("capacity") - F.col("issued")) * 1.4), free + 20)
    out = events.withColumn("x_total", free).withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(steps)))).withColumn("x", half_up(most * F.col("step") / steps))
    part = lambda c, alone: half_up(F.col("x") * F.when(F.col("x_total") > 0, F.col(c) / F.col("x_total")).otherwise(F.lit(alone)))
    return project(out.withColumns({"courtesy": part("courtesy", 1.0), "membership": part("membership", 0.0), "consumption": part("consumption", 0.0)}).drop("x_total"), **options)


def sweep_split(events: DataFrame, steps: int = 20, **options) -> DataFrame:
    """Each event with a budget of free tickets, over the share of it that goes to open courtesies."""
    budget, members = F.col("courtesy") + F.col("membership") + F.col("consumption"), F.col("membership") + F.col("consumption")
    out = events.filter(budget > 0).withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(steps)))).withColumn("x_courtesy", half_up(budget * F.col("step") / steps))
    rest = budget - F.col("x_courtesy")
    first = half_up(rest * F.when(members > 0, F.col("membership") / F.nullif(members, F.lit(0))).otherwise(0.5))
    out = out.withColumns({"x_first": first, "x_rest": rest})
    return project(out.withColumns({"courtesy": F.col("x_courtesy"), "membership": F.col("x_first"), "consumption": F.col("x_rest") - F.col("x_first")}).drop("x_courtesy", "x_first", "x_rest"), **options)


def recommend(events: DataFrame, limit: float = WARNING, **options) -> DataFrame:
    """event_id, best_lever, suggested_free, headroom, gain, risk_at.

    The suggestion is the greatest even number of tickets of the best lever, up to the capacity,
    before the first whose risk of overflow is above ``limit``.
    """
    r = (F.col("rate_3"), F.col("rate_membership"), F.col("rate_consumption"))
    best = F.when((r[0] >= r[1]) & (r[0] >= r[2]), "courtesy").when(r[1] >= r[2], "membership").otherwise("consumption")
    zero = events.withColumn("best_lever", best)
    put = lambda df, n: df.withColumns({c: F.when(F.col("best_lever") == c, n).otherwise(F.lit(0)) for c in LEVERS[:3]})
    grid = project(put(zero.withColumn("n", F.explode(F.sequence(F.lit(0), F.greatest(F.col("capacity"), F.lit(0)), F.lit(2)))), F.col("n")), **options)
    over = F.min(F.when(F.col("overflow_risk") > limit, F.col("n")))
    pick = grid.groupBy("event_id").agg(F.coalesce(F.greatest(over - 2, F.lit(0)), F.max("n")).alias("suggested_free"))
    at = grid.select("event_id", "best_lever", "n", "capacity", "expected", "p90", "overflow_risk").join(pick, "event_id").filter("n = 0 or n = suggested_free")
    base = lambda c: F.max(F.when(F.col("n") == 0, F.col(c)))
    top = lambda c: F.max(F.when(F.col("n") == F.col("suggested_free"), F.col(c)))
    return at.groupBy("event_id", "best_lever", "suggested_free").agg(F.greatest(F.lit(0), F.max("capacity") - base("p90")).alias("headroom"), (top("expected") - base("expected")).alias("gain"), top("overflow_risk").alias("risk_at"))


def override(local: DataFrame, remote: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Local values, replaced by remote ones where there are any, and which it was."""
    other = remote.select(key, *[F.col(c).alias(f"r_{c}") for c in columns])
    out = local.join(other, key, "left")
    return out.select(key, *[F.coalesce(f"r_{c}", c).alias(c) for c in columns], F.when(F.col(f"r_{columns[0]}").isNotNull(), "model").otherwise("local").alias("origin"))


def web_model(forecast: DataFrame) -> DataFrame:
    """event_id, baseline, sd as a front end reads them: half the 10 to 90 range over its normal width, at least 0.1."""
    return forecast.select("event_id", F.col("expected_attendance").alias("baseline"), F.greatest((F.col("p90") - F.col("p10")) / (2 * Z90), F.lit(0.1)).alias("sd"))
