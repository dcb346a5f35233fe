"""Entity resolution of sales and members by blocked similarity joins.

No pair is formed by name alone. Contacts are matched on equal keys and on exploded
signatures: deletion signatures for one edit of an e-mail, digit swaps for a phone; both are
equi-joins of distinct contacts with a check after them, never a comparison of all pairs.
Sales, members and all that is made of them grow with the data, so no join broadcasts them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.similarity import deletion_signatures, name_similarity, swap_variants, within_one_edit
from ..schema import NO_MATCH
from .merges import shuffled

#: Least accepted confidence and least lead on the runner-up.
LEAST_CONFIDENCE, LEAST_MARGIN = 0.70, 0.08
#: Slope and centre of the evidence strength.
STRENGTH_SLOPE, STRENGTH_CENTRE = 12.0, 0.75
#: Confidence and weight of a match by one alias and by two.
ALIAS_CONFIDENCE, ALIAS_WEIGHT = (0.82, 0.90), (0.35, 0.55)


def owners(member: DataFrame, key: str) -> DataFrame:
    """key, member_id: of members that share a contact the one with the greatest id owns it."""
    return shuffled(member.filter(F.col(key).isNotNull()).groupBy(key).agg(F.max("member_id").alias("member_id")))


def email_candidates(sale: DataFrame, member: DataFrame) -> DataFrame:
    """sale_id, member_id, email_score: 1.0 for the owner of the address, 0.9 within one edit."""
    left, right = (shuffled(df.filter(F.col("email").isNotNull())) for df in (sale, member))
    exact = left.join(owners(member, "email"), "email").select("sale_id", "member_id", F.lit(1.0).alias("email_score"))

    def signed(df: DataFrame, name: str) -> DataFrame:
        signatures = df.select(F.col("email").alias(name)).distinct().select(name, F.explode(deletion_signatures(F.col(name))).alias("s"))
        return signatures.select(name, F.xxhash64("s").alias("signature"))

    pairs = signed(left, "e1").join(signed(right, "e2"), "signature").select("e1", "e2").distinct().filter(within_one_edit(F.col("e1"), F.col("e2")))
    near = left.select("sale_id", F.col("email").alias("e1")).join(pairs, "e1").join(right.select("member_id", F.col("email").alias("e2")), "e2")
    near = near.select("sale_id", "member_id", F.lit(0.9).alias("email_score"))
    return exact.unionByName(near).groupBy("sale_id", "member_id").agg(F.max("email_score").alias("email_score"))


def phone_candidates(sale: DataFrame, member: DataFrame) -> DataFrame:
    """sale_id, member_id, phone_score: 1.0 for the owner of the number, 0.9 with two digits exchanged."""
    left, own = shuffled(sale.filter(F.col("phone").isNotNull())), owners(member, "phone")
    exact = left.join(own, "phone").select("sale_id", "member_id", F.lit(1.0).alias("phone_score"))
    swapped = left.select("phone").distinct().select(F.col("phone").alias("held"), F.explode(swap_variants(F.col("phone"))).alias("phone")).join(own, "phone")
    near = left.select("sale_id", F.col("phone").alias("held")).join(swapped.drop("phone"), "held").select("sale_id", "member_id", F.lit(0.9).alias("phone_score"))
    return exact.unionByName(near).groupBy("sale_id", "member_id").agg(F.max("phone_score").alias("phone_score"))


def confidence(email: Column, phone: Column, name: Column) -> Column:
    """The decision table over contact and name scores."""
    contacts = (email > 0).cast("int") + (phone > 0).cast("int")
    exact = (email >= 1).cast("int") + (phone >= 1).cast("int")

    def ladder(*steps: tuple[float, float], floor: float) -> Column:
        out = F.lit(floor)
        for least, value in reversed(steps):
            out = F.when(name >= least, value).otherwise(out)
        return out

    return (
        F.when((contacts == 2) & (exact == 2), ladder((0.90, 0.995), (0.75, 0.970), (0.50, 0.900), floor=0.780))
        .when(contacts == 2, ladder((0.90, 0.970), (0.75, 0.940), (0.50, 0.860), floor=0.720))
        .when(exact == 1, ladder((0.95, 0.960), (0.82, 0.910), (0.65, 0.800), floor=0.580))
        .when(contacts == 1, ladder((0.95, 0.920), (0.82, 0.860), (0.65, 0.740), floor=0.450))
        .otherwise(0.0)
    )


def method(email: Column, phone: Column, name: Column) -> Column:
    label = lambda kind, s: F.when(s >= 1, f"{kind}_EXACTO").when(s >= 0.89, f"{kind}_APROX_1_EDICION").when(s > 0, f"{kind}_SIN_EVIDENCIA")
    name_part = F.when(name >= 0.90, "NOMBRE_FUERTE").when(name >= 0.65, "NOMBRE_PARCIAL").otherwise("NOMBRE_CONTRADICE")
    return F.concat_ws("+", label("EMAIL", email), label("TELEFONO", phone), name_part)


def score_candidates(sale: DataFrame, member: DataFrame, ratio: bool = True) -> DataFrame:
    """sale_id, member_id, scores, evidence_confidence, match_method of each candidate pair."""
    pairs = email_candidates(sale, member).join(phone_candidates(sale, member), ["sale_id", "member_id"], "full_outer")
    pairs = pairs.select("sale_id", "member_id", *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("email_score", "phone_score")])
    named = pairs.join(shuffled(sale.select("sale_id", "buyer_name")), "sale_id").join(shuffled(member.select("member_id", "first_name", "last_name")), "member_id")
    named = named.withColumn("name_score", name_similarity(F.col("buyer_name"), F.col("first_name"), F.col("last_name"), ratio))
    e, p, n = F.col("email_score"), F.col("phone_score"), F.col("name_score")
    return named.select("sale_id", "member_id", "email_score", "phone_score", "name_score", confidence(e, p, n).alias("evidence_confidence"), method(e, p, n).alias("match_method"))


def diagnose(sale: DataFrame, scored: DataFrame) -> DataFrame:
    """One row for each sale, with or without candidates: the accepted member or no match, and all that the decision rests on.

    Columns: sale_id, member_id, confidence, match_method, match_weight, decision, candidate_count, exact_email_candidate,
    exact_phone_candidate, exact_contact_conflict, top_candidate, top_raw_confidence, runner_up_candidate,
    runner_up_confidence, runner_up_email_score, runner_up_phone_score, runner_up_name_score, confidence_margin,
    email_score, phone_score, name_score. Candidates are read once: ranks, runner-up and exact owners come from windows
    over the same partitions.
    """
    within = Window.partitionBy("sale_id")
    best = within.orderBy(F.desc("evidence_confidence"), F.desc("name_score"), F.desc(F.col("email_score") + F.col("phone_score")), F.asc("member_id"))
    exact = (F.col("email_score") >= 1).cast("int") + (F.col("phone_score") >= 1).cast("int")
    ranked = scored.withColumn("exact", exact).withColumns(
        {
            "rank": F.row_number().over(best),
            "runner": F.lead(F.struct("member_id", "evidence_confidence", "email_score", "phone_score", "name_score", "exact")).over(best),
            "n": F.count(F.lit(1)).over(within),
            "by_email": F.min(F.when(F.col("email_score") >= 1, F.col("member_id"))).over(within),
            "by_phone": F.min(F.when(F.col("phone_score") >= 1, F.col("member_id"))).over(within),
        }
    )
    out = shuffled(sale.select("sale_id")).join(ranked.filter("rank = 1").drop("rank"), "sale_id", "left")
    c = F.col("evidence_confidence")
    # differences of scores are compared on a grid of 1e-9
    margin = F.rint((c - F.coalesce("runner.evidence_confidence", F.lit(0.0))) * 1e9) / 1e9
    dominates = F.col("runner").isNotNull() & (c >= 0.95) & (F.col("name_score") >= 0.90) & (F.col("exact") > F.col("runner.exact"))
    strong = F.coalesce(c >= LEAST_CONFIDENCE, F.lit(False))
    accepted = strong & (F.col("runner").isNull() | (margin >= LEAST_MARGIN) | dominates)
    decision = F.when(accepted, "MATCH").when(F.col("member_id").isNull(), "SIN_CANDIDATO_DE_CONTACTO").when(~strong, "EVIDENCIA_INSUFICIENTE").otherwise("AMBIGUO")
    named = lambda x: F.coalesce(x.cast("string"), F.lit(NO_MATCH))
    zero = lambda x: F.coalesce(x, F.lit(0.0))
    conflict = F.coalesce(F.col("by_email") != F.col("by_phone"), F.lit(False))
    return out.select(
        "sale_id",
        F.when(accepted, F.col("member_id").cast("string")).otherwise(NO_MATCH).alias("member_id"),
        F.when(accepted, c).otherwise(0.0).alias("confidence"),
        F.when(accepted, F.col("match_method")).otherwise(decision).alias("match_method"),
        F.when(accepted, F.when(c >= 0.95, 1.0).when(c >= 0.90, 0.8).otherwise(0.6)).otherwise(0.0).alias("match_weight"),
        decision.alias("decision"),
        F.coalesce("n", F.lit(0)).alias("candidate_count"),
        named(F.col("by_email")).alias("exact_email_candidate"),
        named(F.col("by_phone")).alias("exact_phone_candidate"),
        conflict.alias("exact_contact_conflict"),
        named(F.col("member_id")).alias("top_candidate"),
        zero(c).alias("top_raw_confidence"),
        named(F.col("runner.member_id")).alias("runner_up_candidate"),
        *[zero(F.col(f"runner.{x}")).alias(f"runner_up_{y}") for x, y in (("evidence_confidence", "confidence"), ("email_score", "email_score"), ("phone_score", "phone_score"), ("name_score", "name_score"))],
        zero(margin).alias("confidence_margin"),
        *[zero(F.col(x)).alias(x) for x in ("email_score", "phone_score", "name_score")],
    )


def decide(sale: DataFrame, scored: DataFrame) -> DataFrame:
    """One row for each sale: the accepted member or no match, confidence, decision, weight, margin and conflict flag."""
    out = diagnose(sale, scored)
    return out.select("sale_id", "member_id", "confidence", "decision", "match_weight", F.col("confidence_margin").alias("margin"), F.col("exact_contact_conflict").alias("exact_conflict"))


def learn_aliases(sale: DataFrame, scored: DataFrame, decided: DataFrame, contact: str) -> DataFrame:
    """name_key, contact, member_id: pairs of name and contact that safe matches tie to one member only."""
    sure = decided.filter((F.col("decision") == "MATCH") & (F.col("confidence") >= 0.95)).select("sale_id", F.col("member_id").try_cast("bigint").alias("member_id"))
    sure = sure.join(shuffled(scored.filter("name_score >= 0.95").select("sale_id", "member_id")), ["sale_id", "member_id"])
    rows = sure.join(shuffled(sale.select("sale_id", "name_key", contact)), "sale_id").filter((F.col("name_key") != "") & F.col(contact).isNotNull())
    return rows.groupBy("name_key", contact).agg(F.count_distinct("member_id").alias("n"), F.min("member_id").alias("member_id")).filter("n = 1").drop("n")


def vote_aliases(sale: DataFrame, decided: DataFrame, emails: DataFrame, phones: DataFrame, scored: DataFrame) -> DataFrame:
    """Of sales without a match: the member that aliases name, signals, confidence, weight and status."""
    open_ = decided.filter(F.col("member_id") == NO_MATCH).select("sale_id", "decision").join(shuffled(sale.select("sale_id", "name_key", "email", "phone")), "sale_id")
    vote = lambda aliases, by, source: open_.join(shuffled(aliases), ["name_key", by]).select("sale_id", "decision", "member_id", F.lit(source).alias("source"))
    votes = vote(emails, "email", "NOMBRE+EMAIL_ALIAS").unionByName(vote(phones, "phone", "NOMBRE+TELEFONO_ALIAS"))
    tally = votes.groupBy("sale_id", "decision").agg(F.count_distinct("member_id").alias("members"), F.min("member_id").alias("member_id"), F.count(F.lit(1)).alias("signals"), F.array_join(F.array_sort(F.collect_set("source")), "+").alias("sources"))
    known = scored.select("sale_id", "member_id", F.lit(True).alias("direct"))
    out = tally.join(shuffled(known), ["sale_id", "member_id"], "left")
    fits = (F.col("decision") == "SIN_CANDIDATO_DE_CONTACTO") | F.coalesce("direct", F.lit(False))
    status = F.when(F.col("members") > 1, "ALIAS_CONTRADICTORIOS").when(~fits, "ALIAS_NO_COMPATIBLE_CON_CANDIDATOS").otherwise("MATCH_ALIAS")
    return out.select("sale_id", F.when(F.col("members") == 1, F.col("member_id")).alias("member_id"), "signals", "sources", F.when(F.col("signals") >= 2, 0.90).otherwise(0.82).alias("evidence_confidence"), F.when(F.col("signals") >= 2, 0.55).otherwise(0.35).alias("source_reliability"), status.alias("status"))


def alias_seeds(sale: DataFrame, diagnosed: DataFrame) -> DataFrame:
    """name_key, email, phone, member_id of the sales whose match is beyond doubt: what aliases are learned from."""
    sure = diagnosed.filter((F.col("decision") == "MATCH") & (F.col("confidence") >= 0.95) & (F.col("name_score") >= 0.95))
    return sure.select("sale_id", F.col("member_id").try_cast("bigint").alias("member_id")).join(shuffled(sale.select("sale_id", "name_key", "email", "phone")), "sale_id").filter(F.col("name_key") != "")


def unique_aliases(seeds: DataFrame, contact: str) -> DataFrame:
    """name_key, contact, member_id: pairs of name and contact that seeds tie to one member only."""
    own = seeds.filter(F.col(contact).isNotNull()).groupBy("name_key", contact)
    return own.agg(F.min("member_id").alias("member_id"), F.max("member_id").alias("other")).filter("member_id = other").drop("other")


def apply_aliases(sale: DataFrame, diagnosed: DataFrame, scored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A second resolution of sales without a match, by aliases of name and contact that sure matches taught.

    ``sale``: sale_id, name_key, email, phone. Gives (diagnoses, candidates). Diagnoses gain alias_signals and alias_source;
    a match is never changed. An open sale's aliases may name two members (contradictory), one that its direct candidates
    leave out (rejected), or one that fits: a direct candidate, or any where there was none; then that member is taken, with
    a confidence and weight by the number of signals. Candidates are the direct ones, and each single member that aliases
    name, rejected ones too, with a reliability below 1 each. Both aliases of a sale are columns of its row, so votes need no
    grouping, and direct candidates are met by one join on sale and member.
    """
    seeds = alias_seeds(sale, diagnosed)
    open_ = diagnosed.filter(F.col("member_id") == NO_MATCH).select("sale_id", "decision").join(shuffled(sale.select("sale_id", "name_key", "email", "phone")), "sale_id")
    voted = open_.join(shuffled(unique_aliases(seeds, "email").withColumnRenamed("member_id", "by_email")), ["name_key", "email"], "left")
    voted = voted.join(shuffled(unique_aliases(seeds, "phone").withColumnRenamed("member_id", "by_phone")), ["name_key", "phone"], "left")
    voted = voted.filter(F.col("by_email").isNotNull() | F.col("by_phone").isNotNull())
    voted = voted.select(
        "sale_id", "decision", F.coalesce("by_email", "by_phone").alias("alias_member"), F.coalesce(F.col("by_email") != F.col("by_phone"), F.lit(False)).alias("contradictory"),
        (F.col("by_email").isNotNull().cast("int") + F.col("by_phone").isNotNull().cast("int")).alias("signals"),
        F.concat_ws("+", F.when(F.col("by_email").isNotNull(), "NOMBRE+EMAIL_ALIAS"), F.when(F.col("by_phone").isNotNull(), "NOMBRE+TELEFONO_ALIAS")).alias("sources"),
    )
    direct = scored.select("sale_id", F.col("member_id").alias("alias_member"), F.lit(True).alias("direct"))
    met = voted.join(shuffled(direct), ["sale_id", "alias_member"], "left")
    fits = ~F.col("contradictory") & ((F.col("decision") == "SIN_CANDIDATO_DE_CONTACTO") | F.coalesce("direct", F.lit(False)))
    both = F.col("signals") >= 2
    met = met.select(
        "sale_id", "contradictory", fits.alias("fits"), F.col("alias_member"), "signals", "sources",
        F.when(both, ALIAS_CONFIDENCE[1]).otherwise(ALIAS_CONFIDENCE[0]).alias("alias_confidence"), F.when(both, ALIAS_WEIGHT[1]).otherwise(ALIAS_WEIGHT[0]).alias("alias_weight"),
    )

    joined = diagnosed.join(shuffled(met), "sale_id", "left")
    taken = F.coalesce("fits", F.lit(False))
    instead = {
        "member_id": F.col("alias_member").cast("string"), "confidence": F.col("alias_confidence"), "match_method": F.col("sources"), "decision": F.lit("MATCH_ALIAS"),
        "match_weight": F.col("alias_weight"), "top_candidate": F.col("alias_member").cast("string"), "top_raw_confidence": F.col("alias_confidence"),
    }
    updated = [F.when(taken, instead[c]).otherwise(F.col(c)).alias(c) if c in instead else F.col(c) for c in diagnosed.columns]
    source = F.when(F.col("signals").isNull(), "NO_APLICA").when(F.col("contradictory"), "ALIAS_CONTRADICTORIOS").when(~taken, "ALIAS_NO_COMPATIBLE_CON_CANDIDATOS").otherwise(F.col("sources"))
    diagnoses = joined.select(*updated, F.coalesce("signals", F.lit(0)).alias("alias_signals"), source.alias("alias_source"))

    learned = met.filter(~F.col("contradictory")).select(
        "sale_id", F.col("alias_member").alias("member_id"), F.col("alias_confidence").alias("evidence_confidence"), F.col("alias_weight").alias("source_reliability"), F.lit("LEARNED_ALIAS").alias("candidate_source"),
        F.col("sources").alias("match_method"), F.lit(0.0).alias("email_score"), F.lit(0.0).alias("phone_score"), F.lit(1.0).alias("name_score"),
    )
    return diagnoses, direct_candidates(scored).unionByName(learned)


def direct_candidates(scored: DataFrame) -> DataFrame:
    """Scored pairs as candidates of full reliability."""
    return scored.select("sale_id", "member_id", "evidence_confidence", F.lit(1.0).alias("source_reliability"), F.lit("DIRECT_IDENTITY").alias("candidate_source"), "match_method", "email_score", "phone_score", "name_score")


def alias_report(diagnoses: DataFrame, seeds: DataFrame) -> DataFrame:
    """One row: seeds, learned aliases by contact, sales recovered, contradictory and rejected."""
    n = lambda c: F.sum(F.when(c, 1).otherwise(0))
    learned = [unique_aliases(seeds, c).agg(F.count(F.lit(1)).alias(f"learned_{c}_aliases")) for c in ("email", "phone")]
    own = diagnoses.agg(n(F.col("decision") == "MATCH_ALIAS").alias("recovered"), n(F.col("alias_source") == "ALIAS_CONTRADICTORIOS").alias("contradictory"), n(F.col("alias_source") == "ALIAS_NO_COMPATIBLE_CON_CANDIDATOS").alias("rejected"))
    return seeds.agg(F.count(F.lit(1)).alias("seeds")).join(learned[0]).join(learned[1]).join(own)  # one row each


def ranked_candidates(sale: DataFrame, candidates: DataFrame, decided: DataFrame) -> DataFrame:
    """Candidates of each sale with a competing no-match state: rank, probability and history weight, with the best evidence.

    ``candidates``: sale_id, member_id, evidence_confidence, source_reliability, candidate_source, match_method and the three
    scores; rows of one member add up their strengths, and its best row, by confidence and then reliability, gives method and scores.
    """
    strength = F.exp(STRENGTH_SLOPE * (F.col("evidence_confidence") - STRENGTH_CENTRE)) * F.col("source_reliability")
    best = F.max(F.struct("evidence_confidence", "source_reliability", "match_method", "email_score", "phone_score", "name_score")).alias("best")
    own = candidates.groupBy("sale_id", F.col("member_id").cast("string").alias("member_id")).agg(F.sum(strength).alias("strength"), best, F.array_join(F.array_sort(F.collect_set("candidate_source")), "+").alias("candidate_source"))
    own = own.select("sale_id", "member_id", "strength", "best.evidence_confidence", "candidate_source", "best.match_method", "best.email_score", "best.phone_score", "best.name_score")
    none = F.lit(0.0)
    nobody = sale.select(
        "sale_id", F.lit(NO_MATCH).alias("member_id"), F.lit(1.0).alias("strength"), none.alias("evidence_confidence"), F.lit("NO_MATCH_PRIOR").alias("candidate_source"),
        F.lit("NUEVO_O_NO_IDENTIFICADO").alias("match_method"), *[none.alias(c) for c in ("email_score", "phone_score", "name_score")],
    )
    return _with_probability(own.unionByName(nobody), decided).select("sale_id", "candidate_rank", "member_id", "candidate_probability", "evidence_confidence", "model_history_weight", "candidate_source", "match_method", "email_score", "phone_score", "name_score")


def _with_probability(every: DataFrame, decided: DataFrame) -> DataFrame:
    """Rank, probability and history weight of (sale_id, member_id, strength)."""
    every = every.join(shuffled(decided.select("sale_id", "decision", "match_weight", F.col("member_id").alias("matched"))), "sale_id")
    within = Window.partitionBy("sale_id")
    cap = F.when(F.col("matched") != NO_MATCH, F.col("match_weight")).when(F.col("decision") == "AMBIGUO", 0.20).when(F.col("decision") == "EVIDENCIA_INSUFICIENTE", 0.10).otherwise(0.0)
    p = F.col("strength") / F.sum("strength").over(within)
    order = within.orderBy(F.desc("strength"), (F.col("member_id") == NO_MATCH).asc(), F.col("member_id").asc())
    grid = lambda c: F.rint(c * 1e6) / 1e6
    return every.withColumns({"candidate_rank": F.row_number().over(order), "candidate_probability": grid(p), "model_history_weight": F.when(F.col("member_id") == NO_MATCH, 0.0).otherwise(grid(p * cap))})


def probabilities(sale: DataFrame, candidates: DataFrame, decided: DataFrame) -> DataFrame:
    """Candidates of each sale with a competing no-match state: rank, probability and history weight.

    ``candidates``: sale_id, member_id, evidence_confidence, source_reliability, candidate_source.
    """
    strength = F.exp(STRENGTH_SLOPE * (F.col("evidence_confidence") - STRENGTH_CENTRE)) * F.col("source_reliability")
    own = candidates.groupBy("sale_id", F.col("member_id").cast("string").alias("member_id")).agg(F.sum(strength).alias("strength"), F.max("evidence_confidence").alias("evidence_confidence"), F.array_join(F.array_sort(F.collect_set("candidate_source")), "+").alias("candidate_source"))
    nobody = sale.select("sale_id", F.lit(NO_MATCH).alias("member_id"), F.lit(1.0).alias("strength"), F.lit(0.0).alias("evidence_confidence"), F.lit("NO_MATCH_PRIOR").alias("candidate_source"))
    return _with_probability(own.unionByName(nobody), decided).select("sale_id", "candidate_rank", "member_id", "candidate_probability", "evidence_confidence", "model_history_weight", "candidate_source")


def unmatched(sale: DataFrame, decided: DataFrame) -> DataFrame:
    """Buyers of sales without a match, as new or as in doubt."""
    rows = decided.filter(F.col("member_id") == NO_MATCH).select("sale_id", "decision").join(shuffled(sale), "sale_id")
    return rows.select("sale_id", "buyer_name", "email", "phone", "decision", F.when(F.col("decision") == "SIN_CANDIDATO_DE_CONTACTO", "NUEVO").otherwise("EN_DUDA").alias("status"))


def match_report(decided: DataFrame) -> DataFrame:
    """One row: sales, matched, coverage, high and probable matches, conflicts and ambiguous sales."""
    hit = F.col("member_id") != NO_MATCH
    n = lambda c: F.sum(F.when(c, 1).otherwise(0))
    return decided.agg(
        F.count(F.lit(1)).alias("sales"), n(hit).alias("matched"), n(hit & (F.col("confidence") >= 0.9)).alias("high"), n(hit & (F.col("confidence") < 0.9)).alias("probable"),
        n(F.col("exact_conflict")).alias("conflicts"), n(F.col("decision") == "AMBIGUO").alias("ambiguous"), F.count_distinct(F.when(hit, F.col("member_id"))).alias("members"),
    )


def unmatched_detail(sale: DataFrame, diagnoses: DataFrame, ranked: DataFrame) -> DataFrame:
    """Buyers of sales without a match after aliases, with the probability that they are nobody known and their best candidate."""
    rows = diagnoses.filter(F.col("member_id") == NO_MATCH).select("sale_id", "member_id", "confidence", "top_candidate", "top_raw_confidence", "decision")
    nobody = ranked.filter(F.col("member_id") == NO_MATCH).select("sale_id", F.col("candidate_probability").alias("no_match_probability"))
    status = F.when(F.col("decision") == "SIN_CANDIDATO_DE_CONTACTO", "NEW_OR_UNKNOWN").otherwise("UNRESOLVED_IDENTITY")
    return rows.join(shuffled(sale.select("sale_id", "buyer_name", "email", "phone")), "sale_id").join(shuffled(nobody), "sale_id").select("sale_id", "buyer_name", "email", "phone", status.alias("buyer_status"), "member_id", "confidence", "no_match_probability", "top_candidate", "top_raw_confidence", "decision")


def method_report(diagnoses: DataFrame) -> DataFrame:
    """decision, match_method, sales, conflicts, resolved: how sales were decided; a conflict of exact contacts is resolved by a match."""
    n = lambda c: F.sum(F.when(c, 1).otherwise(0))
    conflict = F.col("exact_contact_conflict")
    return diagnoses.groupBy("decision", "match_method").agg(F.count(F.lit(1)).alias("sales"), n(conflict).alias("conflicts"), n(conflict & (F.col("member_id") != NO_MATCH)).alias("resolved"))
