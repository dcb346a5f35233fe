"""Decisions by the whole name score against a comparison of all pairs in plain Python."""

from difflib import SequenceMatcher
from itertools import product
from math import exp

import pytest
from pyspark.sql import functions as F

from gatecount.functions.scalars import token_key
from gatecount.operators import matching
from gatecount.plans.queries import QUERIES

SMALL = "/root/testdata/sf0.001"

SALES = [
    (1, "ana.ruiz@mail.com", "3001234567", "Ana Ruiz"), (2, "ana.ruis@mail.com", "3001234567", "Anna Ruis"), (3, "luis@mail.com", None, "Lius Perz"), (4, None, "3109876543", "L. Perez"),
    (5, "nobody@mail.com", None, "Ana Ruiz"), (6, "shared@mail.com", None, "Eva Mora Gil"), (7, "anar.uiz@mail.com", "3001234576", "Ruiz Ana"), (8, None, None, None), (9, "luis@mail.com", "3109876543", ""),
    (10, "luis@mail.com", "3001234567", "Luisa Peres"),
]
MEMBERS = [
    (1, "ana.ruiz@mail.com", "3001234567", "Ana", "Ruiz"), (2, "luis@mail.com", "3109876543", "Luis", "Perez"), (3, "shared@mail.com", None, "Eva", "Mora"), (4, "shared@mail.com", "3001234567", "Iván", "Mora"),
    (5, "luiz@mail.com", None, "Luiz", "Paz"), (6, None, None, "Ana", "Ruiz"),
]


def _edits(a, b):
    d = {(i, j): i + j for i in range(len(a) + 1) for j in range(len(b) + 1) if not i * j}
    for i, j in product(range(1, len(a) + 1), range(1, len(b) + 1)):
        d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
        if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
            d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a), len(b)]


def _swapped(a, b):
    off = [k for k in range(len(a)) if a[k] != b[k]] if len(a) == len(b) else []
    return len(off) == 2 and a[off[0]] == b[off[1]] and a[off[1]] == b[off[0]]


def _name(full, first, last):
    plain = lambda x: (x or "").upper().replace("Á", "A").replace(".", " ")
    given, held = plain(full).split(), plain(f"{first} {last}").split()
    if not given:
        return 0.0
    f, g = plain(first), plain(last)
    if f in given and g in given:
        return 1.0
    scores = [SequenceMatcher(None, "".join(sorted(given)), "".join(sorted(held))).ratio()]
    scores += [0.84] if g in given and any(len(t) == 1 and f.startswith(t) for t in given) else []
    scores += [0.95] if _edits("".join(given), f + g) <= 1 else []
    scores += [0.55 + 0.4 * len(set(given) & set(held)) / len(set(held))] if g in given else []
    return round(max(scores), 4)


def _confidence(e, p, n):
    if not e and not p:
        return 0.0
    if e and p:
        steps, floor = ([(0.9, 0.995), (0.75, 0.97), (0.5, 0.9)], 0.78) if e == p == 1 else ([(0.9, 0.97), (0.75, 0.94), (0.5, 0.86)], 0.72)
    else:
        steps, floor = ([(0.95, 0.96), (0.82, 0.91), (0.65, 0.8)], 0.58) if max(e, p) == 1 else ([(0.95, 0.92), (0.82, 0.86), (0.65, 0.74)], 0.45)
    return next((v for least, v in steps if n >= least), floor)


def _pairs(sale, members):
    """(confidence, name, contacts, -member, exact contacts, email, phone) of each candidate, best first."""
    _, email, phone, name = sale
    owner = lambda k, value: max(m[0] for m in members if m[k] == value)
    pairs = []
    for m in members:
        e = 0.0 if not email or not m[1] else 1.0 if email == m[1] and owner(1, email) == m[0] else 0.9 if _edits(email, m[1]) <= 1 else 0.0
        own = phone and m[2] and owner(2, m[2]) == m[0]
        p = 0.0 if not own else 1.0 if phone == m[2] else 0.9 if _swapped(phone, m[2]) else 0.0
        if e or p:
            n = _name(name, m[3], m[4])
            pairs.append((_confidence(e, p, n), n, e + p, -m[0], (e == 1) + (p == 1), e, p))
    return sorted(pairs, reverse=True)


def _decide(sale, members=MEMBERS):
    pairs = _pairs(sale, members)
    if not pairs:
        return "SIN_MATCH", "SIN_CANDIDATO_DE_CONTACTO", 0.0
    top, *rest = pairs
    runner = rest[0] if rest else None
    if top[0] < 0.7:
        return "SIN_MATCH", "EVIDENCIA_INSUFICIENTE", 0.0
    if runner is None or round(top[0] - runner[0], 9) >= 0.08 or (top[0] >= 0.95 and top[1] >= 0.9 and top[4] > runner[4]):
        return str(-top[3]), "MATCH", top[0]
    return "SIN_MATCH", "AMBIGUO", 0.0


def _frames(spark, sales=SALES, members=MEMBERS):
    return spark.createDataFrame(sales, "sale_id long, email string, phone string, buyer_name string"), spark.createDataFrame(members, "member_id long, email string, phone string, first_name string, last_name string")


def test_decisions_by_the_whole_name_score(spark):
    sale, member = _frames(spark)
    out = matching.decide(sale, matching.score_candidates(sale, member)).collect()
    assert {r.sale_id: (r.member_id, r.decision, r.confidence) for r in out} == {s[0]: _decide(s) for s in SALES}


def test_the_ratio_changes_decisions(spark):
    """The fixture holds a pair that the rules alone score lower than the ratio does."""
    sale, member = _frames(spark)
    whole, rules = ({(r.sale_id, r.member_id): r.name_score for r in matching.score_candidates(sale, member, x).collect()} for x in (True, False))
    assert whole.keys() == rules.keys() and any(whole[k] > rules[k] for k in whole) and all(whole[k] >= rules[k] for k in whole)


TWINS = [
    (1, "ana.one@mail.com", "3001111111", "Ana", "Ruiz"), (2, "luis@mail.com", "3109876543", "Luis", "Perez"), (6, "othes@mail.com", "3002222222", "Ana", "Ruiz"), (7, "eva@mail.com", "3003333333", "Eva", "Mora"),
]
ORDERS = [
    (1, "other@mail.com", "3001111111", "Ana Ruiz"), (2, "ana.one@mail.com", "3999999991", "Ruiz Ana"), (3, "third@mail.com", "3002222222", "Ana Ruiz"), (4, "othes@mail.com", "3999999992", "Ana Ruiz"),
    (10, "third@mail.com", None, "Ana  Ruiz"), (11, "third@mail.com", "3999999992", "RUIZ ANA"), (12, "third@mail.com", "3999999991", "Ana Ruiz"), (13, "third@mail.com", "3109876543", "Ana Ruiz"),
    (14, "other@mail.com", "3010111111", "Ana Ruiz"), (15, "third@mail.com", None, "Eva Mora"), (16, None, None, "Ana Ruiz"), (17, None, "3999999991", "Ana Ruiz"), (18, "other@mail.com", "3001111111", "Ana Ruiz"),
    (19, "other@mail.com", "3003333333", "Eva Mora"), (20, "fourth@mail.com", "3001111111", "Ana Ruiz"), (21, "fourth@mail.com", "3002222222", "Ana Ruiz"), (22, "fourth@mail.com", None, "Ana Ruiz"),
]


def _resolve(sales, members):
    """Both passes in plain Python: ({sale: (member, decision, confidence, weight, signals, source)}, [(sale, member, confidence, reliability, source)])."""
    key = lambda s: " ".join(sorted(s[3].upper().split()))
    first = {s[0]: _decide(s, members) for s in sales}
    pairs = {s[0]: _pairs(s, members) for s in sales}
    seeds = [(s, int(first[s[0]][0])) for s in sales if first[s[0]][1] == "MATCH" and first[s[0]][2] >= 0.95 and pairs[s[0]][0][1] >= 0.95]
    alias = {}
    for s, member in seeds:
        for k in (1, 2):
            if s[k]:
                alias.setdefault((k, key(s), s[k]), set()).add(member)
    out, candidates = {}, [(s[0], -p[3], p[0], 1.0, "DIRECT_IDENTITY") for s in sales for p in pairs[s[0]]]
    for s in sales:
        member, decision, confidence = first[s[0]]
        weight = (1.0 if confidence >= 0.95 else 0.8 if confidence >= 0.9 else 0.6) if decision == "MATCH" else 0.0
        out[s[0]] = (member, decision, confidence, weight, 0, "NO_APLICA")
        votes = [(n, min(alias[k, key(s), s[k]])) for k, n in ((1, "NOMBRE+EMAIL_ALIAS"), (2, "NOMBRE+TELEFONO_ALIAS")) if len(alias.get((k, key(s), s[k]), ())) == 1]
        if member != "SIN_MATCH" or not votes:
            continue
        if len({m for _, m in votes}) > 1:
            out[s[0]] = (member, decision, confidence, weight, len(votes), "ALIAS_CONTRADICTORIOS")
            continue
        named, c, w = votes[0][1], (0.82, 0.90)[len(votes) - 1], (0.35, 0.55)[len(votes) - 1]
        candidates.append((s[0], named, c, w, "LEARNED_ALIAS"))
        if decision == "SIN_CANDIDATO_DE_CONTACTO" or any(-p[3] == named for p in pairs[s[0]]):
            out[s[0]] = (str(named), "MATCH_ALIAS", c, w, len(votes), "+".join(n for n, _ in votes))
        else:
            out[s[0]] = (member, decision, confidence, weight, len(votes), "ALIAS_NO_COMPATIBLE_CON_CANDIDATOS")
    return out, candidates


def _second_pass(spark):
    sale, member = _frames(spark, ORDERS, TWINS)
    sale = sale.withColumn("name_key", token_key(F.col("buyer_name")))
    scored = matching.score_candidates(sale, member)
    diagnosed = matching.diagnose(sale, scored)
    return sale, diagnosed, *matching.apply_aliases(sale, diagnosed, scored)


def test_aliases_resolve_open_sales(spark):
    sale, diagnosed, after, candidates = _second_pass(spark)
    want, rows = _resolve(ORDERS, TWINS)
    got = {r.sale_id: (r.member_id, r.decision, r.confidence, r.match_weight, r.alias_signals, r.alias_source) for r in after.collect()}
    assert got == want
    assert sorted((r.sale_id, r.member_id, r.evidence_confidence, r.source_reliability, r.candidate_source) for r in candidates.collect()) == sorted(rows)
    sources = {x[5] for x in want.values()}
    assert {"ALIAS_CONTRADICTORIOS", "ALIAS_NO_COMPATIBLE_CON_CANDIDATOS", "NOMBRE+EMAIL_ALIAS", "NOMBRE+EMAIL_ALIAS+NOMBRE+TELEFONO_ALIAS"} <= sources
    assert any(w[1] == "MATCH_ALIAS" and any(-p[3] == int(w[0]) for p in _pairs(s, TWINS)) for s in ORDERS for w in [want[s[0]]]), "an alias that a direct candidate confirms"
    report = matching.alias_report(after, matching.alias_seeds(sale, diagnosed)).first().asDict()
    assert report["recovered"] == sum(x[1] == "MATCH_ALIAS" for x in want.values()) and report["contradictory"] == 1
    kept = {r.sale_id: (r.member_id, r.confidence) for r in diagnosed.filter("decision = 'MATCH'").collect()}
    assert all(got[s][0] == m and got[s][2] == c for s, (m, c) in kept.items()), "no match is changed"


def test_probabilities_over_both_kinds_of_evidence(spark):
    sale, _, after, candidates = _second_pass(spark)
    decided, rows = _resolve(ORDERS, TWINS)
    got = matching.ranked_candidates(sale, candidates, after).collect()
    for s in ORDERS:
        strength = {"SIN_MATCH": 1.0}
        for _, member, c, w, _ in (r for r in rows if r[0] == s[0]):
            strength[str(member)] = strength.get(str(member), 0.0) + exp(12 * (c - 0.75)) * w
        member, decision, _, weight, _, _ = decided[s[0]]
        cap = weight if member != "SIN_MATCH" else {"AMBIGUO": 0.2, "EVIDENCIA_INSUFICIENTE": 0.1}.get(decision, 0.0)
        want = {m: (round(x / sum(strength.values()), 6), 0.0 if m == "SIN_MATCH" else round(cap * x / sum(strength.values()), 6)) for m, x in strength.items()}
        own = sorted((r for r in got if r.sale_id == s[0]), key=lambda r: r.candidate_rank)
        assert {r.member_id: (r.candidate_probability, r.model_history_weight) for r in own} == want
        assert [r.candidate_rank for r in own] == list(range(1, len(want) + 1))
    unmatched = matching.unmatched_detail(sale, after, matching.ranked_candidates(sale, candidates, after)).collect()
    assert sorted(r.sale_id for r in unmatched) == sorted(k for k, x in decided.items() if x[0] == "SIN_MATCH")


def test_diagnoses_hold_the_runner_up(spark):
    sale, member = _frames(spark)
    rows = {r.sale_id: r for r in matching.diagnose(sale, matching.score_candidates(sale, member)).collect()}
    assert len(rows[1].asDict()) == 21
    for s in SALES:
        pairs, r = _pairs(s, MEMBERS), rows[s[0]]
        assert r.candidate_count == len(pairs)
        assert (r.top_candidate, r.top_raw_confidence) == ((str(-pairs[0][3]), pairs[0][0]) if pairs else ("SIN_MATCH", 0.0))
        assert (r.runner_up_candidate, r.runner_up_confidence, r.runner_up_email_score, r.runner_up_phone_score) == ((str(-pairs[1][3]), pairs[1][0], pairs[1][5], pairs[1][6]) if len(pairs) > 1 else ("SIN_MATCH", 0.0, 0.0, 0.0))
        by = [next((str(-p[3]) for p in pairs if p[k] == 1), "SIN_MATCH") for k in (5, 6)]
        assert [r.exact_email_candidate, r.exact_phone_candidate] == by
        assert r.exact_contact_conflict == ("SIN_MATCH" not in by and by[0] != by[1])


@pytest.mark.parametrize("name", ["er_candidates", "er_candidates_ratio", "er_decision_rules", "alias_vote_rules", "candidate_probability_all_rules", "identity_features_rules"])
def test_no_join_broadcasts_what_grows(spark, name):
    """A broadcast of members or sales goes through the driver; those of one row, without keys, are no hash joins."""
    plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan
    assert "BroadcastHashJoin" not in plan


def test_signatures_are_counted_in_their_row(spark):
    """Exploded, all signatures of all members would be sorted, 25 times the rows."""
    plan = QUERIES["sig_explode"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Aggregate" in plan
