"""Golden values and properties of the scalar and similarity functions."""

import unicodedata
from difflib import SequenceMatcher

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gatecount.functions import scalars as S
from gatecount.functions import similarity as M
from gatecount.operators import features, matching, modeling, simulate


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_email(spark):
    e = one(spark, S.email(F.lit(" Ana.Paz+boletas@GMIAL.com ")))
    assert (e["value"], e["upper_case"], e["plus_alias"], e["domain_typo"], e["invalid"]) == ("ana.paz@gmail.com", True, True, True, False)
    for bad in ("a@b@c.com", "", None):
        e = one(spark, S.email(F.lit(bad).cast("string")))
        assert e["value"] == "SIN_DATO" and e["invalid"]


def test_phone(spark):
    p = one(spark, S.phone(F.lit("(+57) 301-234-5678")))
    assert (p["value"], p["formatted"]) == ("3012345678", True)
    assert one(spark, S.phone(F.lit("2012345678")))["value"] == "SIN_DATO"
    assert one(spark, S.phone(F.lit(None).cast("string")))["missing"]


def test_keys(spark):
    assert one(spark, S.token_key(F.lit("Gómez  Ana"))) == "ANA GOMEZ"
    assert one(spark, S.text(F.lit(" a  b\t"))) == "a b"
    assert one(spark, S.text(F.lit(None).cast("string"))) == ""
    assert one(spark, S.boolean(F.lit(" SÍ "))) is True and one(spark, S.boolean(F.lit("?"))) is None
    assert one(spark, S.csv_field(F.lit('a"b,c'))) == '"a""b,c"'
    assert one(spark, S.number(F.lit("x"), 7.0)) == 7.0


@pytest.mark.parametrize("a,b,near", [("abcd", "abdc", True), ("abcd", "badc", False), ("ab", "ab", True), ("", "a", True), ("abc", "a", False)])
def test_within_one_edit(spark, a, b, near):
    assert one(spark, M.within_one_edit(F.lit(a), F.lit(b))) is near


def _osa(a, b):
    d = [[i + j if not i * j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


def test_one_edit_is_optimal_alignment(spark):
    pairs = []

    @settings(max_examples=400, deadline=None, database=None)
    @given(st.text("abc", max_size=6), st.text("abc", max_size=6))
    def draw(a, b):
        pairs.append((a, b))

    draw()
    df = spark.createDataFrame(pairs, "a string, b string").select("a", "b", M.within_one_edit(F.col("a"), F.col("b")).alias("x"))
    assert all(r.x == (_osa(r.a, r.b) <= 1) for r in df.collect())


def test_signatures_and_swaps(spark):
    assert sorted(one(spark, M.deletion_signatures(F.lit("abb")))) == ["ab", "abb", "bb"]
    assert one(spark, M.deletion_signatures(F.lit(""))) == []
    assert len(one(spark, M.swap_variants(F.lit("0123456789")))) == 45
    assert len(one(spark, M.swap_variants(F.lit("0123456788")))) == 44


def test_name_similarity(spark):
    like = lambda *x, **k: one(spark, M.name_similarity(*[F.lit(v) for v in x], **k))
    assert like("CASTRO ANDRES", "ANDRÉS", "CASTRO") == 1.0
    assert like("A. CASTRO", "ANDRES", "CASTRO", ratio=False) == 0.84
    assert like("ANDRES CASTR", "ANDRES", "CASTRO", ratio=False) == 0.95
    assert like("", "ANDRES", "CASTRO") == 0.0
    assert like("LUZ MORA", "ANA", "PAZ") == round(SequenceMatcher(None, "LUZMORA", "ANAPAZ").ratio(), 4)


@pytest.mark.parametrize("scores,want", [((1.0, 1.0, 0.9), 0.995), ((1.0, 0.0, 0.7), 0.80), ((0.9, 0.0, 0.5), 0.45), ((0.0, 0.0, 1.0), 0.0)])
def test_confidence(spark, scores, want):
    assert one(spark, matching.confidence(*map(F.lit, scores))) == want


def test_probability(spark):
    sale = spark.createDataFrame([(1,)], "sale_id long")
    cand = spark.createDataFrame([(1, 5, 0.75, 1.0, "DIRECT_IDENTITY")], "sale_id long, member_id long, evidence_confidence double, source_reliability double, candidate_source string")
    decided = spark.createDataFrame([(1, "AMBIGUO", 0.0, "SIN_MATCH")], "sale_id long, decision string, match_weight double, member_id string")
    rows = matching.probabilities(sale, cand, decided).orderBy("candidate_rank").collect()
    assert [(r.member_id, r.candidate_probability, r.model_history_weight) for r in rows] == [("5", 0.5, 0.1), ("SIN_MATCH", 0.5, 0.0)]


def test_shrink_and_rates(spark):
    assert one(spark, features.companion_shrink(F.lit(0.9), F.lit(0.7), F.lit(2))) == pytest.approx(0.8)
    train = spark.createDataFrame([("a", 1)] * 8 + [("a", 0)] * 2 + [("b", 0)] * 6, "k string, label int")
    assert {r.k: r.rate for r in modeling.smoothed_rates(train, ["k"]).collect()}["a"] == pytest.approx(23 / 40)


def test_buckets_and_staff(spark):
    assert [one(spark, S.arrival_bucket(F.lit(m))) for m in (-47, 130)] == [-60, 120]
    staff = {k: one(spark, v) for k, v in simulate.staffing(F.lit(500.0), 0.25).items()}
    assert staff == {"peak_quarter": 125, "scanners": 3, "security": 5}


def test_share_link_round_trip(spark):
    link = S.share_link(F.lit("e1"), F.lit(3), F.lit(0), F.lit(2), F.lit(1))
    assert one(spark, link) == "/e/e1?c=3&k=2&v=1"
    x = one(spark, S.parse_share_link(link))
    assert (x["event_id"], x["c"], x["m"], x["k"], x["v"]) == ("e1", 3, 0, 2, 1)


def test_latin_letters_are_composed_and_stay_out_of_python(spark):
    """Nothing below U+0300 changes under NFC, alone or after another such letter; marks after it do."""
    low = "".join(map(chr, range(0x300)))
    assert all(unicodedata.normalize("NFC", a + b) == a + b for a in low for b in (a, "a", "é"))
    texts = ["plain", "Medell\u00edn", low[1:], "Medelli\u0301n", None, "\u212b"]
    df = spark.createDataFrame([(t,) for t in texts], "w string").select("w", S.composed(F.col("w")).alias("c"))
    assert [r.c for r in df.collect()] == [t and unicodedata.normalize("NFC", t) for t in texts]
    assert r"[^\x00-\u02FF]" in df._jdf.queryExecution().optimizedPlan().toString()
