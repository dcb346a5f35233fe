"""Quantiles, ranks, the bootstrap, checked joins, Unicode keys and model fits."""

import time
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

from gatecount.functions import scalars
from gatecount.operators import merges, modeling, ranks
from gatecount.stored import once


@pytest.mark.parametrize("kind", ["normal", "ties", "heavy", "one", "two", "negative"])
def test_quantiles_are_those_of_sorting(spark, kind):
    rng = np.random.default_rng(4)
    values = {
        "normal": rng.normal(size=3001), "ties": rng.integers(0, 4, 999).astype(float), "heavy": np.concatenate([rng.normal(size=500), [1e300, -1e300, 1e9, 0.0]]),
        "one": np.array([2.5]), "two": np.array([1.0, 2.0]), "negative": -np.exp(rng.normal(size=800) * 9),
    }[kind]
    rows = [("a", float(v)) for v in values] + [("a", None), ("b", 7.0), ("b", 7.0)]
    got = {r.g: (r.n, r.q) for r in ranks.quantiles(spark.createDataFrame(rows, "g string, v double"), "g", "v", [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]).collect()}
    assert got["b"] == (2, [7.0] * 7) and got["a"][0] == len(values)
    np.testing.assert_allclose(got["a"][1], np.quantile(values, [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]), rtol=1e-12)


def test_quantile_plans_hold_no_buffers(spark):
    df = spark.range(1000).select(F.lit("a").alias("g"), F.col("id").cast("double").alias("v"))
    plan = ranks.quantiles(df, "g", "v", [0.5])._jdf.queryExecution().toString().lower()
    assert "percentile" not in plan
    assert ranks.quantiles(df.limit(0), "g", "v", [0.5]).count() == 0


def test_running_sums_over_ranges(spark):
    rows = [("m", float(k), k % 5) for k in range(2000)] + [("n", 1.0, 3)]
    got = {(r.g, r.p): r.before for r in ranks.running_sums(spark.createDataFrame(rows, "g string, p double, n long").repartition(7), "g", "p", "n").collect()}
    want, total = {}, 0
    for g, p, n in rows[:-1]:
        want[g, p] = total
        total += n
    assert got == {**want, ("n", 1.0): 0}


def test_auc_of_a_million_scores(spark):
    """A model whose scores never tie: no task orders more than a few ranges of them."""
    n = 1_000_000
    df = spark.range(n).select(F.lit("m").alias("model"), (F.col("id") / n).alias("p"), (F.col("id") * 7919 % 1000 < F.col("id") / n * 1000).cast("int").alias("label"))
    scores = np.arange(n)
    label = scores * 7919 % 1000 < scores / n * 1000
    ranked = scores[label].sum() - label.sum() * (label.sum() - 1) / 2
    want = ranked / (label.sum() * (n - label.sum()))
    assert modeling.auc(df).first()["auc"] == pytest.approx(want, abs=1e-6)


@pytest.mark.parametrize("n", [1000, 997])
def test_bootstrap_agrees_with_resampling(spark, n):
    d = np.random.default_rng(n).normal(size=n)
    got = modeling.bootstrap(spark.createDataFrame([(k, float(x)) for k, x in enumerate(d)], "id long, d double"), 10_000).first()
    draws = np.random.default_rng(1).choice(d, size=(10_000, n)).mean(1)
    low, high = np.quantile(draws, [0.025, 0.975])
    assert got.draws == 10_000 and got["mean"] == pytest.approx(d.mean(), abs=0.003)
    assert (got.high - got.low) / (high - low) == pytest.approx(1, abs=0.05)
    assert abs(got.low - low) < 0.05 * (high - low) and abs(got.high - high) < 0.05 * (high - low)


def test_bootstrap_ignores_order_and_nulls(spark):
    rows = [(k, float(k % 7)) for k in range(200)]
    a = modeling.bootstrap(spark.createDataFrame(rows, "id long, d double"), 500).first()
    b = modeling.bootstrap(spark.createDataFrame([*rows[::-1], (999, None)], "id long, d double").repartition(5), 500).first()
    assert a == b
    assert modeling.bootstrap(spark.createDataFrame([], "id long, d double"), 50).first().draws == 0


def _frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_merges_assert_their_keys(spark):
    left, right = _frame(spark, [(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k long, x string"), _frame(spark, [(1, 10), (2, 20), (None, 30)], "k long, y long")
    assert sorted((r.x, r.y) for r in merges.merge(left, right, ["k"]).collect()) == [("a", 10), ("b", 10), ("c", 20), ("d", None)]
    twice = right.unionByName(_frame(spark, [(2, 21)], "k long, y long"))
    for bad in (lambda: merges.merge(left, twice, ["k"], name="prices"), lambda: merges.merge(left, right, ["k"], validate="one_to_one"), lambda: merges.merge(left, right.filter("k = 1"), ["k"], complete=True)):
        with pytest.raises(Exception, match="repeats a key|lacks a key"):
            bad().collect()
        with pytest.raises(Exception, match="repeats a key|lacks a key"):
            bad().count()
    with pytest.raises(ValueError, match="both sides"):
        merges.merge(left, right.withColumnRenamed("y", "x"), ["k"])
    with pytest.raises(ValueError):
        merges.merge(left, right, ["k"], validate="many")


@pytest.mark.parametrize("word", ["Nguyễn Thị Ánh", "josé", "Łódź", "Ångström", "Straße", "İstanbul", "ậb", "ÇÉÑ", "Ω ά", ""])
def test_keys_follow_unicode(spark, word):
    def key(x):
        return "".join(c for c in unicodedata.normalize("NFD", x.replace("ß", "SS").upper()) if unicodedata.category(c) != "Mn")

    df = spark.createDataFrame([(word,)], "w string")
    got = df.select(scalars.match_key(F.col("w")), scalars.token_key(F.col("w")), scalars.composed(F.col("w"))).first()
    import re

    assert got[0] == re.sub("[^A-Z0-9]", "", key(word))
    assert got[1] == " ".join(sorted(re.findall("[A-Z0-9]+", key(word))))
    assert got[2] == unicodedata.normalize("NFC", word)


def _planted(spark, n=400):
    rng = np.random.default_rng(0)
    rows = []
    for k in range(n):
        kind, x, noise = "ab"[k % 2], float(rng.normal()), float(rng.normal())
        rows.append((k, k % 20, kind, x, noise, int(2 * x + (kind == "a") + rng.normal() * 0.5 > 0.5)))
    return spark.createDataFrame(rows, "id long, g long, kind string, x double, noise double, label int")


@pytest.mark.parametrize("kind", ["logistic", "boosted"])
def test_importance_finds_the_planted_column(spark, kind):
    df = _planted(spark)
    fitted = modeling.final_fit(df, kind, ["kind"], ["x", "noise"], 12)
    rows = modeling.feature_importance(fitted, df, ["kind"], ["x", "noise"]).collect()
    assert rows[0].feature == "x" and {r.feature for r in rows} == {"kind", "x", "noise"} and sum(r.share for r in rows) == pytest.approx(1)
    assert [r.rank for r in rows] == [1, 2, 3]
    scored = modeling.score(fitted, df.drop("label"), ["kind"], ["x", "noise"])
    assert scored.columns == ["id", "g", "kind", "x", "noise", "p"] and scored.filter("p between 0 and 1").count() == 400


def test_boosting_stops_by_the_fold_held_back(spark):
    df = _planted(spark, 200)
    folds = modeling.fit_folds(df, modeling.group_folds(df, "g", 2), "g", "boosted", ["kind"], ["x", "noise"], 2, rounds=30)
    assert len(folds.rounds) == 2 and all(1 <= r <= 30 for r in folds.rounds) and folds.final_rounds >= modeling.LEAST_ROUNDS
    assert folds.scored.count() == 200 and folds.scored.select("id").distinct().count() == 200
    noise = df.withColumn("label", (F.xxhash64("id") % 2 == 0).cast("int"))
    short = modeling.fit_folds(noise, modeling.group_folds(noise, "g", 2), "g", "boosted", ["kind"], ["noise"], 2, rounds=30)
    assert max(short.rounds) < 30, "noise has nothing to learn"


def test_boosted_folds_are_those_of_mllib(spark, monkeypatch):
    """All folds are fitted in three jobs a round, and score as MLlib's models of the same folds, rounds and share of rows do."""
    monkeypatch.setattr(modeling, "SHARE", 1.0)
    df = _planted(spark, 600).cache()
    fold_of = modeling.group_folds(df, "g", 3).cache()
    fitted = modeling.fit_folds(df, fold_of, "g", "boosted", ["kind"], ["x", "noise"], 3, rounds=12)
    assert fitted.rounds == [12] * 3
    mine = {r.id: r.p for r in fitted.scored.collect()}
    rows, theirs = modeling._model_rows(df, ["kind"], ["x", "noise"]).join(fold_of, "g"), {}
    for k in range(3):
        model = modeling.pipeline("boosted", ["kind"], ["x", "noise"], 600, 12).fit(rows.filter(F.col("fold") != k))
        theirs |= {r.id: r.probability[1] for r in model.transform(rows.filter(F.col("fold") == k)).collect()}
    apart = np.array([abs(mine[i] - theirs[i]) for i in theirs])
    assert len(mine) == 600 and np.median(apart) < 0.02 and np.mean(apart) < 0.03  # bins are cut a little elsewhere


def test_linear_folds_hold_one_folds_rows_at_a_time(spark, monkeypatch):
    """A linear fit keeps its rows, on disk where memory ends: those of all folds together once filled it."""
    running, most, real = [], [], modeling.pipeline

    class Watched:
        def __init__(self, inner):
            self.inner = inner

        def fit(self, rows):
            running.append(1)
            most.append(len(running))
            time.sleep(0.5)
            fitted = self.inner.fit(rows)
            running.pop()
            return fitted

    monkeypatch.setattr(modeling, "pipeline", lambda *a: Watched(real(*a)))
    df = _planted(spark, 120)
    folds = modeling.fit_folds(df, modeling.group_folds(df, "g", 3), "g", "logistic", ["kind"], ["x", "noise"], 3)
    assert most == [1, 1, 1] and folds.scored.count() == 120


def test_long_work_is_dealt_to_all_cores(spark):
    """What adaptive execution leaves in one part is fitted, and resampled, in two parts a core."""
    cores = spark.sparkContext.defaultParallelism
    df = spark.range(400).select((F.col("id") % 20).alias("g"), F.lit("a").alias("kind"), F.col("id").alias("x"), (F.col("id") % 2).cast("int").alias("label")).coalesce(1)
    assert modeling._once_for_fits(df).rdd.getNumPartitions() == 2 * cores
    sums = modeling.bootstrap(df.select(F.col("x").alias("id"), F.lit(1.0).alias("d")), 5)
    assert f"RoundRobinPartitioning({2 * cores})" in sums._jdf.queryExecution().executedPlan().toString()


def test_stored_tables_leave_no_shuffle_files(spark):
    """The files of a stored table's shuffle are gone at once, and its rows can be read again and again."""
    import glob

    files = lambda: {f for top in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString() for f in glob.glob(f"{top}/**/shuffle_*.data", recursive=True)}
    before = files()
    out = once(spark.range(1000).repartition(3).groupBy((F.col("id") % 7).alias("k")).agg(F.count(F.lit(1)).alias("n")))
    assert not files() - before
    assert out.count() == 7 and sum(r.n for r in out.collect()) == 1000
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"
