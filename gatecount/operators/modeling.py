"""Attendance models: smoothed rates, grouped folds, out-of-fold scores, metrics, forecasts, MLlib pipelines."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import md5
from math import e, factorial
from statistics import median

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import clip_probability, hash_number
from ..stored import once
from . import boosting
from .merges import shuffled
from .ranks import quantiles, running_sums

#: Fixed value: weight of the global rate in a smoothed rate.
ALPHA = 30.0
FOLDS = 5


def _on_all_cores(df: DataFrame) -> DataFrame:
    """``df`` in two parts a core: adaptive execution merges parts by bytes, which is too few tasks for work that takes long a byte."""
    return df.repartition(2 * df.sparkSession.sparkContext.defaultParallelism)


def _once_for_fits(df: DataFrame) -> DataFrame:
    """``df`` computed once, in two parts a core at least."""
    rows = once(df)
    return rows if rows.rdd.getNumPartitions() >= 2 * rows.sparkSession.sparkContext.defaultParallelism else once(_on_all_cores(rows))


def _grid(c: Column) -> Column:
    return F.rint(c * 1e6) / F.lit(1e6)


def smoothed_rates(train: DataFrame, by: list[str], alpha: float = ALPHA) -> DataFrame:
    """Keys, n, rate = (sum y + alpha global) / (n + alpha) of (keys, label)."""
    overall = train.agg(F.avg("label").alias("overall"))
    own = train.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("hits"))
    return own.join(F.broadcast(overall)).select(*by, "n", ((F.col("hits") + alpha * F.col("overall")) / (F.col("n") + alpha)).alias("rate"))


def group_folds(df: DataFrame, group: str, folds: int = FOLDS) -> DataFrame:
    """group, fold: groups never split, folds of equal numbers of groups, by hash order.

    Groups are ranked per hash bucket, so no task orders all of them.
    """
    groups = df.select(group).distinct().withColumn("h", hash_number(F.col(group), 1 << 31)).withColumn("bucket", F.floor(F.col("h") / (1 << 25)).cast("int"))
    counts = groups.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy(F.lit(1)).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select("bucket", F.coalesce(before, F.lit(0)).alias("before"))
    rank = F.row_number().over(Window.partitionBy("bucket").orderBy("h", group)) - 1
    return groups.withColumn("rank", rank).join(F.broadcast(counts), "bucket").select(group, ((F.col("before") + F.col("rank")) % folds).cast("int").alias("fold"))


def oof_baseline(labelled: DataFrame, fold_of: DataFrame, group: str, by: str, alpha: float = ALPHA) -> DataFrame:
    """Each row with the smoothed rate of the other folds, all folds in one pass; unseen categories get the global rate.

    Sums of the other folds are sums over all minus those of the own fold.
    """
    rows = labelled.join(fold_of, group)
    cells = rows.groupBy("fold", by).agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("hits"))
    total = cells.groupBy(by).agg(F.sum("n").alias("n_all"), F.sum("hits").alias("hits_all"))
    folds = cells.groupBy("fold").agg(F.sum("n").alias("fold_n"), F.sum("hits").alias("fold_hits"))
    every = cells.agg(F.sum("n").alias("all_n"), F.sum("hits").alias("all_hits"))
    overall = (F.col("all_hits") - F.col("fold_hits")) / (F.col("all_n") - F.col("fold_n"))
    rate = (F.col("hits_all") - F.col("hits") + alpha * overall) / (F.col("n_all") - F.col("n") + alpha)
    table = cells.join(total, by).join(folds, "fold").join(F.broadcast(every)).select("fold", by, rate.alias("p"))
    return rows.join(F.broadcast(table), ["fold", by]).select(*labelled.columns, "fold", "p")


def ticket_metrics(scored: DataFrame) -> DataFrame:
    """model, n, brier, log_loss of (model, label, p)."""
    p = clip_probability(F.col("p"))
    loss = -(F.col("label") * F.log(p) + (1 - F.col("label")) * F.log(1 - p))
    return scored.groupBy("model").agg(F.count(F.lit(1)).alias("n"), _grid(F.avg((F.col("p") - F.col("label")) ** 2)).alias("brier"), _grid(F.avg(loss)).alias("log_loss"))


def auc(scored: DataFrame) -> DataFrame:
    """model, auc by mean ranks: ties are aggregated first, and ranks are running sums over ranges of scores."""
    cells = scored.groupBy("model", "p").agg(F.sum("label").alias("pos"), F.sum(1 - F.col("label")).alias("neg"))
    wins = running_sums(cells, "model", "p", "neg").withColumn("wins", F.col("pos") * (F.col("before") + F.col("neg") / 2))
    return wins.groupBy("model").agg(_grid(F.sum("wins") / F.nullif(F.sum("pos") * F.sum("neg"), F.lit(0))).alias("auc"))


def event_predictions(scored: DataFrame) -> DataFrame:
    """model, event_id, tickets, actual, predicted, residual."""
    return scored.groupBy("model", "event_id").agg(F.count(F.lit(1)).alias("tickets"), F.sum("label").alias("actual"), F.sum("p").alias("predicted")).withColumn("residual", F.col("actual") - F.col("predicted"))


def event_metrics(predictions: DataFrame) -> DataFrame:
    """model, events, mae, rmse, wape (per cent), bias, actual and predicted totals."""
    r = F.col("residual")
    return predictions.groupBy("model").agg(
        F.count(F.lit(1)).alias("events"), _grid(F.avg(F.abs(r))).alias("mae"), _grid(F.sqrt(F.avg(r * r))).alias("rmse"), _grid(100 * F.sum(F.abs(r)) / F.nullif(F.sum("actual"), F.lit(0))).alias("wape"),
        _grid(F.avg(-r)).alias("bias"), F.sum("actual").alias("actual_total"), _grid(F.sum("predicted")).alias("predicted_total"),
    )


def rank_models(metrics: DataFrame) -> DataFrame:
    """Models in order of mae, wape and brier; a table of a few rows."""
    return metrics.withColumn("rank", F.row_number().over(Window.orderBy("mae", "wape", "brier", "model")))


def residual_interval(predictions: DataFrame) -> DataFrame:
    """model, q10, q90, sd of residuals around their mean; quantiles by counting, not by sorting a model's events."""
    own = once(predictions.select("model", "residual"))
    moments = own.groupBy("model").agg(F.avg("residual").alias("mean"), F.stddev_samp("residual").alias("sd"))
    q = quantiles(own, "model", "residual", [0.1, 0.9])
    return moments.join(q, "model").select("model", _grid(F.col("q")[0] - F.col("mean")).alias("q10"), _grid(F.col("q")[1] - F.col("mean")).alias("q90"), _grid(F.col("sd")).alias("sd"))


def forecast(scored: DataFrame, interval: DataFrame) -> DataFrame:
    """event_id, expected_attendance, p10, p90 to one place, ordered and within the tickets."""
    own = scored.groupBy("event_id").agg(F.count(F.lit(1)).alias("tickets"), F.sum("p").alias("expected")).join(F.broadcast(interval))
    one = lambda c: F.floor(c * 10 + 0.5) / F.lit(10.0)
    held = lambda c: F.least(F.greatest(c, F.lit(0.0)), F.col("tickets").cast("double"))
    mid = held(F.col("expected"))
    return own.select("event_id", one(mid).alias("expected_attendance"), one(held(F.least(mid, F.col("expected") + F.col("q10")))).alias("p10"), one(held(F.greatest(mid, F.col("expected") + F.col("q90")))).alias("p90"))


#: Upper ends, in 1/65536, of the numbers that a 16-bit draw turns into a weight of 0, 1, 2, ...: the Poisson distribution of mean 1.
POISSON = [round(65536 * sum(1 / factorial(j) for j in range(k + 1)) / e) for k in range(9)]


def _draw_sums(draws: int):
    """b, w, wd: each draw's sums of weights and of weights times differences, over the rows of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = -(-draws // 8)
        w, wd = np.zeros(8 * blocks), np.zeros(8 * blocks)
        for batch in batches:
            ids, d = batch.column("id").to_pylist(), np.asarray(batch.column("d"), float)
            for k in range(0, len(ids), 256):
                own = [f"{x}:" for x in ids[k : k + 256]]
                bits = b"".join(md5(f"{x}{j}".encode()).digest() for x in own for j in range(blocks))
                weight = np.searchsorted(POISSON, np.frombuffer(bits, ">u2").reshape(len(own), -1), "right")
                w += weight.sum(0)
                wd += d[k : k + 256] @ weight
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(draws)), pa.array(w[:draws]), pa.array(wd[:draws])], names=["b", "w", "wd"])

    return run


def bootstrap(differences: DataFrame, draws: int = 10_000) -> DataFrame:
    """draws, mean, low, high: the mean of ``d`` resampled ``draws`` times, and its central 95 per cent.

    ``differences``: id, which occurs once, and d. A draw takes each row as often as a Poisson number of mean 1 says, the form of
    resampling with replacement that needs neither the number of rows nor their order. The number comes from 16 bits of the md5 of
    id and draw. Each task sums its rows' weights for all draws, so one row a task and draw is what moves; empty draws are left out.
    """
    rows = differences.select(F.col("id").cast("string").alias("id"), F.col("d").cast("double").alias("d")).filter("d is not null")
    sums = _on_all_cores(rows).mapInArrow(_draw_sums(draws), "b long, w double, wd double").groupBy("b").agg(F.sum("w").alias("w"), F.sum("wd").alias("wd"))
    means = sums.filter("w > 0").select((F.col("wd") / F.col("w")).alias("m"))
    return means.agg(F.count(F.lit(1)).alias("draws"), _grid(F.avg("m")).alias("mean"), _grid(F.percentile("m", F.lit(0.025))).alias("low"), _grid(F.percentile("m", F.lit(0.975))).alias("high"))


def paired_wins(predictions: DataFrame, first: str, second: str) -> DataFrame:
    """One row: events where the first model's absolute error is the smaller, of how many."""
    own = predictions.groupBy("event_id").pivot("model", [first, second]).agg(F.first(F.abs(F.col("residual"))))
    return own.agg(F.sum(F.when(F.col(f"`{first}`") < F.col(f"`{second}`"), 1).otherwise(0)).alias("wins"), F.count(F.lit(1)).alias("events"))


#: Rounds of boosting at most, and at least in a final fit.
MOST_ROUNDS, LEAST_ROUNDS = 350, 25
#: A further tree must lower the held-back loss by this share of it.
LEAST_GAIN = 1e-4
#: Weight of a further tree, and share of the rows that a tree is fitted to.
STEP, SHARE = 0.035, 0.85


def pipeline(kind: str, categorical: list[str], numeric: list[str], n_rows: int, rounds: int = MOST_ROUNDS, held: str | None = None) -> Pipeline:
    """An MLlib pipeline: one-hot categories (unknown ones all zero), scaled numbers, a classifier.

    ``logistic`` has the penalty 1 / (0.35 n); ``boosted`` stands in for the boosted trees that other libraries would fit:
    depth 3, step 0.035, up to ``rounds`` trees. ``held`` names a boolean column: rows where it is true are not fitted to, and
    boosting stops when a tree no longer helps them.
    """
    index = StringIndexer(inputCols=categorical, outputCols=[f"{c}_i" for c in categorical], handleInvalid="keep")
    hot = OneHotEncoder(inputCols=[f"{c}_i" for c in categorical], outputCols=[f"{c}_v" for c in categorical], dropLast=True)
    gather = VectorAssembler(inputCols=numeric, outputCol="numbers", handleInvalid="keep")
    scale = StandardScaler(inputCol="numbers", outputCol="scaled", withMean=True)
    join = VectorAssembler(inputCols=[*[f"{c}_v" for c in categorical], "scaled"], outputCol="features", handleInvalid="keep")
    if kind == "logistic":
        model = LogisticRegression(regParam=1 / (0.35 * max(n_rows, 1)), elasticNetParam=0.0, standardization=False, maxIter=100)
    elif kind == "boosted":
        model = GBTClassifier(maxDepth=3, stepSize=STEP, maxIter=rounds, subsamplingRate=SHARE, seed=7, validationTol=LEAST_GAIN)
        model = model.setValidationIndicatorCol(held) if held else model
    else:
        raise ValueError(kind)
    return Pipeline(stages=[index, hot, gather, scale, join, model])


def _model_rows(labelled: DataFrame, categorical: list[str], numeric: list[str]) -> DataFrame:
    numbers = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in [*numeric, "label"]}
    return labelled.withColumns({**numbers, **{c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in categorical}})


@dataclass(frozen=True)
class Folds:
    """Rows scored by models that did not see their group, and the trees of each fold's model (1 each for others)."""

    scored: DataFrame
    rounds: list[int]

    @property
    def final_rounds(self) -> int:
        """The median of the folds' rounds, ``LEAST_ROUNDS`` at least."""
        return max(LEAST_ROUNDS, int(median(self.rounds)))


def fit_folds(labelled: DataFrame, fold_of: DataFrame, group: str, kind: str, categorical: list[str], numeric: list[str], folds: int = FOLDS, rounds: int = MOST_ROUNDS) -> Folds:
    """A model for each fold, fitted on the others; a boosted one stops by its own fold's loss.

    Rows are computed once for all fits. Boosted folds grow side by side in the same jobs (``boosting``), by MLlib's rule; linear
    ones are fitted one after the other, as each keeps its rows in memory and, beyond that, on disk. An error is raised if a row is
    left without a score.
    """
    rows = _once_for_fits(_model_rows(labelled, categorical, numeric).join(shuffled(fold_of), group))
    n, out, trees = rows.count(), None, []
    if kind == "boosted":
        bins, models = boosting.fit_folds(rows, categorical, numeric, folds, rounds, STEP, SHARE, LEAST_GAIN)
        trees = [len(models[k]) for k in range(folds)]
        out = boosting.scored(rows, bins, models, STEP).select(*labelled.columns, "fold", "p")
    else:
        for k in range(folds):
            fitted = pipeline(kind, categorical, numeric, n).fit(rows.filter(F.col("fold") != k))
            trees.append(1)
            part = fitted.transform(rows.filter(F.col("fold") == k)).withColumn("p", vector_to_array("probability")[1]).select(*labelled.columns, "fold", "p")
            out = part if out is None else out.unionByName(part)
    out = once(out)
    scored = out.filter("p is not null").count()
    if scored != n or n != labelled.count():
        raise ValueError(f"{scored} of {labelled.count()} rows have a score")
    return Folds(out, trees)


def oof_model(labelled: DataFrame, fold_of: DataFrame, group: str, kind: str, categorical: list[str], numeric: list[str], folds: int = FOLDS) -> DataFrame:
    """Each row scored by a model fitted on the other folds."""
    return fit_folds(labelled, fold_of, group, kind, categorical, numeric, folds).scored


def final_fit(labelled: DataFrame, kind: str, categorical: list[str], numeric: list[str], rounds: int = MOST_ROUNDS) -> PipelineModel:
    """A model of all rows; a boosted one has just ``rounds`` trees."""
    rows = _once_for_fits(_model_rows(labelled, categorical, numeric))
    return pipeline(kind, categorical, numeric, rows.count(), rounds).fit(rows)


def score(fitted: PipelineModel, rows: DataFrame, categorical: list[str], numeric: list[str]) -> DataFrame:
    """``rows`` with p, held within 1e-6 of 0 and 1."""
    table = rows if "label" in rows.columns else rows.withColumn("label", F.lit(0))
    p = clip_probability(vector_to_array("probability")[1]).alias("p")
    return fitted.transform(_model_rows(table, categorical, numeric)).select(*rows.columns, p)


def feature_importance(fitted: PipelineModel, rows: DataFrame, categorical: list[str], numeric: list[str]) -> DataFrame:
    """feature, importance, share, rank: what each source column adds to a fitted pipeline.

    A vector's slots are named by its ML attributes; those of a column's categories add up to the column, scaled numbers are in
    order. Trees give their own importance, a linear model the absolute coefficients. One row a feature, so made on the driver.
    """
    model = fitted.stages[-1]
    values = model.featureImportances.toArray() if hasattr(model, "featureImportances") else np.abs(model.coefficients.toArray())
    schema = fitted.transform(_model_rows(rows.limit(0), categorical, numeric)).schema
    attributes = [a for kind in schema["features"].metadata["ml_attr"]["attrs"].values() for a in kind]
    total = dict.fromkeys([*categorical, *numeric], 0.0)
    for a in attributes:
        name = a.get("name", "")
        column = numeric[int(name.removeprefix("scaled_"))] if name.startswith("scaled_") else next(c for c in sorted(categorical, key=len, reverse=True) if name.startswith(f"{c}_v_"))
        total[column] += float(values[a["idx"]])
    whole = sum(total.values()) or 1.0
    ordered = sorted(total.items(), key=lambda x: (-x[1], x[0]))
    return rows.sparkSession.createDataFrame([(n, v, v / whole, k) for k, (n, v) in enumerate(ordered, 1)], "feature string, importance double, share double, rank int")
