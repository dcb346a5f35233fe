"""Boosted trees of all folds at once: a Spark job for each level of a round's trees, whatever the number of folds.

The rule is that of MLlib's ``GBTClassifier``: regression trees by variance on the log loss, leaves are means, the first tree has
weight 1 and the others the step. MLlib fits one fold at a time, row by row and slot by slot, and makes bins for each; here rows
are binned once into blocks, and a pass over the blocks sums the residuals of every fold in numpy. What moves is one table of
sums a task: folds x nodes x bins. A category's slot is a bin of its column, split off from the others as its one-hot slot would be.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEPTH, BINS = 3, 32
#: Rounds after which the scores so far are stored, so that a lost executor costs no more of them.
STORED_EVERY = 25


@dataclass(frozen=True)
class Bins:
    """How columns become bins: a category's place in its list (one more for others), a number's place among edges."""

    categorical: dict[str, list[str]]
    numeric: dict[str, np.ndarray]

    @property
    def sizes(self) -> list[int]:
        return [len(x) + 1 for x in (*self.categorical.values(), *self.numeric.values())]

    def of(self, batch: pa.RecordBatch) -> np.ndarray:
        kind = np.uint8 if max(self.sizes) <= 256 else np.uint32
        out = np.empty((batch.num_rows, len(self.sizes)), kind, order="F")
        for j, (c, known) in enumerate(self.categorical.items()):
            place = {x: k for k, x in enumerate(known)}
            out[:, j] = [place.get(x, len(known)) for x in batch.column(c).to_pylist()]
        for j, (c, edges) in enumerate(self.numeric.items(), len(self.categorical)):
            out[:, j] = np.searchsorted(edges, batch.column(c).to_numpy(zero_copy_only=False))
        return out


def bins_of(rows: DataFrame, categorical: list[str], numeric: list[str]) -> Bins:
    """Bins by the categories that occur and by quantiles of the numbers, over all rows."""
    values = {c: sorted(r[0] for r in rows.select(c).distinct().collect()) for c in categorical}
    edges = rows.approxQuantile(numeric, [k / BINS for k in range(BINS)], 0.1 / BINS) if numeric else []
    return Bins(values, {c: np.unique(x) for c, x in zip(numeric, edges, strict=True)})


@dataclass(frozen=True)
class Tree:
    """Nodes in the order of a heap: a row goes right where the bin of column ``column`` is within ``low`` and ``high``."""

    column: np.ndarray
    low: np.ndarray
    high: np.ndarray
    value: np.ndarray

    def node(self, bins: np.ndarray, depth: int) -> np.ndarray:
        """Each row's node of a level, from 0."""
        at = np.zeros(len(bins), np.int64)
        for level in range(depth):
            own = at + (1 << level) - 1
            x = bins[np.arange(len(bins)), self.column[own]] if level else bins[:, self.column[0]]
            at = 2 * at + ((x >= self.low[own]) & (x <= self.high[own]))
        return at

    def predict(self, bins: np.ndarray) -> np.ndarray:
        return self.value[self.node(bins, DEPTH)]


def _empty() -> Tree:
    inner = (1 << DEPTH) - 1
    return Tree(np.zeros(inner, np.int64), np.ones(inner, np.int64), np.zeros(inner, np.int64), np.zeros(1 << DEPTH))


#: A block: its number, bins, labels (-1 or 1), folds, and each fold's scores.
Block = tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def _blocks(rows: DataFrame, bins: Bins, folds: int) -> RDD:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = bins.of(batch)
            cells = [own.tobytes("F"), batch.column("label").to_numpy().astype(np.int8).tobytes(), batch.column("fold").to_numpy().astype(np.int16).tobytes()]
            yield pa.RecordBatch.from_arrays([pa.array([str(own.dtype)]), *[pa.array([x], pa.binary()) for x in cells]], names=["kind", "x", "y", "fold"])

    def read(part: int, lines: Iterator) -> Iterator[Block]:
        for k, r in enumerate(lines):
            y, fold = np.frombuffer(r.y, np.int8), np.frombuffer(r.fold, np.int16)
            yield (part << 32) + k, np.frombuffer(r.x, r.kind).reshape(len(y), -1, order="F"), 2 * y - 1, fold, np.zeros((folds, len(y)))

    columns = [*bins.categorical, *bins.numeric]
    return rows.select(*columns, F.col("label").cast("int").alias("label"), F.col("fold").cast("int").alias("fold")).mapInArrow(cut, "kind string, x binary, y binary, fold binary").rdd.mapPartitionsWithIndex(read)


def _advance(block: Block, trees: dict[int, Tree], weight: float) -> Block:
    number, x, y, fold, scores = block
    scores = scores.copy()
    for k, tree in trees.items():
        scores[k] += weight * tree.predict(x)
    return number, x, y, fold, scores


def _sums(blocks: Iterator[Block], trees: dict[int, Tree], level: int, first: int, sizes: list[int], share: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows and sums of residuals by fold, node and bin; and each fold's held-back loss and rows, if the level is 0."""
    nodes, ends = 1 << level, np.cumsum([0, *sizes])
    sums, loss = np.zeros((len(trees), 2, nodes, ends[-1])), np.zeros((len(trees), 2))
    for number, x, y, fold, scores in blocks:
        drawn = np.random.default_rng([7, first, number]).random(len(y)) < share
        for i, (k, tree) in enumerate(trees.items()):
            own, margin = fold == k, 2.0 * y * scores[k]
            if not level:
                loss[i] += (2 * np.logaddexp(0, -margin[own])).sum(), own.sum()
            residual = 4.0 * y / (1 + np.exp(np.minimum(margin, 700))) if first else y.astype(float)
            at = np.where(drawn & ~own, tree.node(x, level), nodes)  # what is not fitted to goes to a node that is left out
            for j, size in enumerate(sizes):
                key = at * size + x[:, j]
                cells = slice(ends[j], ends[j + 1])
                sums[i, 0, :, cells] += np.bincount(key, minlength=(nodes + 1) * size)[: nodes * size].reshape(nodes, size)
                sums[i, 1, :, cells] += np.bincount(key, residual, (nodes + 1) * size)[: nodes * size].reshape(nodes, size)
    yield sums, loss


def _best(n: np.ndarray, s: np.ndarray, sizes: list[int], categories: int) -> tuple[int, int, int, float, float] | None:
    """(column, low, high, mean left, mean right) of the split of a node that lowers variance most; none if no split does."""
    rows, total, at, best, out = n[: sizes[0]].sum(), s[: sizes[0]].sum(), 0, 0.0, None
    for j, size in enumerate(sizes):
        own, mine = n[at : at + size], s[at : at + size]
        # what goes right: a category, or all bins from one on
        right, moved = (own, mine) if j < categories else (own[::-1].cumsum()[::-1], mine[::-1].cumsum()[::-1])
        fits = (right > 0) & (right < rows)
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = np.where(fits, moved**2 / right + (total - moved) ** 2 / (rows - right) - total**2 / max(rows, 1), 0.0)
        k = int(gain.argmax())
        if gain[k] > max(best, 1e-9 * rows):
            best, out = gain[k], (j, k, k if j < categories else size, (total - moved[k]) / (rows - right[k]), moved[k] / right[k])
        at += size
    return out


def _grow(tree: Tree, sums: np.ndarray, level: int, sizes: list[int], categories: int) -> None:
    """Splits the nodes of a level; below one that stays whole all rows go left, with the node's mean."""
    for node in range(1 << level):
        n, s = sums[0, node], sums[1, node]
        rows, at = n[: sizes[0]].sum(), (1 << level) - 1 + node
        mean = s[: sizes[0]].sum() / rows if rows else tree.value[node << (DEPTH - level)]
        found = _best(n, s, sizes, categories)
        if found:
            tree.column[at], tree.low[at], tree.high[at] = found[:3]
        means, half = found[3:] if found else (mean, mean), DEPTH - level - 1
        for side in (0, 1):
            tree.value[(2 * node + side) << half : (2 * node + side + 1) << half] = means[side]


def fit_folds(rows: DataFrame, categorical: list[str], numeric: list[str], folds: int, rounds: int, step: float, share: float, least_gain: float) -> tuple[Bins, dict[int, list[Tree]]]:
    """Bins, and the trees of each fold's model of (columns, label 0 or 1, fold), fitted to the other folds' rows.

    ``share`` of the rows are drawn for each round; a model ends with the last tree before one that lowers its own fold's loss by
    less than ``least_gain`` of it.
    """
    bins = bins_of(rows, categorical, numeric)
    sizes, add = bins.sizes, lambda a, b: (a[0] + b[0], a[1] + b[1])
    models: dict[int, list[Tree]] = {k: [] for k in range(folds)}
    least, kept, state = dict.fromkeys(models, np.inf), dict.fromkeys(models, 1), None
    active, m = list(models), 0
    while active:
        new = {k: models[k][-1] for k in models if k in active and models[k]}
        after = _blocks(rows, bins, folds) if state is None else state.map(lambda b, t=new, w=step if m > 1 else 1.0: _advance(b, t, w))
        after = after.persist(StorageLevel.MEMORY_AND_DISK)
        if m and m % STORED_EVERY == 0:
            after.checkpoint()
        grown = {k: _empty() for k in active}
        for level in range(DEPTH):
            own = {k: grown[k] for k in active}
            sums, loss = after.mapPartitions(lambda b, t=own, v=level, r=m: _sums(b, t, v, r, sizes, share)).treeReduce(add)
            if not level and m:
                for i, k in enumerate(list(own)):
                    mean = loss[i, 0] / max(loss[i, 1], 1)
                    if m > 1 and least[k] - mean < least_gain * max(mean, 0.01):
                        active.remove(k)
                    elif mean < least[k]:
                        least[k], kept[k] = mean, m
                if m == rounds:
                    active = []
            if not active:
                break
            for i, k in enumerate(own):
                if k in active:
                    _grow(grown[k], sums[i], level, sizes, len(categorical))
        for k in active:
            models[k].append(grown[k])
        if state is not None:
            state.unpersist()
        state, m = after, m + 1
    state.unpersist()
    return bins, {k: trees[: kept[k]] for k, trees in models.items()}


def scored(rows: DataFrame, bins: Bins, models: dict[int, list[Tree]], step: float) -> DataFrame:
    """``rows`` with p by the model of the row's own fold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, fold, total = bins.of(batch), batch.column("fold").to_numpy(), np.zeros(batch.num_rows)
            for k in np.unique(fold):
                own = fold == k
                part = x[own]
                for m, tree in enumerate(models[k]):
                    total[own] += (step if m else 1.0) * tree.predict(part)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(1 / (1 + np.exp(-2 * total)))], names=[*batch.schema.names, "p"])

    return rows.mapInArrow(run, rows.withColumn("p", F.lit(0.0)).schema)
