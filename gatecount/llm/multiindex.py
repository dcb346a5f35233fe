"""Near-duplicate vectors by an inverted multi-index.

Vectors are cut into two halves, each with its own codebook; the product of the codebooks is a
grid of cells, and every vector is indexed in its cell. A multi-sequence traversal visits the
cells of the grid in rising distance from a query, up to a margin that is measured on a
bounded sample so that the target share of neighbours is met. Candidates are verified by
cosine in double precision, cell by cell, as matrix products.

A pair is met if either vector visits the other's cell. Equal vectors form one class and
are compared once. Full cells are cut into blocks on both sides, so no task holds a whole cell.

Defined results: vectors that are null, empty or zero, or hold null or non-finite numbers, link with nothing and
are components of their own; vectors of different lengths are compared within their lengths, each with an index of its own;
repeated rows are vectors of their own; rows without an id get a null component and aren't kept;
an empty table gives no rows. Only the two named columns are read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .scratch import saved

_SAMPLE = 8192
_MEMBERS, _QUERIES = 1024, 4096
_MOST_CODES = 2048


def multi_sequence(first: np.ndarray, second: np.ndarray, limit: float) -> list[tuple[int, int]]:
    """Grid cells (i, j) in rising order of first[i] + second[j], while that is at most ``limit``."""
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    heap, out, seen = [(first[a[0]] + second[b[0]], 0, 0)], [], {(0, 0)}
    while heap and heap[0][0] <= limit:
        _, i, j = heapq.heappop(heap)
        out.append((int(a[i]), int(b[j])))
        for x, y in ((i + 1, j), (i, j + 1)):
            if x < len(a) and y < len(b) and (x, y) not in seen:
                seen.add((x, y))
                heapq.heappush(heap, (first[a[x]] + second[b[y]], x, y))
    return out


def _squared(x: np.ndarray, codes: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(axis=1)[:, None] - 2 * x @ codes.T + (codes * codes).sum(axis=1)[None], 0)


def _codebook(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """k-means from evenly spaced rows; an empty code stays where it is."""
    codes = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        own = _squared(x, codes).argmin(axis=1)
        n = np.bincount(own, minlength=k)
        sums = np.zeros_like(codes)
        np.add.at(sums, own, x)
        codes[n > 0] = sums[n > 0] / n[n > 0][:, None]
    return codes


class Index:
    """Codebooks of two halves and the margin of the traversal."""

    def __init__(self, sample: np.ndarray, n: int, threshold: float, recall: float):
        dim = sample.shape[1]
        self.half = dim // 2
        k = int(np.clip(round((n / 48) ** 0.5), 1, min(_MOST_CODES, max(1, len(sample) // 4))))
        k = min(k, len(sample))
        self.codes = [_codebook(sample[:, : self.half], k), _codebook(sample[:, self.half :], k)]
        self.k = k
        self.margin = self._measure(sample, threshold, recall)

    def distances(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return _squared(x[:, : self.half], self.codes[0]), _squared(x[:, self.half :], self.codes[1])

    def _excess(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """How far beyond x's nearest cell y's cell is, in x's order."""
        (a, b), (c, d) = self.distances(x), self.distances(y)
        rows = np.arange(len(x))
        return a[rows, c.argmin(axis=1)] + b[rows, d.argmin(axis=1)] - a.min(axis=1) - b.min(axis=1)

    def _measure(self, sample: np.ndarray, threshold: float, recall: float) -> float:
        """The margin that finds ``recall`` of the sample's own links and of as many made up at the threshold."""
        rng = np.random.default_rng(0)
        noise = rng.standard_normal(sample.shape)
        noise -= (noise * sample).sum(axis=1)[:, None] * sample
        noise /= np.maximum(np.linalg.norm(noise, axis=1), 1e-12)[:, None]
        cosine = rng.uniform(threshold, 1, len(sample))[:, None]
        found = [np.minimum(self._excess(sample, y := cosine * sample + np.sqrt(1 - cosine**2) * noise), self._excess(y, sample))]
        pairs = []
        for at in range(0, len(sample), 1024):
            i, j = np.nonzero(sample[at : at + 1024] @ sample.T >= threshold)
            pairs.append(np.stack([i + at, j], axis=1)[i + at < j][:20_000])
        pairs = np.concatenate(pairs)
        if len(pairs) >= 50:
            pairs = pairs[rng.permutation(len(pairs))[:20_000]]
            x, y = sample[pairs[:, 0]], sample[pairs[:, 1]]
            found.append(np.minimum(self._excess(x, y), self._excess(y, x)))
        return float(max(np.quantile(f, recall) for f in found)) * 1.0001 + 1e-9

    def cells(self, x: np.ndarray) -> tuple[np.ndarray, list[list[int]]]:
        """Each row's own cell, and the cells it visits."""
        a, b = self.distances(x)
        own = a.argmin(axis=1) * self.k + b.argmin(axis=1)
        limits = a.min(axis=1) + b.min(axis=1) + self.margin
        return own, [[i * self.k + j for i, j in multi_sequence(p, q, limit)] for p, q, limit in zip(a, b, limits, strict=True)]


def _unit(raw: list[bytes], kind: str) -> np.ndarray:
    x = np.frombuffer(b"".join(raw), kind).reshape(len(raw), -1).astype(np.float64)
    with np.errstate(over="ignore", under="ignore"):
        size = np.linalg.norm(x, axis=1)
    far = ~((size > 1e-150) & (size < 1e150))  # squares overflow or vanish
    if far.any():
        x[far] /= np.abs(x[far]).max(1)[:, None]
        size[far] = np.linalg.norm(x[far], axis=1)
    return x / size[:, None]


def _packed(vectors: DataFrame, kind: str) -> DataFrame:
    """vec_id and raw, the vector's numbers as bytes; raw is null for vectors that link with nothing."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = []
            for v in batch.column(1):
                x = None
                if v.is_valid and len(v) and not v.values.null_count:
                    x = v.values.to_numpy(zero_copy_only=False).astype(kind) + 0  # no negative zeros
                    x = x if np.isfinite(x).all() and x.any() else None
                raw.append(None if x is None else x.tobytes())
            yield pa.record_batch([batch.column(0), pa.array(raw, pa.binary())], names=["vec_id", "raw"])

    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").mapInArrow(pack, "vec_id long, raw binary")


def near_duplicates(vectors: DataFrame, *, threshold: float = 0.95, recall: float = 0.995) -> DataFrame:
    """vec_id, n_links, component_id, kept of each row of ``vectors`` (vec_id, embedding)."""
    kind = "<f8" if "double" in vectors.schema["embedding"].dataType.simpleString() else "<f4"
    every = saved(_packed(vectors, kind).withColumn("key", F.sha1("raw")), "vectors")
    fits = F.col("raw").isNotNull() & F.col("vec_id").isNotNull()
    out = every.filter(~fits).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.coalesce(F.col("vec_id").isNotNull(), F.lit(False)).alias("kept"))
    for (width,) in every.filter(fits).select(F.length("raw").alias("w")).distinct().orderBy("w").collect():
        out = out.unionByName(_of_one_length(every.filter(fits & (F.length("raw") == width)), kind, threshold, recall))
    return out


def _of_one_length(whole: DataFrame, kind: str, threshold: float, recall: float) -> DataFrame:
    """See ``near_duplicates``: of vec_id, raw, key, all of one length."""
    classes = saved(whole.groupBy("key").agg(F.min("vec_id").alias("class"), F.count(F.lit(1)).alias("copies"), F.first("raw").alias("raw")), "vector-classes", narrow=True)
    n = classes.count()
    sample = _unit([r["raw"] for r in classes.orderBy("key").limit(_SAMPLE).select("raw").collect()], kind)
    sent = whole.sparkSession.sparkContext.broadcast(Index(sample, n, threshold, recall))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, visits = sent.value.cells(_unit(batch.column(2).to_pylist(), kind)) if batch.num_rows else (np.zeros(0, int), [])
            yield pa.record_batch([*batch.columns, pa.array(own, pa.int32()), pa.array(visits, pa.list_(pa.int32()))], names=["class", "copies", "raw", "cell", "visits"])

    placed = saved(classes.select("class", "copies", "raw").mapInArrow(place, "class long, copies long, raw binary, cell int, visits array<int>"), "vector-cells")
    # at most as many counts as the grid has cells
    members = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("m")).withColumn("m_blocks", F.ceil(F.col("m") / _MEMBERS).cast("int"))
    queries = placed.select(F.explode("visits").alias("cell")).groupBy("cell").agg(F.count(F.lit(1)).alias("q")).withColumn("q_blocks", F.ceil(F.col("q") / _QUERIES).cast("int"))
    sizes = saved(members.join(queries, "cell").select("cell", "m_blocks", "q_blocks"), "cell-sizes", narrow=True)
    pick = lambda n: F.pmod(F.xxhash64("class"), F.col(n)).cast("int")
    every_block = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = placed.join(sizes, "cell").withColumn("mb", pick("m_blocks")).withColumn("qb", every_block("q_blocks")).select("cell", "mb", "qb", "class", "copies", "raw", "visits")
    right = placed.select(F.col("cell").alias("own"), "class", "copies", "raw", F.explode("visits").alias("cell")).join(sizes, "cell")
    right = right.withColumn("qb", pick("q_blocks")).withColumn("mb", every_block("m_blocks")).select("cell", "mb", "qb", F.col("class").alias("q_class"), F.col("copies").alias("q_copies"), F.col("raw").alias("q_raw"), "own")

    def verify(m: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"class": [], "n": [], "other": []}).astype("int64")
        if m.empty or q.empty:
            return none
        x, y = _unit(m["raw"].tolist(), kind), _unit(q["q_raw"].tolist(), kind)
        m_class, m_copies, q_class, q_copies, own = (df[c].to_numpy() for df, c in ((m, "class"), (m, "copies"), (q, "q_class"), (q, "q_copies"), (q, "own")))
        rank = {c: k for k, c in enumerate(np.unique(own))}
        visited = np.zeros((len(m), len(rank)), bool)
        for k, cells in enumerate(m["visits"]):
            visited[k, [rank[c] for c in cells if c in rank]] = True
        to_query, to_member = np.zeros(len(q), np.int64), np.zeros(len(m), np.int64)
        label, edges = np.arange(len(m)), []
        for at in range(0, len(q), 512):
            part = slice(at, at + 512)
            link = (y[part] @ x.T >= threshold) & (q_class[part, None] != m_class[None])
            if not link.any():
                continue
            to_query[part] = link @ m_copies
            mutual = visited[:, [rank[c] for c in own[part]]].T
            to_member += (link & ~mutual).T @ q_copies[part]
            for k in np.flatnonzero(link.any(axis=1)):
                met = np.unique(label[link[k]])
                edges += [(q_class[at + k], m_class[i]) for i in met]
                if len(met) > 1:
                    label[np.isin(label, met)] = met[0]
        edges = np.array(edges, np.int64).reshape(-1, 2)
        return pd.DataFrame({"class": np.concatenate([q_class, m_class, edges[:, 0]]), "n": np.concatenate([to_query, to_member, np.zeros(len(edges), np.int64)]), "other": np.concatenate([q_class, m_class, edges[:, 1]])}).query("n > 0 or `class` != other")

    by = ("cell", "mb", "qb")
    found = saved(left.groupBy(*by).cogroup(right.groupBy(*by)).applyInPandas(verify, "class long, n long, other long"), "vector-links")
    links = found.groupBy("class").agg(F.sum("n").alias("n"))
    roots = components(found.select(F.col("class").alias("u"), F.col("other").alias("v")))
    known = classes.select("key", "class", "copies").join(links, "class", "left").join(roots, F.col("class") == F.col("node"), "left")
    known = known.select("key", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "class").alias("component_id"))
    out = whole.select("vec_id", "key").join(known, "key")
    return out.select("vec_id", "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept"))
