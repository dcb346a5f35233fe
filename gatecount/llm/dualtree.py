"""Hard negatives by an exact dual-tree search over integer inner products.

Rows are dealt to the leaves of a tree over the vectors and packed into blocks of neighbours; anchors are packed into
groups of neighbours. Groups and blocks are the top nodes of two trees: a pair of them is opened only if the interval
of its inner products, from boxes and balls, can hold something better than what each anchor of the group has. Within
an opened pair both nodes are halved down to leaves under the same test, and pairs of leaves are scored exactly. Each
search runs twice: over the few most promising blocks of a group, which gives each anchor a bound to beat, and then over
all other blocks that the bounds don't rule out. Boxes of blocks are streamed from the shared folder, not broadcast.

Odd rows: null labels, null or empty vectors, and null or non-finite components take no part; nor do vectors whose squared length
passes 2**62 after the step to integers, since their products may not fit a long. Vectors of different lengths don't
compare. A null id is no anchor, keeps its label, and comes last among ties. Rows that repeat an id are rows of their
own: an anchor that occurs twice gives its rows twice, and each is a candidate of the other.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.dataset as ds
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import arrow_place, bounded_batches, discard, folder, partitions, saved, saved_in_turn
from .text import mix

BLOCK_ROWS, GROUP_ROWS = 4096, 256
#: Rows of a leaf of the anchors' and of the candidates' tree.
ANCHOR_LEAF, LEAF = 32, 256
#: Rows on which the tree of neighbourhoods is fitted, and its most leaves; they shape blocks, never results.
SAMPLE_ROWS, MOST_LEAVES = 8192, 4096
SEED_BLOCKS = 4
LONGEST = 2.0**62
_LOW, _HIGH = -(1 << 63), (1 << 63) - 1
_EXACT = 2.0**53

OUTPUT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
_BOX = "lo binary, hi binary, centre binary, radius double, low_id long"
_ROWS = "dim int, n int, ids binary, labels binary, q binary, width int"


# --- integers, trees and blocks ----------------------------------------------------------------------


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(values with NaN for nulls, offsets, rows that are null) of a list column."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.values.cast(pa.float64()).fill_null(float("nan")).to_numpy(zero_copy_only=False)
    return values, np.asarray(column.offsets, np.int64), np.asarray(column.is_null())


def _points(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """vec_id, label, dim, q: vectors that take part, as 64-bit integers."""
    for batch in batches:
        values, offsets, null = _lists(batch.column("embedding"))
        size = np.where(null, 0, np.diff(offsets))
        rows: list[np.ndarray] = []
        blobs: list[bytes] = []
        for dim in np.unique(size[size > 0]):
            at = np.flatnonzero(size == dim)
            with np.errstate(over="ignore", invalid="ignore"):
                x = np.floor(values[offsets[at][:, None] + np.arange(dim)] * 256.0)
                held = np.isfinite(x).all(1) & (np.square(x).sum(1) <= LONGEST)
            rows.append(at[held])
            blobs += [r.tobytes() for r in x[held].astype(np.int64)]
        take = pa.array(np.concatenate(rows) if rows else np.zeros(0, np.int64))
        dims = pa.array([len(b) // 8 for b in blobs], pa.int32())
        yield pa.RecordBatch.from_arrays([batch.column("vec_id").take(take), batch.column("label").take(take), dims, pa.array(blobs, pa.binary())], names=["vec_id", "label", "dim", "q"])


def fit_tree(sample: list[np.ndarray], leaves: int) -> tuple[int, np.ndarray, np.ndarray]:
    """(width, coordinate, threshold) of a binary tree in heap order: medians of the coordinate that varies most.

    Shorter vectors are filled with zeros and longer ones cut to ``width`` for this tree alone.
    """
    width = max((len(v) for v in sample), default=1)
    x = np.zeros((len(sample), width))
    for k, v in enumerate(sample):
        x[k, : len(v)] = v
    nodes = max(leaves - 1, 0)
    axis, cut = np.zeros(nodes, np.int64), np.zeros(nodes)
    members = {0: np.arange(len(x))}
    for k in range(nodes):
        own = members.pop(k)
        if len(own):
            axis[k] = int(np.argmax(x[own].var(0)))
            cut[k] = float(np.median(x[own, axis[k]]))
        right = x[own, axis[k]] > cut[k]
        members[2 * k + 1], members[2 * k + 2] = own[~right], own[right]
    return width, axis, cut


def leaf_of(x: np.ndarray, tree: tuple[int, np.ndarray, np.ndarray]) -> np.ndarray:
    width, axis, cut = tree
    if x.shape[1] < width:
        x = np.pad(x, ((0, 0), (0, width - x.shape[1])))
    node = np.zeros(len(x), np.int64)
    while len(axis) and (inner := node < len(axis)).any():
        at = node[inner]
        node[inner] = 2 * at + 1 + (x[inner, axis[at]] > cut[at])
    return node - len(axis)


def _halves(x: np.ndarray, leaf: int) -> np.ndarray:
    """An order of rows whose contiguous halves, down to ``leaf`` rows, are neighbours: split at medians of the widest coordinate."""
    order, todo = np.arange(len(x)), [(0, len(x))]
    while todo:
        a, b = todo.pop()
        if b - a <= leaf:
            continue
        own = x[order[a:b]]
        axis = int(np.argmax(own.max(0) - own.min(0)))
        middle = _middle(a, b, leaf)
        order[a:b] = order[a:b][np.argsort(own[:, axis], kind="stable")]
        todo += [(a, middle), (middle, b)]
    return order


def _middle(a: int, b: int, leaf: int) -> int:
    """Where a node is halved: a whole number of leaves stands on its left."""
    return a + leaf * max(1, ((b - a + leaf - 1) // leaf) // 2)


def _box(x: np.ndarray, ids: np.ndarray) -> dict[str, object]:
    centre = x.mean(0)
    radius = float(np.sqrt(np.square(x - centre).sum(1).max()))
    return {"lo": x.min(0).tobytes(), "hi": x.max(0).tobytes(), "centre": centre.tobytes(), "radius": radius, "low_id": int(ids.min())}


def _packed(x: np.ndarray) -> tuple[bytes, int]:
    """Integers in the narrowest of 2, 4 or 8 bytes that holds them all."""
    width = next(w for w in (2, 4, 8) if w == 8 or (-(1 << (8 * w - 1)) <= x.min() and x.max() < 1 << (8 * w - 1)))
    return x.astype(f"<i{width}").tobytes(), width


def _unpacked(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, labels, vectors) of a block or group."""
    x = np.frombuffer(row["q"], f"<i{row['width']}").astype(np.int64).reshape(row["n"], row["dim"])
    return np.frombuffer(row["ids"], np.int64), np.frombuffer(row["labels"], np.int64), x


def _node(number: int, dim: int, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, order: np.ndarray) -> dict[str, object]:
    ids, labels, x = ids[order], labels[order], np.ascontiguousarray(x[order])
    q, width = _packed(x)
    return {"number": number, "dim": dim, "n": len(x), "ids": ids.tobytes(), "labels": labels.tobytes(), "q": q, "width": width, **_box(x, ids)}


def _arrow(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


_ARROW = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "binary": pa.binary()}


def _schema(text: str) -> pa.Schema:
    return pa.schema([(n, _ARROW[t]) for n, t in (x.split() for x in text.split(", "))])


BLOCK = f"number long, {_ROWS}, {_BOX}"
GROUP = f"{BLOCK}, blocks binary, places binary"


def _pack_blocks(block_rows: int):
    """Consecutive rows of one leaf as blocks of at most ``block_rows``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, number, held, key = _schema(BLOCK), TaskContext.get().partitionId() << 32, [], None

        def block() -> dict[str, object]:
            ids, labels = (np.array([r[k] for r in held], np.int64) for k in (0, 1))
            x = np.frombuffer(b"".join(r[2] for r in held), np.int64).reshape(len(held), -1)
            return _node(number, x.shape[1], ids, labels, x, _halves(x, LEAF))

        for batch in batches:
            for vec_id, label, dim, leaf, q in zip(*[batch.column(c).to_pylist() for c in ("vec_id", "label", "dim", "leaf", "q")], strict=True):
                if held and ((dim, leaf) != key or len(held) == block_rows):
                    yield _arrow([block()], schema)
                    number, held = number + 1, []
                key = (dim, leaf)
                held.append((_HIGH if vec_id is None else vec_id, label, q))
        if held:
            yield _arrow([block()], schema)

    return run


def _pack_groups(every: int, group_rows: int):
    """Rows of blocks whose id is a multiple of ``every``, as groups of at most ``group_rows``, with their places in the blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, number = _schema(GROUP), TaskContext.get().partitionId() << 32
        held: list[tuple] = []

        def group() -> dict[str, object]:
            ids, labels, block, place = (np.array([r[k] for r in held], np.int64) for k in range(4))
            x = np.stack([r[4] for r in held])
            order = _halves(x, ANCHOR_LEAF)
            return {**_node(number, x.shape[1], ids, labels, x, order), "blocks": block[order].tobytes(), "places": place[order].tobytes()}

        for batch in batches:
            for row in batch.to_pylist():
                ids, labels, x = _unpacked(row)
                for k in np.flatnonzero((ids % every == 0) & (ids != _HIGH)):
                    if held and (len(held) == group_rows or len(held[0][4]) != row["dim"]):
                        yield _arrow([group()], schema)
                        number, held = number + 1, []
                    held.append((ids[k], labels[k], row["number"], k, x[k]))
        if held:
            yield _arrow([group()], schema)

    return run


# --- bounds ------------------------------------------------------------------------------------------


def interval(alo: np.ndarray, ahi: np.ndarray, blo: np.ndarray, bhi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of points of two boxes of integers, over the last axis.

    Exact below 2**53; beyond, widened by more than the rounding.
    """
    a, b = (alo.astype(np.float64), ahi.astype(np.float64)), (blo.astype(np.float64), bhi.astype(np.float64))
    corners = [x * y for x in a for y in b]
    low, high = reduce(np.minimum, corners).sum(-1), reduce(np.maximum, corners).sum(-1)
    most = reduce(np.maximum, [np.abs(c) for c in corners]).sum(-1)
    slack = np.where(most < _EXACT, 0.0, most * 1e-12)
    return low - slack, high + slack


def ball_bound(a: np.ndarray, ra: float, b: np.ndarray, rb: np.ndarray) -> np.ndarray:
    """Upper bounds on inner products of points of a ball with those of each of many balls."""
    na, nb = np.linalg.norm(a), np.linalg.norm(b, axis=-1)
    bound = b @ a + ra * nb + rb * na + ra * rb
    return bound + 1 + (na + ra) * (nb + rb) * 1e-9


class Windows:
    """What the anchors of a group still look for: per window an anchor's slot, a cap, a least score, and the fifth best so far.

    ``least`` follows from the cap where a cap is given: 80 * cap <= 100 * score.
    """

    def __init__(self, rows: list[dict], capped: bool):
        self.slot, self.j = (np.array([r[k] for r in rows], np.int64) for k in ("slot", "j"))
        self.cap, self.kth, self.kth_id = (np.array([r[k] for r in rows], np.int64) for k in ("cap", "kth", "kth_id"))
        least = [-((-4 * int(c)) // 5) if capped else _LOW for c in self.cap]
        self.least = np.array(least, np.int64)

    def rules_out(self, low: float, high: float, low_id: int, own: np.ndarray) -> bool:
        """Whether no score in [low, high] of rows with ids from ``low_id`` is of use to any of the windows ``own``."""
        if not len(own):
            return True
        kth, least = self.kth[own], self.least[own]
        beaten = (high < kth.astype(np.float64)) | ((high == kth) & (low_id > self.kth_id[own]))
        return bool((beaten | (high < least.astype(np.float64)) | (low > self.cap[own].astype(np.float64))).all())


def _node_pairs(blocks_at: str, capped: bool, seeds: int | None):
    """(group, block) pairs: the ``seeds`` most promising blocks of each group, or all that its windows don't rule out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, place = arrow_place(blocks_at)
        schema = _schema("gid long, bid long")
        for batch in batches:
            groups = []
            for row in batch.to_pylist():
                own = Windows(row["w"], capped)
                groups.append((row, own, [np.frombuffer(row[c], np.int64) for c in ("lo", "hi")], np.frombuffer(row["centre"], np.float64), []))
            for boxes in ds.dataset(place, filesystem=store, format="parquet").to_batches(columns=["number", "dim", "lo", "hi", "centre", "radius", "low_id"], batch_size=1024):
                rows = boxes.to_pylist()
                for dim in {r["dim"] for r in rows}:
                    some = [r for r in rows if r["dim"] == dim]
                    lo, hi = (np.frombuffer(b"".join(r[c] for r in some), np.int64).reshape(-1, dim) for c in ("lo", "hi"))
                    centre, radius = np.frombuffer(b"".join(r["centre"] for r in some), np.float64).reshape(-1, dim), np.array([r["radius"] for r in some])
                    for row, own, box, middle, best in groups:
                        if row["dim"] != dim:
                            continue
                        low, high = interval(*box, lo, hi)
                        high = np.minimum(high, ball_bound(middle, row["radius"], centre, radius))
                        every = np.arange(len(own.slot))
                        fits = [k for k in range(len(some)) if not own.rules_out(low[k], high[k], some[k]["low_id"], every)]
                        best += [(-high[k], some[k]["low_id"], some[k]["number"]) for k in fits]
                        if seeds:
                            best.sort()
                            del best[seeds:]
                if not seeds:
                    for row, *_, best in groups:
                        if best:
                            yield _arrow([{"gid": row["number"], "bid": b} for _, _, b in best], schema)
                            best.clear()
            for row, *_, best in groups:
                if best:
                    yield _arrow([{"gid": row["number"], "bid": b} for _, _, b in best], schema)

    return run


# --- the search --------------------------------------------------------------------------------------


class _Tree:
    """Contiguous halves of rows down to leaves, with the box and the least id of each node, computed when asked for."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, leaf: int):
        self.x, self.ids, self.leaf, self.known = x, ids, leaf, {}

    def box(self, node: tuple[int, int]) -> tuple[np.ndarray, np.ndarray, int]:
        if node not in self.known:
            parts = self.children(node)
            if parts:
                (l1, h1, i1), (l2, h2, i2) = (self.box(p) for p in parts)
                self.known[node] = np.minimum(l1, l2), np.maximum(h1, h2), min(i1, i2)
            else:
                own = self.x[slice(*node)]
                self.known[node] = own.min(0), own.max(0), int(self.ids[slice(*node)].min())
        return self.known[node]

    def children(self, node: tuple[int, int]) -> list[tuple[int, int]]:
        a, b = node
        middle = _middle(a, b, self.leaf)
        return [(a, middle), (middle, b)] if b - a > self.leaf else []


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products; in doubles where no partial sum can pass 2**53."""
    if float(np.square(a.astype(np.float64)).sum(1).max()) * float(np.square(b.astype(np.float64)).sum(1).max()) < _EXACT**2 / 4:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


def search_pair(group: dict, block: dict, own: Windows, same_label: bool, best: int = 5) -> list[tuple[int, int, int, int]]:
    """(slot, j, id, score): of each window the up to ``best`` rows of a block that come first and beat what it has.

    Scores fall, then ids rise. Both trees are walked together, the larger node halved first; nearer
    pairs are opened before others, and raise the windows' bounds for those.
    """
    a_ids, a_labels, a_x = _unpacked(group)
    b_ids, b_labels, b_x = _unpacked(block)
    a_block, a_place = (np.frombuffer(group[c], np.int64) for c in ("blocks", "places"))
    anchors, rows = _Tree(a_x, a_ids, ANCHOR_LEAF), _Tree(b_x, b_ids, LEAF)
    top_score = np.full((len(own.slot), best), _LOW, np.int64)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    todo = [((0, len(a_x)), (0, len(b_x)))]
    while todo:
        a, b = todo.pop()
        windows = np.flatnonzero((own.slot >= a[0]) & (own.slot < a[1]))
        (alo, ahi, _), (blo, bhi, low_id) = anchors.box(a), rows.box(b)
        low, high = interval(alo, ahi, blo, bhi)
        if own.rules_out(float(low), float(high), low_id, windows):
            continue
        left, right = anchors.children(a), rows.children(b)
        if right and (b[1] - b[0] >= a[1] - a[0] or not left):
            todo += sorted(((a, part) for part in right), key=lambda p: interval(alo, ahi, *rows.box(p[1])[:2])[1])
            continue
        if left:
            todo += [(part, b) for part in left]
            continue
        score = _products(a_x[slice(*a)], b_x[slice(*b)])[own.slot[windows] - a[0]]
        usable = (a_labels[own.slot[windows], None] == b_labels[None, slice(*b)]) == same_label
        if same_label:
            here = own.slot[windows][:, None]
            usable &= ~((a_block[here] == block["number"]) & (a_place[here] == np.arange(*b)[None, :]))
        usable &= (score <= own.cap[windows, None]) & (score >= own.least[windows, None]) & (score >= own.kth[windows, None])
        w, k = np.nonzero(usable)
        if not len(w):
            continue
        value, ids = score[w, k], b_ids[b[0] + k]
        order = np.lexsort((ids, -value, w))
        w, value, ids = w[order], value[order], ids[order]
        first = np.searchsorted(w, np.arange(len(windows)))
        place = np.arange(len(w)) - first[w]
        w, value, ids, place = (x[place < best] for x in (w, value, ids, place))
        found.append((windows[w], ids, value))
        new = np.full((len(windows), best), _LOW, np.int64)
        new[w, place] = value
        merged = -np.sort(-np.concatenate([top_score[windows], new], 1), 1)[:, :best]
        top_score[windows] = merged
        better = merged[:, -1] > own.kth[windows]
        own.kth[windows[better]] = merged[better, -1]
        own.kth_id[windows[better]] = _HIGH  # equal scores with any id stay in play
    if not found:
        return []
    w, ids, value = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((ids, -value, w))
    w, ids, value = w[order], ids[order], value[order]
    keep = np.arange(len(w)) - np.searchsorted(w, w) < best
    return list(zip(own.slot[w[keep]].tolist(), own.j[w[keep]].tolist(), ids[keep].tolist(), value[keep].tolist(), strict=True))


def _score_pairs(capped: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = _schema("gid long, slot int, j int, id long, score long")
        for batch in batches:
            for row in batch.to_pylist():
                got = search_pair(row["g"], row["b"], Windows(row["w"], capped), same_label=not capped)
                if got:
                    yield _arrow([{"gid": row["g"]["number"], "slot": s, "j": j, "id": i, "score": v} for s, j, i, v in got], schema)

    return run


def _first(found: DataFrame, best: int = 5) -> DataFrame:
    """Rows of each window in order of score and id, the first ``best``, with their place ``k`` from 1."""
    order = Window.partitionBy("gid", "slot", "j").orderBy(F.desc("score"), F.asc("id"))
    return found.withColumn("k", F.row_number().over(order)).filter(F.col("k") <= best)


def _search(groups: DataFrame, blocks: DataFrame, blocks_at: str, windows: DataFrame, capped: bool) -> DataFrame:
    """gid, slot, j, id, score, k: what each window (gid, slot, j, cap) finds; ``capped`` windows take other labels up to their cap."""
    columns = ["slot", "j", "cap", "kth", "kth_id"]

    def packed(w: DataFrame) -> DataFrame:
        return w.groupBy(F.col("gid").alias("number")).agg(F.collect_list(F.struct(*columns)).alias("w"))  # a window or five for each of a group's rows

    def pairs(w: DataFrame, seeds: int | None) -> DataFrame:
        boxes = groups.select("number", "dim", "lo", "hi", "centre", "radius").join(packed(w), "number")
        return boxes.repartition(partitions(groups.sparkSession), "number").mapInArrow(_node_pairs(blocks_at, capped, seeds), "gid long, bid long")

    def scored(chosen: DataFrame, w: DataFrame) -> DataFrame:
        g = groups.select(F.col("number").alias("gid"), F.struct("number", *[x.split()[0] for x in _ROWS.split(", ")], "blocks", "places").alias("g"))
        b = blocks.select(F.col("number").alias("bid"), F.struct("number", *[x.split()[0] for x in _ROWS.split(", ")]).alias("b"))
        work = chosen.join(g, "gid").join(packed(w).withColumnRenamed("number", "gid"), "gid").join(b, "bid")
        return work.select("g", "w", "b").mapInArrow(_score_pairs(capped), "gid long, slot int, j int, id long, score long")

    fresh = windows.withColumns({"kth": F.lit(_LOW).cast("long"), "kth_id": F.lit(_HIGH).cast("long")})
    seeds = saved(pairs(fresh, SEED_BLOCKS), "tree-seeds", narrow=True)
    near = saved(scored(seeds, fresh), "tree-near", narrow=True)
    fifth = _first(near).filter("k = 5").select("gid", "slot", "j", F.col("score").alias("kth"), F.col("id").alias("kth_id"))
    raised = windows.join(fifth, ["gid", "slot", "j"], "left").withColumns({"kth": F.coalesce("kth", F.lit(_LOW)), "kth_id": F.coalesce("kth_id", F.lit(_HIGH))})
    raised = saved(raised, "tree-windows", narrow=True)
    others = saved(pairs(raised, None).join(seeds, ["gid", "bid"], "left_anti"), "tree-pairs", narrow=True)
    out = saved(_first(near.unionByName(scored(others, raised))), "tree-found", narrow=True)
    discard(seeds, near, raised, others)
    return out


def mine(vectors: DataFrame, shown: Column | None = None, every: int = 100, block_rows: int = BLOCK_ROWS, group_rows: int = GROUP_ROWS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of the hard negatives of ``vectors``.

    ``vectors``: vec_id, embedding, label; ``shown`` is the label to use, in place of the column. Anchors are rows whose
    id is a multiple of ``every``. Positives are an anchor's first five other rows with its label, and to each positive
    the first five rows with another label that score 80 to 100 per cent of it are returned. First means by score, then by id.
    """
    spark = vectors.sparkSession
    bounded_batches(spark)
    label = F.col("label") if shown is None else shown
    own = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", label.cast("long").alias("label")).filter("label is not null and embedding is not null")
    points = saved(own.mapInArrow(_points, "vec_id long, label long, dim int, q binary"), "tree-points")
    n = points.count()
    if not n:
        return spark.createDataFrame([], OUTPUT)
    sample = points.select("q").sample(min(1.0, 2 * SAMPLE_ROWS / n), seed=1).limit(SAMPLE_ROWS).collect()
    leaves = 1 << max(0, min(MOST_LEAVES, n // block_rows).bit_length() - 1)
    tree = fit_tree([np.frombuffer(r.q, np.int64) for r in sample], leaves)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs, dims = batch.column("q").to_pylist(), np.asarray(batch.column("dim"))
            leaf = np.zeros(len(blobs), np.int64)
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                leaf[at] = leaf_of(np.frombuffer(b"".join(blobs[k] for k in at), np.int64).reshape(-1, dim).astype(np.float64), tree)
            salt = mix(np.arange(len(blobs), dtype=np.uint64)) >> np.uint64(33)  # parts rows that nothing else tells apart
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf, pa.int32()), pa.array(salt.astype(np.int64))], names=[*batch.schema.names, "leaf", "salt"])

    keys = ["dim", "leaf", "vec_id", "salt"]
    dealt = points.mapInArrow(place, "vec_id long, label long, dim int, q binary, leaf int, salt long").repartitionByRange(partitions(spark), *keys).sortWithinPartitions(*keys)
    blocks_at = folder(spark, "tree-blocks")
    blocks = saved_in_turn([dealt.mapInArrow(_pack_blocks(block_rows), BLOCK)], blocks_at)
    groups = saved(blocks.select("number", *[x.split()[0] for x in _ROWS.split(", ")]).mapInArrow(_pack_groups(every, group_rows), GROUP), "tree-groups")
    discard(points)

    slots = groups.select(F.col("number").alias("gid"), F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("slot"))
    positives = _search(groups, blocks, blocks_at, slots.withColumns({"j": F.lit(0), "cap": F.lit(_HIGH).cast("long")}), capped=False)
    capped = positives.select("gid", "slot", F.col("k").alias("j"), F.col("score").alias("cap"))
    negatives = _search(groups, blocks, blocks_at, capped, capped=True)

    def ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                some = np.frombuffer(row["ids"], np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), row["number"])), pa.array(np.arange(len(some)), pa.int32()), pa.array(some)], names=["gid", "slot", "anchor_id"])

    named = groups.select("number", "ids").mapInArrow(ids, "gid long, slot int, anchor_id long")
    own = positives.select("gid", "slot", F.col("k").alias("j"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    rows = negatives.select("gid", "slot", "j", F.col("k").cast("int").alias("rank"), F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    known = lambda c: F.nullif(F.col(c), F.lit(_HIGH)).alias(c)
    out = rows.join(own, ["gid", "slot", "j"]).join(named, ["gid", "slot"]).select("anchor_id", known("positive_id"), "rank", known("negative_id"), "positive_score", "negative_score")
    out = saved(out, "tree-negatives", narrow=True)
    discard(blocks, groups, positives, negatives)
    return out


def shifted_label(vec_id: Column, label: Column) -> Column:
    """(label + 1) % 10 where the id is a multiple of 7, the label elsewhere."""
    own = label.cast("long")
    return F.when(vec_id % 7 == 0, (own + 1) % 10).otherwise(own)
