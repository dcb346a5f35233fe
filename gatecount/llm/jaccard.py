"""Similarity join of documents by the Jaccard index of their word n-gram sets.

Each set is a point: its shingles are hashed into groups, and the counts of the groups are its
coordinates. The overlap of two sets is at most the sum over groups of the smaller count, and the
overlap of two boxes of points at most the sum of the smaller upper corners, which is what an
R-tree over the points prunes by. Larger sets have more groups (one or two shingles
in each); groups are nested, so points of two sizes are compared at the coarser one. Points are
stored with four times the groups, packed; pairs that the tree leaves are bound by those as well.

So that no index spans all documents, the points are dealt to partitions by their rarest shingles:
two sets that link must share one of the first n - ceil(0.75 n) + 1 in any common order. The order
is by frequency, from a sketch of fixed size over all shingles, so that shingles which a great many
documents have come last. The points that share such a shingle are a list:

1. Equal sets are one class; one document stands for it.
2. In each list every point is paired with the smallest; pairs within the bound are verified, and links
   give first components.
3. Lists that still hold several components are joined by R-tree, pairs of different components
   only, first just the closest pairs that would connect each list, then all that are left;
   survivors are verified. Long lists are cut into blocks, joined pair by pair of blocks.

So every pair of different texts that links is either verified or already connected.
Shingles are compared by 64-bit hashes.

Defined results: null, empty and blank texts have no shingles and are components of their own; texts with
fewer words than a shingle are one shingle; null ids get a null component; repeated rows are
documents of their own with one id. Only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .scratch import bounded_batches, discard, partitions, saved
from .text import ASCII_LOWER, give_back, mix, pieces, ragged, shingles, span_hashes, words

_CELL_BITS = 20
_CHUNK_CELLS = 1 << 16
_PER_GROUP, _LEAST_GROUPS, _MOST_GROUPS = 2, 16, 1 << 20
_FINER = 2  # points are kept with 2^2 times the groups that the tree compares; pairs that survive are bound by those
_OPENED = 256
_BLOCK = 2048
_LEAF = 32
_BROADCAST_IDS = 1_000_000
_MOST_SEEN = 1 << 18
_KEPT_BYTES, _STACK_CELLS, _STACK_ROWS, _HEAD_ROWS = 16 << 20, 1 << 21, 1 << 15, 512


_CODEC = pa.Codec("zstd", 1)


def zip_(a: np.ndarray) -> bytes:
    return _CODEC.compress(a.tobytes(), asbytes=True)


def unzip(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(_CODEC.decompress(data, 4 * n, asbytes=True), "<u4")


def pack_point(groups: np.ndarray) -> bytes:
    """Counts as their low bytes and then their high ones, compressed: about a bit for each group."""
    return _CODEC.compress(groups.astype("<u2").view(np.uint8).reshape(-1, 2).T.tobytes(), asbytes=True)


def unpack_point(data, groups: int, wanted: int) -> np.ndarray:
    """The counts of a packed point of ``groups`` groups, added up to ``wanted`` groups."""
    raw = np.frombuffer(_CODEC.decompress(data, 2 * groups, asbytes=True), np.uint8).astype(np.uint16)
    counts = raw[:groups] | (raw[groups:] << 8)
    return counts if wanted == groups else counts.reshape(wanted, -1).sum(axis=1, dtype=np.uint32)


def _sets(column: pa.Array, width: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, row, hash) of the distinct shingles of runs of rows, in order of row and hash."""
    for first, last, data, offsets in pieces(column):
        data = ASCII_LOWER[data]
        start, end, row = words(data, offsets)
        h, r = shingles(span_hashes(data, start, end), row, last - first, width)
        order = np.argsort(h)
        order = order[np.argsort(r[order], kind="stable")]
        h, r = h[order], r[order]
        if len(h):
            new = np.append(True, (h[1:] != h[:-1]) | (r[1:] != r[:-1]))
            h, r = h[new], r[new]
        yield first, last, r, h


def frequency_sketch(docs: DataFrame, width: int) -> np.ndarray:
    """For each of 2^20 hash cells how many (document, shingle) pairs fall into it: 4 MB, whatever the input."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << _CELL_BITS, np.int64)
        for batch in batches:
            for _, _, _, h in _sets(batch.column(0), width):
                total += np.bincount((h >> np.uint64(64 - _CELL_BITS)).astype(np.int64), minlength=len(total))
        small = np.minimum(total, 2**32 - 1).astype("<u4")
        parts = [zip_(small[k : k + _CHUNK_CELLS]) for k in range(0, len(small), _CHUNK_CELLS)]
        yield pa.record_batch([pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.binary())], names=["chunk", "data"])

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        total = sum(unzip(x, _CHUNK_CELLS).astype(np.int64) for x in rows["data"])
        return pd.DataFrame({"chunk": [rows["chunk"].iloc[0]], "data": [zip_(np.minimum(total, 2**32 - 1).astype("<u4"))]})

    rows = docs.select("text").mapInArrow(count, "chunk int, data binary").groupBy("chunk").applyInPandas(add, "chunk int, data binary").collect()
    out = np.zeros(1 << _CELL_BITS, np.uint32)
    for chunk, data in rows:
        out[chunk * _CHUNK_CELLS : (chunk + 1) * _CHUNK_CELLS] = unzip(bytes(data), _CHUNK_CELLS)
    return out


def _levels(n: np.ndarray) -> np.ndarray:
    """log2 of the number of groups of sets of sizes ``n``."""
    return np.clip(np.ceil(np.log2(np.maximum(n, 1) / _PER_GROUP)), np.log2(_LEAST_GROUPS), np.log2(_MOST_GROUPS)).astype(np.int64)


def set_table(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, n, key, point, prefix of each document: set size, set hash, group counts as bytes, rarest shingles."""
    order = docs.sparkSession.sparkContext.broadcast(np.frexp(frequency_sketch(docs, width).astype(float))[1].astype(np.uint8))
    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank, seen = order.value, set()
        for batch in batches:
            for first, last, row, h in _sets(batch.column(1), width):
                rows = last - first
                n = np.bincount(row, minlength=rows)
                spread = mix(h)
                key = np.zeros(rows, np.uint64)
                has = np.flatnonzero(n)
                begin = (np.cumsum(n) - n)[has]
                if len(has):
                    key[has] = mix(np.add.reduceat(spread, begin) ^ mix(n[has].astype(np.uint64)))
                level = _levels(n) + _FINER
                at = np.cumsum(1 << level) - (1 << level)
                groups = np.bincount(at[row] + (spread >> (64 - level[row]).astype(np.uint64)).astype(np.int64), minlength=int((1 << level).sum()))
                points = [pack_point(groups[a : a + (1 << b)]) if k else None for a, b, k in zip(at, level, n, strict=True)]
                by = np.argsort(row * 64 + rank[(h >> np.uint64(64 - _CELL_BITS)).astype(np.int64)], kind="stable")
                place = ragged(n)
                # a copy of a set that this task has met gives no shingles again
                fresh = np.zeros(rows, bool)
                for k in has:
                    if key[k] not in seen:
                        seen.add(key[k])
                        fresh[k] = True
                if len(seen) > _MOST_SEEN:
                    seen = set()
                take = np.where(fresh, n - -(-3 * n // 4) + 1, 0)
                chosen = h[by][place < take[row]].view(np.int64)
                ends = np.concatenate([[0], np.cumsum(take)]).astype(np.int32)
                cols = [pa.array(n, kinds[0]), pa.array(key.view(np.int64), kinds[1], mask=n == 0), pa.array(points, kinds[2]), pa.ListArray.from_arrays(pa.array(ends), pa.array(chosen))]
                yield pa.record_batch([batch.column(0).slice(first, rows), *cols], names=["doc_id", "n", "key", "point", "prefix"])
        give_back()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(describe, "doc_id long, n long, key long, point binary, prefix array<long>")
    return saved(rows, "jaccard-sets")


def shared_lists(sets: DataFrame) -> DataFrame:
    """list, block, keys: the set keys that share a prefix shingle, where there are two or more, smaller sets first; equal lists once."""
    posts = sets.select(F.explode("prefix").alias("h"), "key", "n").repartition(F.col("h")).sortWithinPartitions("h", "n", "key").select("h", "key")

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        h = k = np.zeros(0, np.int64)
        gone, last = 0, None  # blocks of the first run that are out already, with its name and last key

        def close(name: int, keys: np.ndarray, block: int, final: bool) -> tuple[list, int]:
            """Blocks of a run; of a run that goes on, full ones only. Also how many keys went out."""
            if final and not block and len(keys) <= _BLOCK:
                whole = int(mix(np.array([mix(keys).sum()], np.uint64)).view(np.int64)[0])
                if len(keys) < 2 or whole in seen:
                    return [], len(keys)
                if len(seen) > _MOST_SEEN:
                    seen.clear()
                seen.add(whole)
                return [(whole, 0, keys)], len(keys)
            end = len(keys) if final else len(keys) // _BLOCK * _BLOCK
            return [(name, block + a // _BLOCK, keys[a : min(a + _BLOCK, end)]) for a in range(0, end, _BLOCK)], end

        for batch in chain(batches, [None]):
            if batch is not None:
                h, k = (np.concatenate([x, batch.column(c).to_numpy(zero_copy_only=False)]) for c, x in enumerate((h, k)))
            if not len(h):
                continue
            new = np.append(True, (h[1:] != h[:-1]) | (k[1:] != k[:-1]))
            new[0] = (h[0], k[0]) != last
            h, k = h[new], k[new]
            if not len(h):
                continue
            if gone and h[0] != last[0]:
                gone = 0
            cut = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
            ends = np.append(cut[1:], len(h))
            many = ends - cut > 1
            many[0] |= gone > 0
            many[-1] = True
            rows, rest = [], len(h)
            for run in np.flatnonzero(many):
                final = batch is None or run < len(cut) - 1
                keys = k[cut[run] : ends[run]]
                before = gone if run == 0 else 0
                blocks, used = close(int(h[cut[run]]), keys, before, final)
                rows += blocks
                if not final:
                    rest, gone = cut[run] + used, before + len(blocks)
                    if used:
                        last = (h[rest - 1], k[rest - 1])
            h, k = h[rest:], k[rest:]
            if rows:
                yield as_lists(rows)
        give_back()

    def as_lists(rows: list) -> pa.RecordBatch:
        return pa.record_batch([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.list_(pa.int64()))], names=["list", "block", "keys"])

    return saved(posts.mapInArrow(runs, "list long, block int, keys array<long>").dropDuplicates(["list", "block"]), "jaccard-lists", narrow=True)


def _needed(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """The least overlap of sets of two sizes that link at 0.75."""
    return -(-3 * (n + m) // 7)


def _folded(points: np.ndarray, groups: int) -> np.ndarray:
    return points.reshape(len(points), groups, -1).sum(axis=2, dtype=np.uint32) if points.shape[1] != groups else points


def tree_pairs(n: np.ndarray, points: list[bytes], side: np.ndarray | None = None, root: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, slack) of the pairs i < j within the bound, by an R-tree join of the points with themselves.

    ``side`` keeps pairs of different sides only, ``root`` pairs of different roots only; slack is how far
    the bound is above the least overlap, as a part of it.
    """
    level = _levels(n)
    trees = {}
    for k in np.unique(level):
        own = np.flatnonzero(level == k)
        kind = np.uint16 if n[own].max() < 1 << 16 else np.uint32
        raw = np.stack([unpack_point(points[i], 1 << (k + _FINER), 1 << k).astype(kind) for i in own])
        order = np.lexsort((*(raw[:, c] for c in range(min(3, raw.shape[1]))), n[own]))
        trees[int(k)] = own[order], raw[order]
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for k, (own, raw) in trees.items():
        for other in (k, k + 1):
            if other in trees:
                theirs, their_raw = trees[other]
                opened = _opener(points, level, 1 << (k + _FINER))
                _join_leaves(own, raw, theirs, _folded(their_raw, 1 << k), n, side, root, other == k, opened, out)
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _opener(points: list[bytes], level: np.ndarray, groups: int) -> Callable[[int], np.ndarray]:
    """Gives a point's counts in ``groups`` groups; a few hundred stay unpacked."""

    @lru_cache(maxsize=_OPENED)
    def opened(i: int) -> np.ndarray:
        return unpack_point(points[i], 1 << int(level[i] + _FINER), groups)

    return opened


def _fine_bound(u: np.ndarray, v: np.ndarray, opened: Callable[[int], np.ndarray]) -> np.ndarray:
    """The bound of pairs (u, v) by the finer groups."""
    each, place = np.unique(v, return_inverse=True)
    theirs = np.stack([opened(int(i)) for i in each])
    out = np.zeros(len(u), np.int64)
    for i in np.unique(u):
        own = np.flatnonzero(u == i)
        out[own] = np.minimum(opened(int(i)), theirs[place[own]]).sum(axis=1, dtype=np.int64)
    return out


def _join_leaves(a: np.ndarray, x: np.ndarray, b: np.ndarray, y: np.ndarray, n: np.ndarray, side, root, same: bool, opened: Callable[[int], np.ndarray], out: list) -> None:
    def leaves(ids: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        at = np.arange(0, len(ids), _LEAF)
        return at, np.maximum.reduceat(p, at), np.minimum.reduceat(n[ids], at), np.maximum.reduceat(n[ids], at)

    at_a, top_a, low_a, high_a = leaves(a, x)
    at_b, top_b, low_b, high_b = leaves(b, y)
    for i, start in enumerate(at_a):
        # boxes: sizes must fit, and the sum of the smaller upper corners must reach the least overlap
        fit = (4 * high_b >= 3 * low_a[i]) & (4 * high_a[i] >= 3 * low_b)
        if same:
            fit &= np.arange(len(at_b)) >= i
        boxes = np.flatnonzero(fit)
        boxes = boxes[np.minimum(top_a[i], top_b[boxes]).sum(axis=1) >= _needed(low_a[i], low_b[boxes])]
        for box in boxes:
            mine, theirs = slice(start, start + _LEAF), slice(at_b[box], at_b[box] + _LEAF)
            mask = np.ones((len(a[mine]), len(b[theirs])), bool)
            for different in (side, root):
                if different is not None:
                    mask &= different[a[mine]][:, None] != different[b[theirs]][None]
            if same and box == i:
                mask &= a[mine][:, None] < b[theirs][None]
            if not mask.any():
                continue
            bound = np.stack([np.minimum(row, y[theirs]).sum(axis=1, dtype=np.int32) for row in x[mine]])
            need = _needed(n[a[mine]][:, None], n[b[theirs]][None])
            p, q = np.nonzero(mask & (bound >= need))
            if len(p):
                u, v, least = a[mine][p], b[theirs][q], need[p, q]
                fine = _fine_bound(u, v, opened)
                left = fine >= least
                u, v = u[left], v[left]
                out.append((np.minimum(u, v), np.maximum(u, v), (fine[left] / least[left]).astype(np.float32)))


def forest(i: np.ndarray, j: np.ndarray, slack: np.ndarray, root: np.ndarray) -> np.ndarray:
    """Places of the pairs that join ``root``s without a ring, the closest pairs first."""
    parent: dict[int, int] = {}

    def top(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = parent.get(up, up)
            x = up
        return x

    kept = []
    for k in np.argsort(-slack, kind="stable"):
        u, v = top(int(root[i[k]])), top(int(root[j[k]]))
        if u != v:
            parent[u] = v
            kept.append(k)
    return np.array(kept, np.int64)


class _Points:
    """Packed points of some sets by place; what was unpacked last is kept, up to ``_KEPT_BYTES``."""

    def __init__(self, packed: list[bytes], n: np.ndarray):
        self.packed, self.level, self.held, self.size = packed, _levels(n), {}, 0

    def at(self, k: int, groups: int) -> np.ndarray:
        if (point := self.held.get((k, groups))) is None:
            point = unpack_point(self.packed[k], 1 << int(self.level[k] + _FINER), groups)
            if self.size > _KEPT_BYTES:
                self.held, self.size = {}, 0
            self.held[k, groups] = point
            self.size += point.nbytes
        return point

    def bounds(self, u: np.ndarray, v: np.ndarray, finer: int) -> np.ndarray:
        """For each pair the sum of the smaller counts, over 2^finer times the groups that the coarser point has in a tree."""
        level, out = np.minimum(self.level[u], self.level[v]) + finer, np.zeros(len(u), np.int64)
        for k in np.unique(level):
            own, groups = np.flatnonzero(level == k), 1 << int(k)
            step = max(1, _STACK_CELLS // groups)
            for at in range(0, len(own), step):
                part = own[at : at + step]
                every, place = np.unique(np.concatenate([u[part], v[part]]), return_inverse=True)
                stack = np.stack([self.at(int(i), groups) for i in every])
                out[part] = np.minimum(stack[place[: len(part)]], stack[place[len(part) :]]).sum(axis=1, dtype=np.int64)
        return out


def small_pairs(unit: np.ndarray, at: np.ndarray, root: np.ndarray, n: np.ndarray, points: _Points) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, slack) of distinct pairs within the bound, of different roots, in lists of a leaf's size at most.

    Rows are sorted by list (``unit``); ``at`` are their sets' places, by which ``root`` and ``n`` go.
    """
    begin = np.flatnonzero(np.append(True, unit[1:] != unit[:-1]))
    size = np.diff(np.append(begin, len(unit)))
    later = np.repeat(size, size) - 1 - ragged(size)
    first = np.repeat(np.arange(len(unit)), later)
    second = first + 1 + ragged(later)
    i, j = np.minimum(at[first], at[second]), np.maximum(at[first], at[second])
    fits = (root[i] != root[j]) & (4 * n[i] >= 3 * n[j]) & (4 * n[j] >= 3 * n[i])
    i, j = np.divmod(np.unique(i[fits].astype(np.int64) * len(n) + j[fits]), len(n))
    for finer in (0, _FINER):
        bound, least = points.bounds(i, j, finer), _needed(n[i], n[j])
        left = bound >= least
        i, j, slack = i[left], j[left], (bound[left] / least[left]).astype(np.float32)
    return i, j, slack


def _first_pairs(lists: DataFrame, classes: DataFrame) -> DataFrame:
    """a, b: in each list every set with the smallest set of the list, where the bound allows a link."""
    least = lists.groupBy("list").agg(F.min(F.array_min("keys")).alias("key_a"))
    pairs = lists.join(least, "list").select("key_a", F.explode("keys").alias("key_b")).filter("key_a < key_b").distinct()
    a = classes.select(F.col("key").alias("key_a"), F.col("rep").alias("a"), F.col("n").alias("n_a"), F.col("point").alias("p_a"))
    b = classes.select(F.col("key").alias("key_b"), F.col("rep").alias("b"), F.col("n").alias("n_b"), F.col("point").alias("p_b"))

    def within(n_a: pa.Array, n_b: pa.Array, p_a: pa.Array, p_b: pa.Array) -> pa.Array:
        n, m = n_a.to_numpy(zero_copy_only=False), n_b.to_numpy(zero_copy_only=False)
        least_, level, other = _needed(n, m), _levels(n) + _FINER, _levels(m) + _FINER
        out = np.zeros(len(n), bool)
        for k in np.flatnonzero((4 * n >= 3 * m) & (4 * m >= 3 * n)):
            groups = 1 << int(min(level[k], other[k]))
            x, y = (unpack_point(p[int(k)].as_buffer(), 1 << int(b[k]), groups) for p, b in ((p_a, level), (p_b, other)))
            out[k] = np.minimum(x, y).sum(dtype=np.int64) >= least_[k]
        return pa.array(out)

    return pairs.join(a, "key_a").join(b, "key_b").filter(F.arrow_udf(within, "boolean")("n_a", "n_b", "p_a", "p_b")).select("a", "b")


def _tree_pairs_of_lists(lists: DataFrame, classes: DataFrame, roots: DataFrame, spanning: bool) -> DataFrame:
    """a, b: pairs within the bound, of different components, in the lists that hold several components.

    ``spanning`` gives only as many pairs as would join all components that meet in a task. Lists with the same smallest
    set meet in one task, or in as many as their rows ask for; a task gets the point of a set once, however many of its lists hold it.
    """
    spark = lists.sparkSession
    members = lists.select("list", "block", F.explode("keys").alias("key")).join(classes.select("key", "rep", "n"), "key")
    members = members.join(roots, F.col("rep") == F.col("node"), "left").select("list", "block", "rep", "n", F.coalesce("root", "rep").alias("root"))
    members = saved(members, "jaccard-members", narrow=True)
    blocks = members.groupBy("list", "block").agg(*[f("root").alias(x) for f, x in ((F.min, "least"), (F.max, "most"))], F.min("rep").alias("head"), F.min("n").alias("low"), F.max("n").alias("high"), F.count(F.lit(1)).alias("rows"))
    blocks = saved(blocks, "jaccard-blocks", narrow=True)
    mixed = blocks.groupBy("list").agg(F.min("least").alias("least"), F.max("most").alias("most"), F.max("block").alias("last"), F.min("head").alias("head"), F.sum("rows").alias("rows")).filter("least < most")
    mixed = saved(mixed.select("list", "last", "head", "rows"), "jaccard-mixed", narrow=True)
    heads = mixed.filter("last = 0").groupBy("head").agg(F.ceil(F.sum("rows") / _HEAD_ROWS).alias("salts"))
    light = mixed.filter("last = 0").join(heads, "head").select("list", F.pmod(F.xxhash64("head", F.pmod(F.xxhash64("list"), F.col("salts"))), F.lit(4 * partitions(spark))).alias("bin"))
    bins = 4 * partitions(spark)
    short = members.join(light, "list").select("bin", "list", F.lit(0).alias("i"), F.lit(0).alias("j"), "block", "rep", "root", "n")
    # blocks of a long list hold sets of rising sizes: only those whose sizes fit are joined
    long_ = blocks.join(mixed.filter("last > 0").select("list"), "list")
    x, y = (long_.select("list", F.col("block").alias(b), F.col("low").alias(f"low_{b}"), F.col("high").alias(f"high_{b}")) for b in "ij")
    pairs = x.join(y, "list").filter("i <= j and 3 * low_j <= 4 * high_i").select("list", "i", "j").withColumn("block", F.explode(F.array_distinct(F.array("i", "j"))))
    cut = members.join(pairs, ["list", "block"]).select(F.pmod(F.xxhash64("list", "i", "j"), F.lit(bins)).alias("bin"), "list", "i", "j", "block", "rep", "root", "n")
    rows = saved(short.unionByName(cut), "jaccard-units")
    wanted = rows.select(F.col("bin").alias("w_bin"), F.col("rep").alias("w_rep")).distinct().join(classes.select(F.col("rep").alias("w_rep"), "point"), "w_rep")

    def join(rows: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["list", "i", "j"], kind="stable")
        reps = np.sort(wanted["w_rep"].to_numpy())
        packed = wanted.sort_values("w_rep")["point"].tolist()
        at = np.searchsorted(reps, rows["rep"].to_numpy())
        root, n = np.zeros(len(reps), np.int64), np.zeros(len(reps), np.int64)
        root[at], n[at] = rows["root"].to_numpy(), rows["n"].to_numpy()
        points = _Points(packed, n)
        keys = [rows[c].to_numpy() for c in ("list", "i", "j")]
        unit = np.cumsum(np.append(True, np.any([k[1:] != k[:-1] for k in keys], axis=0))) - 1 if len(rows) else np.zeros(0, np.int64)
        size = np.bincount(unit)
        small, found = size[unit] <= _LEAF, []
        for part in _stretches(unit[small]):
            found.append(small_pairs(unit[small][part], at[small][part], root, n, points))
        begin = np.cumsum(size) - size
        block = rows["block"].to_numpy()
        for k in np.flatnonzero(size > _LEAF):
            own = at[begin[k] : begin[k] + size[k]]
            if (root[own] == root[own[0]]).all():
                continue
            side = block[begin[k] : begin[k] + size[k]] if keys[1][begin[k]] != keys[2][begin[k]] else None
            u, v, slack = tree_pairs(n[own], [packed[x] for x in own], side, root[own])
            found.append((np.minimum(own[u], own[v]), np.maximum(own[u], own[v]), slack))
        u, v, slack = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 3
        if spanning and len(u):
            keep = forest(u, v, slack, root)
            u, v = u[keep], v[keep]
        give_back()
        return pd.DataFrame(np.unique(np.stack([reps[u], reps[v]], axis=1), axis=0), columns=["a", "b"]).astype("int64")

    out = saved(rows.groupBy("bin").cogroup(wanted.groupBy("w_bin")).applyInPandas(join, "a long, b long").distinct(), "jaccard-bounded", narrow=True)
    discard(members, blocks, mixed, rows)
    return out


def _stretches(unit: np.ndarray) -> Iterator[slice]:
    """Runs of whole lists of about ``_STACK_ROWS`` rows."""
    at = 0
    while at < len(unit):
        end = min(at + _STACK_ROWS, len(unit))
        end = int(np.searchsorted(unit, unit[end - 1], "right"))
        yield slice(at, end)
        at = end


def verified(pairs: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """a, b, linked of ``pairs`` of doc ids, by the whole sets of both texts."""
    ids = saved(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "jaccard-ids", narrow=True)
    few = ids.count() <= _BROADCAST_IDS

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, row, h in _sets(batch.column(1), width):
                at = np.searchsorted(row, np.arange(last - first + 1))
                yield pa.record_batch([batch.column(0).slice(first, last - first), pa.array([h[p:q].tobytes() for p, q in zip(at, at[1:], strict=False)], pa.binary())], names=["id", "shingles"])

    chosen = docs.select(F.col("doc_id").cast("long").alias("id"), "text").join(F.broadcast(ids) if few else ids, "id")
    sets = chosen.mapInArrow(hashes, "id long, shingles binary")

    def linked(x: pa.Array, y: pa.Array) -> pa.Array:
        out = []
        for p, q in zip(x, y, strict=True):
            a, b = np.frombuffer(p.as_buffer(), "<u8"), np.frombuffer(q.as_buffer(), "<u8")
            a, b = (a, b) if len(a) < len(b) else (b, a)
            at = np.minimum(np.searchsorted(b, a), len(b) - 1)
            both = int((b[at] == a).sum())
            out.append(100 * both >= 75 * (len(a) + len(b) - both))
        return pa.array(out, pa.bool_())

    left = pairs.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("x")), "a")
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("y"))
    out = saved(left.join(right, "b").select("a", "b", F.arrow_udf(linked, "boolean")("x", "y").alias("linked")).distinct(), "jaccard-links", narrow=True)
    discard(ids)
    return out


def similar_documents(docs: DataFrame, *, width: int = 5) -> DataFrame:
    """doc_id, n_shingles, component_id of each row of ``docs`` (doc_id, text): links are Jaccard 0.75 or more."""
    bounded_batches(docs.sparkSession)
    sets = set_table(docs, width)
    real = sets.filter("n > 0 and doc_id is not null")
    lists = shared_lists(real)
    classes = saved(real.groupBy("key").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("point").alias("point")), "jaccard-classes")
    slim = saved(sets.select("doc_id", "n", "key"), "jaccard-keys")
    discard(sets)
    pairs = saved(_first_pairs(lists, classes), "jaccard-pairs", narrow=True)
    tried = verified(pairs, docs, width)
    discard(pairs)
    roots = components(tried.filter("linked").select(F.col("a").alias("u"), F.col("b").alias("v")))
    for spanning in (True, False):
        more = _tree_pairs_of_lists(lists, classes, roots, spanning)
        known = tried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        pairs = saved(more.join(known, ["a", "b"], "left_anti"), "jaccard-pairs", narrow=True)
        checked = verified(pairs, docs, width)
        discard(more, pairs)
        links = checked.filter("linked").select(F.col("a").alias("u"), F.col("b").alias("v"))
        roots = components(links.unionByName(roots.select(F.col("node").alias("u"), F.col("root").alias("v"))))
        tried = tried.unionByName(checked)
    discard(lists)
    reps = classes.select("key", "rep").join(roots, F.col("rep") == F.col("node"), "left").select("key", F.coalesce("root", "rep").alias("component"))
    out = slim.join(reps, "key", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))
