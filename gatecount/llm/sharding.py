"""Sharding by histogram sort.

Rows are ordered by (64-bit hash of the text, id), so equal texts are neighbours. Splitters
are found by counting, again and again, the exact bytes below candidate boundaries over
all partitions, and by putting the next candidates where a boundary is still off its aim;
then the rows are exchanged once. A boundary falls between groups of equal texts where
that meets the tolerance, and inside a group, between ids, only where it does not.

Defined results: a null text has one byte (its size plus 1) and the hash of an empty text; a
null id sorts first; repeated rows stay neighbours and can't be told apart by a boundary;
an empty table gives no rows. Input columns ride along inside one struct, so their names
can't clash with those added.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import saved

_LOW, _HIGH = -(1 << 63), (1 << 63) - 1
_PROBES = 16
_ROUNDS = 40
_BUCKET_BYTES = 64 << 20


def _below(keys: list[tuple[int, int]]):
    """A column function: how many of the sorted boundary keys are at or below a row's (hash, id)."""
    hashes = np.array([k[0] for k in keys], np.int64)
    ids = np.array([k[1] for k in keys], np.int64)

    def index(h: pa.Array, d: pa.Array) -> pa.Array:
        h, d = h.to_numpy(zero_copy_only=False), d.to_numpy(zero_copy_only=False)
        left, right = np.searchsorted(hashes, h, "left"), np.searchsorted(hashes, h, "right")
        at = left.copy()
        for same in np.unique(left[left < right]):
            rows = np.flatnonzero((left == same) & (left < right))
            at[rows] += np.searchsorted(ids[same : right[rows[0]]], d[rows], "right")
        return pa.array(at, pa.int64())

    return lambda h, d: F.arrow_udf(index, "long")(h, d)


def _within(hashes: tuple[int, int], ids: tuple[int, int], n: int) -> list[tuple[int, int]]:
    """Up to ``n`` candidate keys over the hashes, or, of a single hash, over the ids that rows between two keys have."""
    (h0, h1), (d0, d1) = hashes, ids
    if h1 > h0:
        return [(h, _LOW) for h in {h0 + (h1 + 1 - h0) * k // n for k in range(n)} | {min(h1 + 1, _HIGH)}]
    return [(h0, _LOW), (min(h0 + 1, _HIGH), _LOW), *[(h0, d) for d in {d0 + (d1 + 1 - d0) * k // n for k in range(n)}]]


def splitters(keys: DataFrame, n_shards: int, fine: int, tolerance: float, loose: float = 0.3) -> tuple[list[tuple[int, int]], list[int], int]:
    """(boundary keys, rows of each bucket, rounds) that cut ``keys`` (h, d, size) into shards of ``fine`` buckets.

    A boundary between shards may miss its aim by ``tolerance`` of a shard, one between the
    buckets of a shard by ``loose`` of a bucket; search also ends where one row is left between
    two candidates. Each round sends the driver one count per candidate, at most 16 a boundary.
    """
    n_buckets = n_shards * fine
    first = keys.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    total, n_rows = int(first[0]), int(first[1])
    aims = [(total * k / n_buckets, (tolerance * fine if k % fine == 0 else loose) * total / n_buckets) for k in range(1, n_buckets)]
    known: dict[tuple[int, int], tuple[int, int]] = {(_LOW, _LOW): (0, 0), (_HIGH, _HIGH): (total, n_rows)}
    probes = [(_LOW + (1 << 64) * k // n_buckets, _LOW) for k in range(1, n_buckets)]
    spans: dict[tuple[int, int], list[int]] = {}
    rounds = 0
    while probes and rounds < _ROUNDS:
        rounds += 1
        probes = sorted(set(probes))
        counted = keys.groupBy(_below(probes)(F.col("h"), F.col("d")).alias("i")).agg(F.sum("size"), F.count(F.lit(1)), F.min("h"), F.max("h"), F.min("d"), F.max("d")).collect()
        counts = {x[0]: x[1:] for x in counted}
        below = rows_below = 0
        for k, key in enumerate([*probes, (_HIGH, _HIGH)]):
            size, rows, *reach = counts.get(k, (0, 0))
            spans[key] = reach  # of the rows between this candidate and the one before it
            below, rows_below = below + size, rows_below + rows
            known[key] = (below, rows_below)
        order = sorted(known)
        bytes_below = np.array([known[k][0] for k in order])
        probes = []
        for aim, slack in aims:
            at = max(1, min(int(np.searchsorted(bytes_below, aim, "left")), len(order) - 1))
            if min(abs(bytes_below[at] - aim), abs(bytes_below[at - 1] - aim)) > slack and known[order[at]][1] - known[order[at - 1]][1] > 1 and spans.get(order[at]):
                h0, h1, d0, d1 = spans[order[at]]
                if inner := [p for p in _within((h0, h1), (d0, d1), _PROBES) if order[at - 1] < p < order[at]]:
                    probes += [*inner, order[at - 1], *order[at : at + 1][: order[at] != order[-1]]]  # its ends again, so that spans hold
    order = sorted(known)
    bytes_below = np.array([known[k][0] for k in order])
    chosen, rows_at = [], [0]
    for aim, _ in aims:
        at = max(1, min(int(np.searchsorted(bytes_below, aim, "left")), len(order) - 1))
        key = order[at] if abs(bytes_below[at] - aim) <= abs(bytes_below[at - 1] - aim) else order[at - 1]
        chosen.append(key)
        rows_at.append(known[key][1])
    rows_at.append(n_rows)
    return chosen, [b - a for a, b in zip(rows_at, rows_at[1:], strict=False)], rounds


def shard(docs: DataFrame, *, n_shards: int = 8, tolerance: float = 0.001, text: str = "text", row_id: str = "doc_id", bucket_bytes: int = _BUCKET_BYTES) -> DataFrame:
    """row (the input row as a struct), size, shard, slot: shards of near equal bytes, slots without gaps from 0.

    Each shard is a run of buckets of at most about ``bucket_bytes``; a bucket is what one task
    sorts, so a shard never passes through one task.
    """
    h = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    d = F.coalesce(F.col(row_id).cast("long"), F.lit(_LOW))
    size = F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long") + 1
    keys = saved(docs.select(h.alias("h"), d.alias("d"), size.alias("size")), "shard-keys")
    total = int(keys.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0])
    fine = max(16, -(-total // (n_shards * bucket_bytes)))
    chosen, rows, _ = splitters(keys, n_shards, fine, tolerance)
    starts = np.array([sum(rows[b - b % fine : b]) for b in range(len(rows))], np.int64)

    def start_of(bucket: pa.Array) -> pa.Array:
        return pa.array(starts[bucket.to_numpy(zero_copy_only=False)], pa.int64())

    row: Column = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    out = docs.select(row.alias("row"), h.alias("h"), d.alias("d"), size.alias("size"))
    out = out.withColumn("bucket", _below(chosen)(F.col("h"), F.col("d")))
    rank = F.row_number().over(Window.partitionBy("bucket").orderBy("h", "d", "size")) - 1
    out = out.withColumn("rank", rank)
    return out.select("row", "size", F.floor(F.col("bucket") / fine).cast("int").alias("shard"), (F.arrow_udf(start_of, "long")(F.col("bucket")) + F.col("rank")).alias("slot"))
