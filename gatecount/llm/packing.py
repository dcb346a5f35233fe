"""Hierarchical packing of documents into sequences of several context sizes.

Each document becomes its token ids and an end id. Whole windows of the longest size are
cut off first. What is left of a document is routed to the shortest tier that holds it. Each
tier, from the longest, puts one such rest into a window and fills the window's gap with the
longest rests of shorter tiers that fit, then with a cut of one more. Tiers are powers of two,
and what is left at the very end goes into windows of falling powers of two, so nothing is
padded. Sequences are dealt to step groups of equal token counts, longest tiers first.

Packing is done per task over runs of about a million tokens: no shuffle is needed, a lost
task gives the same rows again, and memory does not follow the partition.

Defined results: a null or empty text is a document of the end id alone; repeated rows are packed
again each; the id column may hold nulls; other columns are never read.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .scratch import bounded_batches
from .text import CHUNK_BYTES, give_back
from .tokens import tokenizer

_RUN_TOKENS = 1 << 20
_OUT_BYTES = 2 << 20
SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, tier int, step_group long"


class _Rests:
    """Rests of documents by length: takes the longest that fits."""

    def __init__(self, items: list[tuple[int, int, int]]):
        self.items = sorted(items)  # (length, document, start)

    def take(self, room: int) -> tuple[int, int, int] | None:
        k = bisect.bisect_right(self.items, (room, 1 << 62, 1 << 62)) - 1
        return self.items.pop(k) if k >= 0 else None

    def put(self, item: tuple[int, int, int]) -> None:
        bisect.insort(self.items, item)


def pack(lengths: np.ndarray, context: int = 2048, shortest: int = 256) -> list[tuple[int, list[tuple[int, int, int]]]]:
    """(window size, pieces (document, start, length)) of each sequence; every token lies in one piece."""
    tiers = [context >> k for k in range(context.bit_length()) if context >> k >= shortest]
    sequences: list[tuple[int, list[tuple[int, int, int]]]] = []
    routed: dict[int, list[tuple[int, int, int]]] = {t: [] for t in tiers}
    for doc, n in enumerate(lengths.tolist()):
        for k in range(n // context):
            sequences.append((context, [(doc, k * context, context)]))
        if rest := n % context:
            tier = min(t for t in tiers if t >= rest)
            routed[tier].append((rest, doc, n - rest))
    rests = {t: _Rests(x) for t, x in routed.items()}
    for level, tier in enumerate(tiers):
        below = [rests[t] for t in tiers[level + 1 :]] or [rests[tier]]
        while rests[tier].items:
            n, doc, start = rests[tier].items.pop()
            window, room = [(doc, start, n)], tier - n
            while room:
                found = next((x for r in below if (x := r.take(room))), None)
                if found is None:  # nothing fits whole: cut the shortest that there is
                    pool = next((r for r in reversed(below) if r.items), None)
                    if pool is None:
                        break
                    n, doc, start = pool.items.pop(0)
                    window.append((doc, start, room))
                    back = min(t for t in tiers if t >= n - room)
                    (rests[back] if tiers.index(back) > level or back == tier else pool).put((n - room, doc, start + room))
                    room = 0
                else:
                    window.append((found[1], found[2], found[0]))
                    room -= found[0]
            if not room:
                sequences.append((tier, window))
                continue
            for doc, start, n in window:  # nothing is left to fill this window: windows of falling sizes
                rests[tiers[-1]].put((n, doc, start)) if n <= tiers[-1] and tier != tiers[-1] else None
            loose = [p for p in window if not (p[2] <= tiers[-1] and tier != tiers[-1])]
            sequences += _falling(loose)
    return sequences


def _falling(left: list[tuple[int, int, int]]) -> list[tuple[int, list[tuple[int, int, int]]]]:
    """The last pieces on end, cut into windows whose sizes are the powers of two in their sum."""
    total, out, queue = sum(p[2] for p in left), [], list(left)
    while total:
        size = 1 << (total.bit_length() - 1)
        window, room = [], size
        while room:
            doc, start, n = queue.pop(0)
            take = min(n, room)
            window.append((doc, start, take))
            room -= take
            if take < n:
                queue.insert(0, (doc, start + take, n - take))
        out.append((size, window))
        total -= size
    return out


def pack_documents(docs: DataFrame, tokenizer_file: str, *, end_id: int = 1, context: int = 2048, shortest: int = 256, step_tokens: int = 64 * 2048) -> DataFrame:
    """Pieces of all documents (doc_id, text) with their ids as little-endian 32-bit numbers, see SCHEMA.

    ``sequence_id`` is the task's number and a count; ``offset`` runs from 0 without gaps in a sequence.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokenizer(tokenizer_file)
        base, group_base = TaskContext.get().partitionId() << 32, TaskContext.get().partitionId() << 32
        names, parts, sizes, held = [], [], [], 0
        sequence = filled = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal names, parts, sizes, held, sequence, filled
            length, flat = np.concatenate(sizes), np.concatenate(parts)
            begin = np.cumsum(length) - length
            ids = pa.concat_arrays(names)
            rows: list[tuple] = []
            out = 0
            for size, window in sorted(pack(length, context, shortest), key=lambda s: -s[0]):
                offset = 0
                for doc, start, n in window:
                    raw = flat[begin[doc] + start : begin[doc] + start + n].astype("<u4").tobytes()
                    rows.append((doc, start, n, raw, int(length[doc]), base + sequence, offset, size, group_base + filled // step_tokens))
                    offset += n
                    out += len(raw)
                sequence += 1
                filled += size
                if out > _OUT_BYTES:
                    yield as_batch(ids, rows)
                    rows, out = [], 0
            if rows:
                yield as_batch(ids, rows)
            names, parts, sizes, held = [], [], [], 0
            del length, flat, ids, rows
            give_back()

        for batch in batches:
            for first, last in _row_runs(batch.column(1)):
                text = batch.column(1).slice(first, last - first)
                flat, count = encoder.encode(text)
                total = np.cumsum(count + 1)
                joined = np.full(int(total[-1]) if len(total) else 0, end_id, np.uint32)
                own = np.ones(len(joined), bool)
                own[total - 1] = False
                joined[own] = flat
                names.append(batch.column(0).slice(first, last - first))
                parts.append(joined)
                sizes.append(count + 1)
                held += len(joined)
                if held >= _RUN_TOKENS:
                    yield from flush()
        if names:
            yield from flush()
        give_back()

    bounded_batches(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


def _row_runs(column: pa.Array) -> Iterator[tuple[int, int]]:
    from .text import pieces

    for first, last, _, _ in pieces(column, 2 * CHUNK_BYTES):
        yield first, last


def as_batch(ids: pa.Array, rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True))
    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    return pa.record_batch([ids.take(pa.array(cols[0], pa.int64())), *[pa.array(c, k) for c, k in zip(cols[1:], kinds, strict=True)]], names=names)
