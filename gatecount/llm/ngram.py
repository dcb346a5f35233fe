"""Quality by an interpolated modified Kneser-Ney n-gram model of trusted text.

Counts come from all trusted documents but a fifth, which is held back to set thresholds. Every word
and n-gram counts, by hash: a word's hash holds its language and, in the lowest five bits, its shape class
(case, digits, symbols, last mark). Nothing that the driver or a broadcast holds follows the number of words.

The log probability of a word is a sum over the orders k of its n-gram, each term a weight of one k-gram:

    log p(w | c) = log u(w) + sum over k of log g_k(c_k) [c_k seen] + d_k(c_k, w) [c_k w seen]

u is the unigram part, g_k a context's back-off weight and d_k what a seen k-gram adds; log g_k goes
with the (k-1)-gram that the context is. Texts are padded with borders, and orders below the highest count
the distinct words before a gram. A word never seen has the mass of words seen once in its class (as a share of the
distinct bigrams) times the probability of its spelling under a byte bigram model, so that the model is closed.

The model lies in shards by last word, nested: words, under each the nearest words before it, under those the ones
before. A document's n-grams travel to the shards in the same form, as compressed blocks of some
thousands of documents, with lists of documents at the last level only; each shard adds up what its grams
give each document. Words have 40 hashed bits; under a gram the next word back is told by 32 bits, further ones by 24.
Logarithms of the model are kept in steps of 1/1024. How many shards there are follows the training text.

Defined results: a document without words has no perplexity and is not kept; one in a language
without a model has no perplexity and is kept; a null language is the language ``""``; a document is trusted
if its labels are all quality 1 and toxic 0; repeated rows are scored each; ties at the
threshold are kept. Only doc_id, text and lang of the documents are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import arrow_place, bounded_batches, discard, folder, partitions, saved, saved_in_turn
from .text import give_back, mix, pieces, ragged, span_hashes, words

_LEAST_SHARDS, _SHARD_BYTES = 32, 4 << 20  # bytes of training text that make a shard
_BLOCK_WORDS, _BLOCK_ROWS, _HELD_WORDS = 500_000, 1 << 15, 500_000
_PIECE_BYTES = 1 << 18  # of text read at a time: working arrays take some fifty bytes a byte, in each Python worker
_CLASSES, _CLASS_BITS, _RESERVED = 32, 5, 34  # shape classes; classes and text borders
_WORD_BITS = 45  # of a word's hash, with its class
_MARK_BITS = (32, 24)  # that tell the nearest word before a gram, and any further one
_PAIRS, _UNIT = 257 * 257, 1 << 16  # byte pairs with a border; parts of a natural logarithm in spelling tables
_STEP, _NONE = 1024, -(1 << 15)  # parts of a natural logarithm in the model; a gram that is no more than a context
_NEW_STEP = 256  # parts of a natural logarithm in what a block says of words as if unseen
_HELD_BACK = 5
_zstd = pa.Codec("zstd", 3)

def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays as byte planes, compressed: high bytes of small numbers take no room."""
    parts = []
    for a in arrays:
        raw = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.dtype.itemsize).T.tobytes()
        parts.append(len(raw).to_bytes(8, "little") + bytes(_zstd.compress(raw, asbytes=True)))
    return b"".join(len(p).to_bytes(8, "little") + p for p in parts)


def _unpack(data: bytes, *kinds: str) -> list[np.ndarray]:
    out, at = [], 0
    for kind in kinds:
        size = int.from_bytes(data[at : at + 8], "little")
        n = int.from_bytes(data[at + 8 : at + 16], "little")
        raw = _zstd.decompress(data[at + 16 : at + 8 + size], n, asbytes=True) if n else b""
        width = np.dtype(kind).itemsize
        out.append(np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(width, -1).T).view(kind).reshape(-1))
        at += 8 + size
    return out


def _shapes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A class from 0 to 31 of each word: starts upper, has lower, has digit, has symbol, ends in a mark."""

    def any_of(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask, dtype=np.int32)])
        return total[end] > total[start]

    upper, lower = (data >= 65) & (data <= 90), ((data >= 97) & (data <= 122)) | (data >= 128)
    digit = (data >= 48) & (data <= 57)
    mark = np.isin(data, np.frombuffer(b".,;:!?'-", np.uint8))
    symbol = ~(upper | lower | digit | mark)
    doubled = np.zeros(len(data), bool)
    doubled[1:] = mark[1:] & mark[:-1]
    first = upper[start] | (data[start] >= 0xC3)
    return first + 2 * any_of(lower) + 4 * any_of(digit) + 8 * (any_of(symbol) | any_of(doubled & mark)) + 16 * mark[end - 1]


def _shortened(x: np.ndarray) -> np.ndarray:
    """40 mixed bits above five empty ones."""
    return (mix(x) >> np.uint64(64 - _WORD_BITS)) & ~np.uint64(_CLASSES - 1)


@dataclass
class Languages:
    """Names in order, with the hashes of the text borders of each."""

    names: list[str]

    def __post_init__(self) -> None:
        self.salt = mix(np.arange(1, len(self.names) + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        self.start, self.end = (_shortened(self.salt + np.uint64(k)) for k in (1, 2))


def _read(texts: pa.Array, langs: np.ndarray, known: Languages) -> Iterator[tuple]:
    """(first row, end row, row, hash, bytes, start, end) of the words of runs of rows; of rows in known languages only."""
    for first, last, data, offsets in pieces(texts, _PIECE_BYTES):
        start, end, row = words(data, offsets)
        lang = langs[first:last][row]
        h = np.zeros(len(row), np.uint64)
        if len(row) and len(known.names):
            h = _shortened(span_hashes(data, start, end) ^ known.salt[lang]) | _shapes(data, start, end).astype(np.uint64)
        yield first, last, row, h, data, start, end


def _byte_pairs(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of each byte after the one before it, of each word's first byte, and of its end; 256 is the border."""
    inner = np.zeros(len(data), np.int64)
    inner[1:] = data[:-1].astype(np.int64) * 257 + data[1:]
    return inner, 256 * 257 + data[start].astype(np.int64), data[end - 1].astype(np.int64) * 257 + 256


def _spelling(table: np.ndarray, lang: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Log probability of each word's bytes, from sums of integers, so that equal words have equal ones anywhere."""
    inner, opens, closes = _byte_pairs(data, start, end)
    out = np.zeros(len(start))
    for k in np.unique(lang):
        own = lang == k
        total = np.cumsum(table[k][inner])
        out[own] = (total[end[own] - 1] - total[start[own]] + table[k][opens[own]] + table[k][closes[own]]) / _UNIT
    return out


def _lang_index(column: pa.Array, languages: list[str]) -> np.ndarray:
    place = {x: k for k, x in enumerate(languages)}
    return np.array([place.get(x or "", -1) for x in column.to_pylist()], np.int64)


def _mark_bits(level: int) -> int:
    return _MARK_BITS[min(level, len(_MARK_BITS)) - 1]


def _mark(word: np.ndarray, level: int) -> np.ndarray:
    """What tells the ``level``-th word before a gram from others in its place."""
    return word >> np.uint64(_WORD_BITS - _mark_bits(level))


def _shard_of(word: np.ndarray, shards: int) -> np.ndarray:
    """Rises with the hash, so that sorted words are sorted by shard."""
    return ((word >> np.uint64(_CLASS_BITS)) * np.uint64(shards) >> np.uint64(_WORD_BITS - _CLASS_BITS)).astype(np.int64)


def _starts(per: np.ndarray) -> np.ndarray:
    return (np.cumsum(per) - per)[per > 0]


def _steps(keys: np.ndarray, per: np.ndarray) -> np.ndarray:
    """Rising keys under each parent as differences."""
    out, at = np.diff(keys, prepend=np.uint64(0)), _starts(per)
    out[at] = keys[at]
    return out


def _unsteps(steps: np.ndarray, per: np.ndarray) -> np.ndarray:
    total, at = np.cumsum(steps, dtype=np.uint64), _starts(per)
    return total - np.repeat(total[at] - steps[at], per[per > 0])


@dataclass
class Nested:
    """Distinct grams: sorted words; under each the marks of words before it; and so on.

    ``per[k]`` tells how many keys of level k + 1 each key of level k has.
    """

    keys: list[np.ndarray]
    per: list[np.ndarray]

    @classmethod
    def of(cls, columns: list[np.ndarray]) -> tuple[Nested, list[np.ndarray]]:
        """From words and the words before them, nearest first; also each row's place at each level."""
        keys, place = np.unique(columns[0], return_inverse=True)
        out, places = cls([keys], []), [place]
        for level, column in enumerate(columns[1:], 1):
            both, place = np.unique((place.astype(np.uint64) << np.uint64(_mark_bits(level))) | _mark(column, level), return_inverse=True)
            out.push(level, both)
            places.append(place)
        return out, places

    def push(self, level: int, both: np.ndarray) -> None:
        """Adds a level of sorted (place above, mark) pairs."""
        bits = np.uint64(_mark_bits(level))
        self.per.append(np.bincount((both >> bits).astype(np.int64), minlength=len(self.keys[-1])))
        self.keys.append(both & np.uint64((1 << int(bits)) - 1))

    def pairs(self, level: int, above: np.ndarray | None = None) -> np.ndarray:
        """(place above, mark) of each key of a level; ``above`` are other places for those of the level above."""
        at = np.arange(len(self.keys[level - 1]), dtype=np.uint64) if above is None else above.astype(np.uint64)
        return (np.repeat(at, self.per[level - 1]) << np.uint64(_mark_bits(level))) | self.keys[level]

    def parts(self, shards: int) -> list[list[slice]]:
        """The stretch of each level that belongs to each shard."""
        at = np.searchsorted(_shard_of(self.keys[0], shards), np.arange(shards + 1))
        out = [at]
        for per in self.per:
            out.append(np.concatenate([[0], np.cumsum(per)])[out[-1]])
        return [[slice(int(x[s]), int(x[s + 1])) for x in out] for s in range(shards)]

    def packable(self, part: list[slice] | None = None) -> list[np.ndarray]:
        part = part or [slice(None)] * len(self.keys)
        keys = self.keys[0][part[0]]
        out = [np.diff(keys, prepend=np.uint64(0))]
        for level, per in enumerate(self.per, 1):
            per, keys = per[part[level - 1]], self.keys[level][part[level]]
            out += [per.astype(np.uint32), (_steps(keys, per) if level == 1 else keys).astype(np.uint32)]
        return out

    @classmethod
    def unpacked(cls, arrays: list[np.ndarray]) -> Nested:
        out = cls([np.cumsum(arrays[0], dtype=np.uint64)], [])
        for level, (per, keys) in enumerate(zip(arrays[1::2], arrays[2::2], strict=True), 1):
            per, keys = per.astype(np.int64), keys.astype(np.uint64)
            out.per.append(per)
            out.keys.append(_unsteps(keys, per) if level == 1 else keys)
        return out

    @staticmethod
    def kinds(levels: int) -> list[str]:
        return ["<u8", *["<u4", "<u4"] * (levels - 1)]


def _grams(row: np.ndarray, lang: np.ndarray, h: np.ndarray, known: Languages, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row of each n-gram, place of its last word in the run, language of the run, run); the run is all rows' words, with borders before and one after each row."""
    if not len(row):
        return row, row, lang, h
    begins = np.flatnonzero(np.diff(row, prepend=-1))
    n = np.diff(np.append(begins, len(row)))
    first = np.cumsum(n + order) - (n + order)
    run = np.repeat(known.start[lang[begins]], n + order)
    run[np.repeat(first + order - 1, n) + ragged(n)] = h
    run[first + n + order - 1] = known.end[lang[begins]]
    at = np.repeat(first + order - 1, n + 1) + ragged(n + 1)
    return np.repeat(row[begins], n + 1), at, np.repeat(lang[begins], n + order), run


def _fold(columns: list[np.ndarray], size: int) -> np.ndarray:
    """One number for each row of small numbers, the same for equal rows and in their order."""
    code = columns[0]
    for column in columns[1:]:
        code = np.unique(code.astype(np.int64) * size + column, return_inverse=True)[1]
    return code


@dataclass
class Counts:
    """Distinct n-grams in order, as places in a list of words: the words before, nearest first, and the word; how often each occurs."""

    words: np.ndarray
    langs: np.ndarray
    columns: list[np.ndarray]
    n: np.ndarray

    @classmethod
    def of(cls, words_: np.ndarray, langs: np.ndarray, columns: list[np.ndarray], n: np.ndarray | None) -> Counts:
        size = max(len(words_), 1)
        code = _fold(columns[:-1], size).astype(np.int64) * size + columns[-1]
        _, first, back = np.unique(code, return_index=True, return_inverse=True)
        total = np.bincount(back) if n is None else np.rint(np.bincount(back, weights=n)).astype(np.int64)
        return cls(words_, langs, [c[first] for c in columns], total)

    def pack(self, rows: slice = slice(None)) -> bytes:
        own = [c[rows] for c in self.columns]
        here = np.unique(np.concatenate(own))
        return _pack(self.langs[here].astype(np.uint32), np.diff(self.words[here], prepend=np.uint64(0)), self.n[rows].astype(np.uint64), *[np.searchsorted(here, c).astype(np.uint32) for c in own])

    @classmethod
    def unpack(cls, data: bytes, order: int) -> Counts:
        langs, steps, n, *columns = _unpack(data, "<u4", "<u8", "<u8", *["<u4"] * order)
        return cls(np.cumsum(steps, dtype=np.uint64), langs.astype(np.int64), [c.astype(np.int32) for c in columns], n.astype(np.int64))

    def levels(self) -> list[tuple[list[np.ndarray], np.ndarray, np.ndarray]]:
        """(columns, counts, place of each n-gram) for each order from the highest to two; below it, a gram counts the words before it."""
        out, place = [(self.columns, self.n, np.arange(len(self.n)))], np.arange(len(self.n))
        while len(out[-1][0]) > 2:
            columns = [*out[-1][0][:-2], out[-1][0][-1]]
            _, first, back = np.unique(_fold(columns, max(len(self.words), 1)), return_index=True, return_inverse=True)
            place = back[place]
            out.append(([c[first] for c in columns], np.bincount(back), place))
        return out

    def contexts(self, columns: list[np.ndarray], n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first row, place of each row, [sum, ones, twos, more]) of the contexts of grams."""
        _, first, back = np.unique(_fold(columns[:-1], max(len(self.words), 1)), return_index=True, return_inverse=True)
        return first, back, np.stack([np.bincount(back, weights=x, minlength=len(first)) for x in (n, n == 1, n == 2, n > 2)])


ROLE_COLUMNS = ("doc_id", "lang", "text", "held", "trusted")


class Trusted:
    """Which rows are trusted: by a broadcast of packed ids, about a byte each, or else by the rows' own column."""

    def __init__(self, ids: DataFrame | None):
        self.sent = None
        if ids is not None:
            values = np.sort(ids.toArrow().column(0).to_numpy()).astype(np.int64)
            self.sent = ids.sparkSession.sparkContext.broadcast(_pack(np.diff(values, prepend=0)))
        self.ids: np.ndarray | None = None

    def roles(self, batch: pa.RecordBatch) -> np.ndarray:
        """0 for rows that are not trusted, 1 for those that count, 2 for those held back."""
        ids, held = batch.column(0), batch.column(3).to_numpy(zero_copy_only=False)
        if self.sent is None:
            good = batch.column(4).fill_null(False).to_numpy(zero_copy_only=False)
        else:
            if self.ids is None:
                self.ids = np.cumsum(_unpack(self.sent.value, "<i8")[0])
            good = (_found(self.ids, ids.cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False)) >= 0) & ~np.asarray(ids.is_null())
        return np.where(good, np.where(held, 2, 1), 0)


def count_shards(docs: DataFrame, trusted: Trusted, known: Languages, order: int, shards: int) -> DataFrame:
    """shard, data: the distinct n-grams of trusted documents (ROLE_COLUMNS) but those held back, and their counts, in shards by the word before the last; shard -1 has the counts of byte pairs."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        letters = np.zeros(len(known.names) * _PAIRS, np.int64)

        def out(rows: list) -> pa.RecordBatch:
            return pa.record_batch([pa.array([x[0] for x in rows], pa.int32()), pa.array([x[1] for x in rows], pa.binary())], names=["shard", "data"])

        def flush() -> pa.RecordBatch:
            begins = np.cumsum([0, *[len(x[2]) for x in parts]])
            at, lang, run = np.concatenate([x[0] + k for x, k in zip(parts, begins, strict=False)]), *(np.concatenate([x[c] for x in parts]) for c in (1, 2))
            parts.clear()
            word, some, back = np.unique(run, return_index=True, return_inverse=True)
            back = back.astype(np.int32)
            counts = Counts.of(word, lang[some], [back[at - k] for k in (*range(1, order), 0)], None)
            at = np.searchsorted(_shard_of(word[counts.columns[0]], shards), np.arange(shards + 1))
            return out([(s, counts.pack(slice(a, b))) for s, (a, b) in enumerate(zip(at, at[1:], strict=False)) if a < b])

        for batch in batches:
            batch = batch.filter(pa.array(trusted.roles(batch) == 1))
            langs = _lang_index(batch.column(1), known.names)
            for first, _, row, h, data, start, end in _read(batch.column(2), langs, known):
                lang = langs[first + row]
                inner, opens, closes = _byte_pairs(data, start, end)
                of_byte, depth = np.zeros(len(data) + 1, np.int64), np.zeros(len(data) + 1, np.int64)
                of_byte[start + 1], depth[start + 1] = lang, 1
                np.subtract.at(depth, end, 1)
                inside = np.cumsum(depth)[: len(data)] > 0
                begun = np.maximum.accumulate(np.where(depth > 0, np.arange(len(data) + 1), 0))[: len(data)]
                for codes, own in ((inner[inside], of_byte[begun[inside]]), (opens, lang), (closes, lang)):
                    letters += np.bincount(own * _PAIRS + codes, minlength=len(letters))
                _, *run = _grams(row, lang, h, known, order)
                parts.append(run)
                size += len(run[0])
                if size >= _HELD_WORDS:
                    yield flush()
                    size = 0
        if size:
            yield flush()
        at = np.flatnonzero(letters)
        if len(at):
            yield out([(-1, _pack(at, letters[at]))])
        give_back()

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        shard = int(rows["shard"].iloc[0])
        if shard < 0:
            at, back = np.unique(np.concatenate([_unpack(x, "<i8", "<i8")[0] for x in rows["data"]]), return_inverse=True)
            n = np.zeros(len(at), np.int64)
            np.add.at(n, back, np.concatenate([_unpack(x, "<i8", "<i8")[1] for x in rows["data"]]))
            return pd.DataFrame({"shard": [shard], "data": [_pack(at, n)]})
        parts = [Counts.unpack(x, order) for x in rows["data"]]
        word, some, back = np.unique(np.concatenate([p.words for p in parts]), return_index=True, return_inverse=True)
        langs = np.concatenate([p.langs for p in parts])[some]
        ends = np.cumsum([0, *[len(p.words) for p in parts]])
        back = back.astype(np.int32)
        columns = [np.concatenate([back[a:][p.columns[c]] for p, a in zip(parts, ends, strict=False)]) for c in range(order)]
        n = np.concatenate([p.n for p in parts])
        parts.clear()
        data = Counts.of(word, langs, columns, n).pack()
        give_back()
        return pd.DataFrame({"shard": [shard], "data": [data]})

    rows = docs.select(*ROLE_COLUMNS).mapInArrow(emit, "shard int, data binary")
    return saved(rows.groupBy("shard").applyInPandas(merge, "shard int, data binary"), "ngram-counts", "none")


def discounts(n: np.ndarray) -> np.ndarray:
    """Modified Kneser-Ney discounts for counts 1, 2 and 3 or more, from how many have counts 1 to 4."""
    n1, n2, n3, n4 = (max(float(x), 0.0) for x in n[:4])
    if not (n1 and n2):
        return np.array([0.5, 0.5, 0.5])
    y = n1 / (n1 + 2 * n2)
    d = np.array([1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.5])
    return np.clip(d, 0.05, [0.95, 1.95, 2.95])


@dataclass
class Model:
    """Discounts by language and order, and the back-off weights of a text's borders; tables of a few numbers each."""

    order: int
    shards: int
    cuts: np.ndarray
    log_start: np.ndarray

    @classmethod
    def of(cls, counts: DataFrame, known: Languages, order: int, shards: int) -> Model:
        def facts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                for data in frame["data"]:
                    counts_, out = Counts.unpack(data, order), []
                    for columns, n, _ in counts_.levels():
                        level, lang = len(columns), counts_.langs[columns[0]]
                        out.append(pd.DataFrame({"lang": lang, "level": level, "kind": np.minimum(n, 5), "value": 1.0}).groupby(["lang", "level", "kind"], as_index=False).sum())
                        first, _, stats = counts_.contexts(columns, n)
                        start = np.all([counts_.words[c[first]] == known.start[lang[first]] for c in columns[:-1]], axis=0)
                        for kind in range(4):
                            out.append(pd.DataFrame({"lang": lang[first][start], "level": level, "kind": 10 + kind, "value": stats[kind][start]}))
                    yield pd.concat(out).astype({"lang": "int64", "level": "int64", "kind": "int64"})

        table = np.zeros((len(known.names), order + 1, 14))
        rows = counts.filter("shard >= 0").select("data").mapInPandas(facts, "lang long, level long, kind long, value double")
        for lang, level, kind, value in rows.groupBy("lang", "level", "kind").agg(F.sum("value")).collect():
            table[lang, level, kind] = value
        cuts = np.array([[discounts(x[1:5]) for x in own] for own in table]).reshape(-1, order + 1, 3)
        taken = (cuts * table[:, :, 11:14]).sum(axis=2)
        log_start = np.log(np.where(taken > 0, taken / np.maximum(table[:, :, 10], 1), 1)).sum(axis=1)
        return cls(order, shards, cuts, log_start)

    def kinds(self) -> list[str]:
        """Of what ``word_shards`` keeps of a shard: nested grams; then for words and for each further order, see there."""
        return [*Nested.kinds(self.order), "<u4", "<u4", "u1", *["<i2"] * (1 + 3 * (self.order - 1))]


def _in_steps(x: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(x * _STEP), _NONE + 1, 0).astype(np.int16)


def word_shards(counts: DataFrame, model: Model, rounds: int, path: str) -> DataFrame:
    """shard, data: nested grams by last word; of words language, distinct words before, whether seen once; of each order the
    back-off weight as a context, and from order two on the discounted share and the weight of the own context.

    Shards are made in ``rounds`` and lie at ``path`` in folders of their own.
    """
    order, shards = model.order, model.shards

    def spread(frames: Iterator[pd.DataFrame], turn: int) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for shard, data in zip(frame["shard"], frame["data"], strict=True):
                counts_ = Counts.unpack(data, order)
                nested, places = Nested.of([counts_.words[c] for c in (counts_.columns[-1], *counts_.columns[:-1])])
                lang, once = (np.zeros(len(nested.keys[0]), np.int64) for _ in range(2))
                lang[places[0]] = counts_.langs[counts_.columns[-1]]
                np.add.at(once, places[0], counts_.n)
                values, weights = {}, {}
                for columns, n, of_row in counts_.levels():
                    level = len(columns)
                    cut = model.cuts[counts_.langs[columns[0]], level]
                    first, back, stats = counts_.contexts(columns, n)
                    log_g = np.log((cut[first].T * stats[1:]).sum(axis=0) / stats[0])
                    left = np.log((n - cut[np.arange(len(n)), np.minimum(n, 3) - 1]) / stats[0][back])
                    for name, value in (("left", left), ("g", log_g[back])):
                        out = values[level, name] = np.zeros(len(nested.keys[level - 1]), np.int16)
                        out[places[level - 1]] = _in_steps(value)[of_row]
                    weights[level - 1] = [c[first] for c in columns[:-1]], log_g
                rows = []
                for s, part in enumerate(nested.parts(shards)):
                    if s % rounds == turn and part[0].start < part[0].stop:
                        of_levels = [values[level, name][part[level - 1]] for level in range(2, order + 1) for name in ("left", "g")]
                        rows.append((s, True, _pack(*nested.packable(part), lang[part[0]].astype(np.uint32), np.minimum(once[part[0]], 2).astype(np.uint8), *of_levels)))
                if shard % rounds == turn:
                    # contexts lie in this shard already: their last word is the word before their grams'
                    columns, _ = weights[order - 1]
                    nested, places = Nested.of([counts_.words[c] for c in columns])
                    lang = np.zeros(len(nested.keys[0]), np.int64)
                    lang[places[0]] = counts_.langs[columns[0]]
                    own = []
                    for level in range(1, order):
                        _, where = Nested.of([counts_.words[c] for c in weights[level][0]])
                        own.append(np.zeros(len(nested.keys[level - 1]), np.int16))
                        own[-1][where[-1]] = _in_steps(weights[level][1])
                    rows.append((shard, False, _pack(*nested.packable(), lang.astype(np.uint32), *own)))
                yield pd.DataFrame(rows, columns=["shard", "grams", "data"])
                del counts_, nested, places, values, weights, rows
                give_back()

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        pieces_ = []  # (grams, language, occurrences or None, what each level has)
        for grams, data in zip(rows["grams"], rows["data"], strict=True):
            kinds = Nested.kinds(order if grams else order - 1)
            arrays = _unpack(data, *kinds, "<u4", *(["u1", *["<i2"] * 2 * (order - 1)] if grams else ["<i2"] * (order - 1)))
            at = len(kinds)
            pieces_.append((Nested.unpacked(arrays[:at]), arrays[at], arrays[at + 1] if grams else None, arrays[at + 2 :] if grams else arrays[at + 1 :]))
        word = np.unique(np.concatenate([p[0].keys[0] for p in pieces_]))
        whole, langs, once = Nested([word], []), np.zeros(len(word), np.uint32), np.zeros(len(word), np.int64)
        above, own = [], np.zeros(len(word), np.int16)
        for nested, lang, seen, values in pieces_:
            at = np.searchsorted(word, nested.keys[0])
            langs[at] = lang
            if seen is None:
                own[at] = values[0]
            else:
                once[at] += seen
            above.append(at)
        out, before = [own], np.zeros(len(word), np.uint32)
        for level in range(1, order):
            pairs = [nested.pairs(level, at) if level < len(nested.keys) else None for (nested, *_), at in zip(pieces_, above, strict=True)]
            both = np.unique(np.concatenate([np.zeros(0, np.uint64), *[x for x in pairs if x is not None]]))
            left, g, own = np.full(len(both), _NONE, np.int16), np.zeros(len(both), np.int16), np.zeros(len(both), np.int16)
            for k, ((_, _, seen, values), x) in enumerate(zip(pieces_, pairs, strict=True)):
                if x is None:
                    continue
                above[k] = at = np.searchsorted(both, x)
                if seen is None:
                    own[at] = values[level]
                else:
                    left[at], g[at] = values[2 * level - 2], values[2 * level - 1]
            if level == 1:
                before += np.bincount((both >> np.uint64(_mark_bits(1))).astype(np.int64)[left != _NONE], minlength=len(word)).astype(np.uint32)
            whole.push(level, both)
            out += [left, g, own]
        pieces_.clear()
        data = _pack(*whole.packable(), langs, before, (once == 1).astype(np.uint8), *out)
        give_back()
        return pd.DataFrame({"shard": [int(rows["shard"].iloc[0])], "data": [data]})

    def made(turn: int) -> DataFrame:
        rows = counts.filter("shard >= 0").mapInPandas(lambda frames: spread(frames, turn), "shard int, grams boolean, data binary")
        return rows.groupBy("shard").applyInPandas(merge, "shard int, data binary")

    return saved_in_turn(map(made, range(rounds)), path, "none", by="shard")


class Weights:
    """What does not follow the number of words: of each language discounts, masses, spelling; see the module's text."""

    def __init__(self, known: Languages, model: Model, counts: DataFrame, words_: DataFrame):
        n_lang, kinds = len(known.names), model.kinds()
        at = 2 * model.order - 1

        def sums(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                for data in frame["data"]:
                    arrays = _unpack(data, *kinds)
                    word, lang, before, once = np.cumsum(arrays[0], dtype=np.uint64), *arrays[at : at + 3]
                    lang, before = lang.astype(np.int64), before.astype(np.int64)
                    inner = (word != known.end[lang]) & (word != known.start[lang])
                    # kinds: 0 to 31 words seen once by class, 100 distinct bigrams, 101 words, 200 and on words by the words before them
                    for kind, own, value in (((word & np.uint64(_CLASSES - 1)).astype(np.int64), inner & (once > 0), np.ones(len(word))), (100, before > 0, before), (101, inner, np.ones(len(word))), (200 + np.minimum(before, 5), before > 0, np.ones(len(word)))):
                        kind = np.broadcast_to(kind, len(word))
                        yield pd.DataFrame({"lang": lang[own], "kind": kind[own], "value": value[own].astype(float)}).groupby(["lang", "kind"], as_index=False).sum()

        table = np.zeros((n_lang, 206))
        for lang, kind, value in words_.select("data").mapInPandas(sums, "lang long, kind long, value double").groupBy("lang", "kind").agg(F.sum("value")).collect():
            table[lang, kind] = value
        self.model_kinds, self.order, self.log_start = kinds, model.order, model.log_start
        self.all_, size, level = np.maximum(table[:, 100], 1), _RESERVED + table[:, 101], table[:, 200:206]
        self.discounts = np.array([discounts(x[1:5]) for x in level]).reshape(-1, 3)
        taken = level[:, 1] * self.discounts[:, 0] + level[:, 2] * self.discounts[:, 1] + level[:, 3:].sum(axis=1) * self.discounts[:, 2]
        unseen = table[:, :_CLASSES] / self.all_[:, None]
        self.rest = 1 - unseen.sum(axis=1)
        self.floor = np.where(table[:, 100] > 0, taken / self.all_, 1) / size
        self.log_class = np.log(self.rest[:, None] * self.floor[:, None] + unseen)
        letters = np.zeros(n_lang * _PAIRS)
        for row in counts.filter("shard < 0").select("data").collect():
            at_, n = _unpack(bytes(row["data"]), "<i8", "<i8")
            letters[at_] = n
        letters = letters.reshape(n_lang, 257, 257)
        single = (letters.sum(axis=1) + 1) / (letters.sum(axis=(1, 2)) + 257)[:, None]
        self.spelling = np.rint(np.log((letters + 16 * single[:, None]) / (letters.sum(axis=2) + 16)[:, :, None]) * _UNIT).astype(np.int64).reshape(n_lang, _PAIRS)

    def unigrams(self, lang: np.ndarray, before: np.ndarray) -> np.ndarray:
        """log u of each seen word."""
        cut = np.where(before > 0, self.discounts[lang, np.clip(before, 1, 3) - 1], 0)
        return np.log(self.rest[lang] * (np.maximum(before - cut, 0) / self.all_[lang] + self.floor[lang]))

    def grams(self, data: bytes) -> tuple[Nested, list[np.ndarray]]:
        """The nested grams of one shard, and what each adds to a score."""
        arrays = _unpack(data, *self.model_kinds)
        at = 2 * self.order - 1
        nested = Nested.unpacked(arrays[:at])
        lang, before, _, own, *further = arrays[at:]
        log_p = self.unigrams(lang.astype(np.int64), before.astype(np.int64))
        weights = [log_p + own.astype(float) / _STEP]
        for level, (left, g, own) in enumerate(zip(further[::3], further[1::3], further[2::3], strict=True), 1):
            low = np.repeat(log_p, nested.per[level - 1]) + g.astype(float) / _STEP
            log_p = np.where(left == _NONE, low, np.logaddexp(left.astype(float) / _STEP, low))
            weights.append(log_p - low + (own.astype(float) / _STEP if level < self.order - 1 else 0))
        return nested, weights

    def unseen(self, lang: np.ndarray, h: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """log u of each word as if it had never been seen."""
        return (self.log_class[lang, (h & np.uint64(_CLASSES - 1)).astype(np.int64)] + _spelling(self.spelling, lang, data, start, end)).astype(np.float32)


def _found(table: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Places of wanted numbers in a sorted table, -1 for those it lacks."""
    if not len(table):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(table, wanted), len(table) - 1)
    return np.where(table[at] == wanted, at, -1)


def log_scores(docs: DataFrame, trusted: Trusted, path: str, known: Languages, model: Model, sent_weights) -> DataFrame:
    """doc_id, lang, role, n_words and score, the natural log probability, of each document (ROLE_COLUMNS); null without a model."""
    info = docs.select("doc_id", "lang", F.lit(0).alias("role")).schema
    order, shards = model.order, model.shards
    groups = max(1, -(-partitions(docs.sparkSession) // shards))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = sent_weights.value
        block = TaskContext.get().partitionId() << 32
        held: list[tuple] = []
        table: list[pa.RecordBatch] = []
        n_rows = n_words = 0

        def flush() -> pa.RecordBatch:
            nonlocal block, table, n_rows, n_words
            doc, none, base, sizes, *columns = (np.concatenate([x[c] for x in held]) for c in range(4 + order))
            held.clear()
            nested, places = Nested.of(columns)
            new = np.zeros(len(nested.keys[0]), np.float32)
            new[places[0]] = none
            pair, tf = np.unique(places[-1].astype(np.int64) * n_rows + doc, return_counts=True)
            docs_per = np.bincount(pair // n_rows, minlength=len(nested.keys[-1]))
            doc, ends, out = (pair % n_rows).astype(np.uint16), np.concatenate([[0], np.cumsum(docs_per)]), []
            for s, part in enumerate(nested.parts(shards)):
                if part[0].start < part[0].stop:
                    entries = slice(int(ends[part[-1].start]), int(ends[part[-1].stop]))
                    seen_as = np.rint(-new[part[0]] * _NEW_STEP).astype(np.uint32)
                    out.append((s, block, False, _pack(*nested.packable(part), seen_as, docs_per[part[-1]].astype(np.uint32), doc[entries], (tf[entries] - 1).astype(np.uint32))))
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table[0].schema) as writer:
                for t in table:
                    writer.write_batch(t)
            info_ = _pack(base.astype(np.float64), sizes.astype(np.uint32))
            out.append((block % shards, block, True, len(info_).to_bytes(8, "little") + info_ + sink.getvalue().to_pybytes()))
            group = int(mix(np.array([block], np.uint64))[0] % np.uint64(groups))
            block, table, n_rows, n_words = block + 1, [], 0, 0
            cols = list(zip(*out, strict=True))
            return pa.record_batch([pa.array(cols[0], pa.int32()), pa.array([group] * len(out), pa.int32()), pa.array(cols[1], pa.int64()), pa.array(cols[2]), pa.array(cols[3], pa.binary())], names=["shard", "part", "block", "info", "data"])

        for batch in batches:
            langs, roles = _lang_index(batch.column(1), known.names), pa.array(trusted.roles(batch), pa.int32())
            about = pa.record_batch([batch.column(0), batch.column(1), roles], names=["doc_id", "lang", "role"])
            for first, last, row, h, data, start, end in _read(batch.column(2), langs, known):
                sizes, lang = np.bincount(row, minlength=last - first), langs[first:last][row]
                own = lang >= 0
                row, lang, h, start, end = (x[own] for x in (row, lang, h, start, end))
                none = weights.unseen(lang, h, data, start, end) if len(row) else np.zeros(0, np.float32)
                for a in range(first, last, _BLOCK_ROWS):
                    b = min(last, a + _BLOCK_ROWS)
                    inside = (row >= a - first) & (row < b - first)
                    rows, at, _, run = _grams(row[inside] - (a - first), lang[inside], h[inside], known, order)
                    # a row's grams are its words and then its end, which is never unseen
                    spare = np.zeros(len(rows), np.float32)
                    spare[np.append(rows[1:] == rows[:-1], False) if len(rows) else []] = none[inside]
                    has = sizes[a - first : b - first] > 0
                    base = np.full(b - a, np.nan)
                    known_ = langs[a:b] >= 0
                    base[known_] = np.where(has[known_], weights.log_start[langs[a:b][known_]], 0.0)
                    if n_rows + b - a > _BLOCK_ROWS:
                        yield flush()
                    held.append((rows + n_rows, spare, base, sizes[a - first : b - first], *[run[at - k] for k in range(order)]))
                    table.append(about.slice(a, b - a))
                    n_rows += b - a
                    n_words += len(rows)
                    if n_words >= _BLOCK_WORDS:
                        yield flush()
        if held:
            yield flush()
        give_back()

    def join(blocks: pd.DataFrame) -> pd.DataFrame:
        place, top = arrow_place(f"{path}/shard={blocks['shard'].iloc[0]}")
        files = [x.path for x in place.get_file_info(fs.FileSelector(top, allow_not_found=True)) if x.path.endswith(".parquet")]
        grams, values = sent_weights.value.grams(pq.read_table(files[0], filesystem=place, columns=["data"])["data"][0].as_py()) if files else (Nested([np.zeros(0, np.uint64)] * order, [np.zeros(0, np.int64)] * (order - 1)), [np.zeros(0)] * order)
        tables = [grams.keys[0], *[grams.pairs(level) for level in range(1, order)]]
        out = []
        for block, info_, data in zip(blocks["block"], blocks["info"], blocks["data"], strict=True):
            if info_:
                out.append((block, True, data))
                continue
            *arrays, new, docs_per, doc, tf = _unpack(data, *Nested.kinds(order), "<u4", "<u4", "<u2", "<u4")
            nested = Nested.unpacked(arrays)
            at = _found(tables[0], nested.keys[0])
            each = np.where(at >= 0, values[0][at] if len(values[0]) else 0, new / -_NEW_STEP)
            for level in range(1, order):
                above, each = np.repeat(at, nested.per[level - 1]), np.repeat(each, nested.per[level - 1])
                at = np.where(above >= 0, _found(tables[level], nested.pairs(level, np.maximum(at, 0))), -1)
                each = each + (np.where(at >= 0, values[level][at], 0) if len(values[level]) else 0)
            total = np.bincount(doc, weights=np.repeat(each, docs_per) * (tf + 1.0))
            seen = np.unique(doc)
            out.append((block, False, _pack(seen.astype(np.uint16), total[seen].astype(np.float32))))
        give_back()
        return pd.DataFrame(out, columns=["block", "info", "data"])

    def collect(rows: pd.DataFrame) -> pd.DataFrame:
        data = rows.loc[rows["info"], "data"].iloc[0]
        size = int.from_bytes(data[:8], "little")
        base, n = _unpack(data[8 : 8 + size], "<f8", "<u4")
        score = base.copy()
        for part in rows.loc[~rows["info"], "data"]:
            seen, total = _unpack(part, "<u2", "<f4")
            score[seen] += total
        with pa.ipc.open_stream(data[8 + size :]) as reader:
            frame = reader.read_all().to_pandas()
        give_back()
        return frame.assign(n_words=n.astype(np.int64), score=np.where(np.isnan(score) | (n == 0), None, score))

    rows = docs.select(*ROLE_COLUMNS).mapInArrow(emit, "shard int, part int, block long, info boolean, data binary")
    joined = rows.groupBy("shard", "part").applyInPandas(join, "block long, info boolean, data binary")
    schema = info.add("n_words", "long").add("score", "double")
    return joined.groupBy("block").applyInPandas(collect, schema)


def quality(docs: DataFrame, labels: DataFrame, *, order: int = 3, quantile: float = 0.99, least_documents: int = 50, broadcast_labels: int = 4_000_000, rounds: int = 4) -> DataFrame:
    """doc_id, lang, n_words, perplexity, threshold, kept for each row of ``docs`` (doc_id, text, lang).

    ``order`` is the model's, two or more. The threshold is the ``quantile`` of the perplexities of the trusted
    documents held back, by language and length (powers of four of the words); by language alone, and then over all, where
    there are fewer than ``least_documents``. Ids of trusted documents are broadcast up to
    ``broadcast_labels`` of them, and joined beyond. The model's shards are made, and then all documents scored, in
    ``rounds`` by hash, so that shuffle files of one round alone take up room on disk.
    """
    if order < 2:
        raise ValueError("the order is two or more")
    bounded_batches(docs.sparkSession)
    spark = docs.sparkSession
    good = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min(F.coalesce((F.col("quality") == 1) & (F.col("toxic") == 0), F.lit(False))).alias("trusted"))
    trusted = saved(good.filter("trusted and doc_id is not null").select("doc_id"), "trusted", narrow=True)
    held = F.pmod(F.xxhash64("doc_id"), F.lit(_HELD_BACK)) == 0
    rows = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("lang"), "text", held.alias("held"))
    with_ids = trusted.select(F.col("doc_id").alias("id"), F.lit(True).alias("trusted"))
    same = F.col("doc_id").cast("long") == F.col("id")
    sizes = rows.filter("not held").select("doc_id", "lang", F.octet_length("text").alias("size")).join(with_ids, same).groupBy("lang").agg(F.sum("size")).collect()
    if trusted.count() <= broadcast_labels:
        rows, chosen = rows.withColumn("trusted", F.lit(None).cast("boolean")), Trusted(trusted)
    else:
        rows, chosen = rows.join(with_ids, same, "left").drop("id"), Trusted(None)
    known = Languages(sorted(r[0] for r in sizes))
    shards = max(_LEAST_SHARDS, sum(r[1] or 0 for r in sizes) // _SHARD_BYTES)
    counts = count_shards(rows, chosen, known, order, shards)
    model = Model.of(counts, known, order, shards)
    path = folder(spark, "ngram-words")
    words_ = word_shards(counts, model, rounds, path)
    weights = spark.sparkContext.broadcast(Weights(known, model, counts, words_))
    discard(counts)
    turn = F.pmod(F.xxhash64("doc_id", F.lit("turn")), F.lit(rounds))
    scored = saved_in_turn((log_scores(rows.filter(turn == k), chosen, path, known, model, weights) for k in range(rounds)), folder(spark, "ngram-scores"))
    scored = scored.withColumn("perplexity", F.exp(-F.col("score") / (F.col("n_words") + 1))).drop("score")
    weights.unpersist()
    discard(words_, trusted)
    scored = scored.withColumn("length", F.floor(F.log2(F.greatest("n_words", F.lit(1))) / 2).cast("int"))
    set_by = scored.filter("role = 2 and perplexity is not null")
    out = scored
    for name, by in (("t1", ["lang", "length"]), ("t2", ["lang"])):
        level = set_by.groupBy(*by).agg(F.percentile_approx("perplexity", quantile, 10_000).alias(name), F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_documents).drop("n")
        out = out.join(F.broadcast(level) if len(known.names) <= 10_000 else level, by, "left")  # at most some thirty lengths a language
    rest = set_by.agg(F.percentile_approx("perplexity", quantile, 10_000).alias("t3"), F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_documents).drop("n")
    out = out.join(F.broadcast(rest), how="left").withColumn("threshold", F.coalesce("t1", "t2", "t3"))
    kept = (F.col("n_words") > 0) & F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True))
    return out.select("doc_id", "lang", "n_words", "perplexity", "threshold", kept.alias("kept"))
