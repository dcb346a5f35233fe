"""Phrase collocations from position bitmaps: shift, AND and popcount, summed over shards.

Texts are cut into shards of some one and a half million word positions. In a shard every word has a bitmap of the
positions where it stands; bitmaps are compressed, as only words of 16 positions that hold a bit are kept. A phrase
has a bitmap too, of the positions of its last word. It is extended by one word: its bitmap, shifted by one, AND the
bitmap of each word in the same sixteen positions, AND the positions where the longer phrase's tail is frequent; the
popcount is the longer phrase's count in the shard. Empty positions stand between pieces, texts, and at words that are
not frequent, so that no phrase reaches over them.

Whether a phrase is frequent is known only once its popcounts are summed over all shards, so each further word of
length is a Spark job: shards walk down from words through the phrases that are known to be frequent, and one word
beyond. Their counts meet in as many buckets by hash as there are shards, so that a bucket is no larger than a shard, and
each shard gets back the list of just those of its own phrases that are frequent; nothing is broadcast.

Odd rows: a null or empty text has no words; a null language is ``und``; doc_id isn't read, so repeated rows count as
often as they stand. A single text longer than a shard makes one longer shard. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scratch import bounded_batches, discard, saved
from .text import ASCII_LOWER, give_back, mix, pieces, words

SHARD_POSITIONS = 3 << 19
WIDTH = 16
#: Chunks of ``WIDTH`` positions that are ANDed at a time.
SLAB = 1 << 13
#: Bits that number the shards of a task, the words of a shard (no more than its positions), and the frequent phrases of a bucket.
SHARD_BITS, KEY_BITS, RANK_BITS = 12, 30, 24

#: Bytes that part words, and those that also end a piece: . , ; : ! ? and 0x0A to 0x0D.
GAP, STOP = np.zeros(256, bool), np.zeros(256, bool)
STOP[[0x2E, 0x2C, 0x3B, 0x3A, 0x21, 0x3F, 0x0A, 0x0B, 0x0C, 0x0D]] = True
GAP[[0x20, 0x09]] = True
GAP |= STOP


# --- shards ------------------------------------------------------------------------------------------


def _positions(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(words, row of each, whether it begins a piece) of lower-cased texts."""
    start, end, row = words(data, offsets, GAP)
    stops = np.concatenate([[0], np.cumsum(STOP[data])])
    begins = np.ones(len(start), bool)
    if len(start) > 1:
        begins[1:] = (row[1:] != row[:-1]) | (stops[start[1:]] != stops[end[:-1]])
    inside = np.zeros(len(data) + 1, np.int8)
    inside[start] += 1
    inside[end] -= 1
    held = data[np.cumsum(inside[:-1]) > 0]
    at = np.concatenate([[0], np.cumsum(end - start)]).astype(np.int64)
    return pa.Array.from_buffers(pa.large_string(), len(start), [None, pa.py_buffer(at), pa.py_buffer(held)]), row, begins


def _planes(ids: np.ndarray) -> bytes:
    """Numbers by planes of their bytes, packed: a word that is met early has a small number, so the upper planes are nearly empty."""
    return len(ids).to_bytes(8, "little") + pa.compress(ids.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes(), codec="zstd", asbytes=True)


def _from_planes(packed: pa.Buffer) -> np.ndarray:
    n = int.from_bytes(packed.slice(0, 8).to_pybytes(), "little")
    planes = pa.decompress(packed.slice(8), decompressed_size=4 * n, codec="zstd")
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, n).T).view("<i4").ravel()


class _Shard:
    """Positions of whole texts: a code for each word of a language, 0 for what parts pieces."""

    def __init__(self) -> None:
        self.langs: dict[str, int] = {}
        self.words: list[pa.Array] = []
        self.lang_of: list[np.ndarray] = []
        self.begins: list[np.ndarray] = []
        self.n = 0

    def add(self, texts: pa.Array, row: np.ndarray, begins: np.ndarray, langs: list[str | None]) -> None:
        number = np.array([self.langs.setdefault("und" if x is None else x, len(self.langs)) for x in langs], np.int32)
        coded = texts.dictionary_encode()
        self.words.append(coded)
        self.lang_of.append(number[row])
        self.begins.append(begins)
        self.n += len(texts)

    def row(self, number: int) -> dict[str, object]:
        coded = pa.chunked_array(self.words).unify_dictionaries().combine_chunks()
        coded = coded.chunk(0) if isinstance(coded, pa.ChunkedArray) else coded
        lang, begins = np.concatenate(self.lang_of), np.concatenate(self.begins)
        size = len(coded.dictionary)
        key = lang.astype(np.int64) * size + np.asarray(coded.indices, np.int64)
        known, code, count = np.unique(key, return_inverse=True, return_counts=True)
        ids = np.zeros(self.n + int(begins.sum()), np.int32)
        ids[np.arange(self.n) + np.cumsum(begins)] = code + 1
        names = list(self.langs)
        return {
            "shard": number, "ids": _planes(ids),
            "vocabulary": {"lang": [names[k] for k in known // size], "word": coded.dictionary.take(pa.array(known % size)).to_pylist(), "n": count.tolist()},
        }


_VOCABULARY = pa.struct([("lang", pa.list_(pa.string())), ("word", pa.list_(pa.string())), ("n", pa.list_(pa.int64()))])
_SHARDS = "shard long, ids binary, vocabulary struct<lang:array<string>,word:array<string>,n:array<long>>"


def _shards(limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("shard", pa.int64()), ("ids", pa.binary()), ("vocabulary", _VOCABULARY)])
        number, shard = TaskContext.get().partitionId() << SHARD_BITS, _Shard()
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for first, stop, data, offsets in pieces(batch.column("text")):
                shard.add(*_positions(ASCII_LOWER[data], offsets), langs[first:stop])
                if shard.n >= limit:
                    yield pa.RecordBatch.from_pylist([shard.row(number)], schema=schema)
                    number, shard = number + 1, _Shard()
                    if not number % (1 << SHARD_BITS):
                        raise ValueError("a task has too many shards; give its input more partitions")
        if shard.n:
            yield pa.RecordBatch.from_pylist([shard.row(number)], schema=schema)
        give_back()

    return run


# --- bitmaps -----------------------------------------------------------------------------------------


class Bitmaps:
    """Bitmaps of many items over the positions of a shard: for each chunk of 16 positions the items that occur in it.

    ``codes`` and ``masks`` have one line a chunk and one column an item of it; empty places have code -1 and mask 0.
    """

    def __init__(self, codes: np.ndarray, masks: np.ndarray):
        self.codes, self.masks = codes, masks

    @classmethod
    def of(cls, chunk: np.ndarray, code: np.ndarray, mask: np.ndarray, chunks: int, width: int = WIDTH) -> Bitmaps:
        """From rows (chunk, code, mask) in order of chunk, each pair of chunk and code once."""
        codes, masks = np.full((chunks, width), -1, np.int64), np.zeros((chunks, width), np.uint16)
        place = np.arange(len(chunk)) - np.searchsorted(chunk, chunk)
        codes[chunk, place], masks[chunk, place] = code, mask
        return cls(codes, masks)

    @classmethod
    def at(cls, items: np.ndarray) -> Bitmaps:
        """From the item of each position, -1 for none; the length is a multiple of 16."""
        lines = items.reshape(-1, WIDTH).astype(np.int64)
        order = np.argsort(lines, 1, kind="stable")
        lines, bits = np.take_along_axis(lines, order, 1).ravel(), np.left_shift(np.uint16(1), order.astype(np.uint16)).ravel()
        first = np.ones(len(lines), bool)
        first[1:] = lines[1:] != lines[:-1]
        first[::WIDTH] = True
        begin = np.flatnonzero(first)
        mask = np.bitwise_or.reduceat(bits, begin) if len(begin) else np.zeros(0, np.uint16)
        chunk, code = begin // WIDTH, lines[begin]
        some = code >= 0
        return cls.of(chunk[some], code[some], mask[some], len(items) // WIDTH)

    def shifted(self) -> Bitmaps:
        """Every bitmap moved by one position; the last bit of a chunk goes to the next chunk, as an item of its own there."""
        codes = np.full((len(self.codes), WIDTH + 1), -1, np.int64)
        masks = np.zeros((len(self.codes), WIDTH + 1), np.uint16)
        codes[:, :WIDTH], masks[:, :WIDTH] = self.codes, self.masks << np.uint16(1)
        chunk, place = np.nonzero(self.masks >> np.uint16(15))
        chunk, place = chunk[chunk + 1 < len(codes)], place[chunk + 1 < len(codes)]
        codes[chunk + 1, WIDTH], masks[chunk + 1, WIDTH] = self.codes[chunk, place], 1
        return Bitmaps(codes, masks)

    def union(self) -> np.ndarray:
        """One bitmap of all positions that any item holds."""
        return np.bitwise_or.reduce(self.masks, 1)

    def meet(self, others: Bitmaps, within: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(chunk, code, other's code, mask) wherever an item's bitmap AND another's AND ``within`` is not empty."""
        parts = []
        alive = np.flatnonzero(self.union() & within)  # chunks where anything can meet at all
        wide, high = others.masks.shape[1], self.masks.shape[1]
        for k in range(0, len(alive), SLAB):
            own = alive[k : k + SLAB]
            both = (self.masks[own][:, :, None] & (others.masks[own] & within[own, None])[:, None, :]).ravel()
            at = np.flatnonzero(both != 0)
            chunk, place = own[at // (high * wide)], at % (high * wide)
            parts.append((chunk, self.codes[chunk, place // wide], others.codes[chunk, place % wide], both[at]))
        return tuple(np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint16),)


def _spread(chunk: np.ndarray, mask: np.ndarray, item: np.ndarray, size: int) -> np.ndarray:
    """The item of each position, -1 for none, of bitmaps that don't overlap."""
    out = np.full(size, -1, np.int64)
    for bit in range(WIDTH):
        here = (mask >> np.uint16(bit)) & np.uint16(1) == 1
        out[chunk[here] * WIDTH + bit] = item[here]
    return out


def grow(ids: np.ndarray, lists: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(prefix id, suffix id, count) of the phrases of a shard that are one word longer than the last of ``lists``.

    ``lists[k]`` has the frequent phrases of k + 1 words: keys, and their ids in all shards. A word's key is its code; a
    longer phrase's is its place in the order of (prefix, last word) among what the walk found here at its length.
    """
    size = -(-len(ids) // WIDTH) * WIDTH
    word_codes, word_ids = lists[0]
    to_word = np.full(int(ids.max(initial=0)) + 1, -1, np.int64)
    to_word[word_codes] = np.arange(len(word_codes))
    items = np.full(size, -1, np.int64)
    items[: len(ids)] = to_word[ids]
    level = each = Bitmaps.at(items)
    names, n_words = word_ids, max(1, len(word_codes))
    for depth in range(1, len(lists) + 1):
        chunk, code, word, mask = level.shifted().meet(each, level.union())
        key, place = np.unique(code * n_words + word, return_inverse=True)
        if depth == len(lists):
            count = np.zeros(len(key), np.int64)
            np.add.at(count, place, np.bitwise_count(mask).astype(np.int64))
            one = np.zeros(len(key), np.int64)  # a position where each stands
            one[place] = chunk * WIDTH + np.bitwise_count((mask & -mask.astype(np.int32)).astype(np.uint16) - np.uint16(1))
            return names[key // n_words], names[items[one]], count
        held, ids_here = lists[depth]
        frequent = np.full(len(key), -1, np.int64)
        frequent[held] = np.arange(len(held))
        item = frequent[place]
        some = item >= 0
        chunk, mask, item = chunk[some], mask[some], item[some]
        items = _spread(chunk, mask, item, size)
        level, names = Bitmaps.at(items), ids_here
    raise ValueError("no lists")


# --- jobs --------------------------------------------------------------------------------------------


_LISTED = "shard long, key array<int>, id array<long>, first array<struct<id:long,lang:string,word:string,a:long>>"


def _listed(words_: pa.Table) -> pa.Table:
    """The frequent words of a shard in one row, with language, text and count of those whose id it gave."""
    own = words_.filter(pc.is_valid(words_.column("word"))).combine_chunks()
    parts = [own.column(c).combine_chunks().cast(kind) for c, kind in (("id", pa.int64()), ("lang", pa.string()), ("word", pa.string()), ("a", pa.int64()))]
    listed = [words_.column("key").combine_chunks().cast(pa.int32()), words_.column("id").combine_chunks(), pa.StructArray.from_arrays(parts, ["id", "lang", "word", "a"])]
    whole = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in listed]
    return pa.Table.from_arrays([words_.column("shard").slice(0, 1).combine_chunks(), *whole], ["shard", "key", "id", "first"])


def _grown(buckets: int, depth: int):
    """bucket, shard and, as arrays, the phrases of a shard that are a word longer than its longest list, dealt out by hash."""
    schema = pa.schema([("bucket", pa.int64()), ("shard", pa.int64())] + [(c, pa.binary()) for c in _ARRAYS])

    def run(shards: pa.Table, held: pa.Table) -> pa.Table:
        lists, level = [], np.asarray(held.column("level"))
        for k in range(depth):
            rows = held.filter(pa.array(level == k))
            key, own = (np.asarray(pc.list_flatten(rows.column(c).combine_chunks()), np.int64) for c in ("key", "id"))
            order = np.argsort(key)
            lists.append((key[order], own[order]))
        if not shards.num_rows or not all(len(key) for key, _ in lists):
            return schema.empty_table()
        prefix, suffix, n = grow(_from_planes(shards.column("ids")[0].as_buffer()), lists)
        bucket = (mix(prefix.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) ^ suffix.astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cut = np.flatnonzero(np.diff(bucket[order], prepend=-1))
        parts = np.split(order, cut[1:]) if len(order) else []
        blobs = [[x[own].astype(kind).tobytes() for own in parts] for x, kind in ((np.arange(len(n)), np.int32), (prefix, np.int64), (suffix, np.int64), (n, np.int32))]
        out = pa.Table.from_arrays([pa.array(bucket[order][cut], pa.int64()), pa.array(np.full(len(parts), shards.column("shard")[0].as_py()), pa.int64()), *[pa.array(x, pa.binary()) for x in blobs]], schema=schema)
        give_back()
        return out

    return run


_ARRAYS = ("key", "prefix", "suffix", "n")
_DEALT = "bucket long, shard long, key binary, prefix binary, suffix binary, n binary"
_SUMMED = "shard long, key array<int>, id array<long>, prefix array<long>, suffix array<long>, a array<long>"


def _summed(least: int):
    """Sums the counts of a bucket over all shards: a row for each shard with its frequent phrases, and one without shard for all of them."""
    schema = pa.schema([("shard", pa.int64()), ("key", pa.list_(pa.int32()))] + [(c, pa.list_(pa.int64())) for c in ("id", "prefix", "suffix", "a")])

    def run(table: pa.Table) -> pa.Table:
        blobs = {c: [x.as_buffer() for x in table.column(c)] for c in _ARRAYS}
        key, prefix, suffix, n = (np.concatenate([np.frombuffer(x, kind) for x in blobs[c]]) for c, kind in zip(_ARRAYS, (np.int32, np.int64, np.int64, np.int32), strict=True))
        shard = np.repeat(np.asarray(table.column("shard")), [len(x) // 4 for x in blobs["key"]])
        order = np.lexsort((suffix, prefix))
        p, s = prefix[order], suffix[order]
        begin = np.flatnonzero(np.concatenate([[True], (p[1:] != p[:-1]) | (s[1:] != s[:-1])]))
        a = np.add.reduceat(n[order].astype(np.int64), begin)
        held = np.flatnonzero(a >= least)
        if len(held) >= 1 << RANK_BITS:
            raise ValueError("a bucket has too many frequent phrases")
        own = np.full(len(a), -1, np.int64)
        own[held] = (int(table.column("bucket")[0].as_py()) << RANK_BITS) + np.arange(len(held))
        number = np.empty(len(order), np.int64)
        number[order] = np.repeat(own, np.diff(begin, append=len(order)))
        some = np.flatnonzero(number >= 0)
        some = some[np.argsort(shard[some], kind="stable")]
        cut = np.flatnonzero(np.diff(shard[some], prepend=-1))
        rows = [{"shard": int(shard[x[0]]), "key": key[x], "id": number[x]} for x in np.split(some, cut[1:]) if len(x)]
        rows.append({"shard": None, "id": own[held], "prefix": p[begin[held]], "suffix": s[begin[held]], "a": a[held]})
        return pa.Table.from_pylist(rows, schema=schema)

    return run


def frequent_phrases(docs: DataFrame, least: int = 100, longest: int = 5, shard_positions: int = SHARD_POSITIONS) -> tuple[DataFrame, list[DataFrame], list[DataFrame]]:
    """(lang and n, tables of the phrases of 1 to ``longest`` words that occur ``least`` times, scratch tables).

    A table has id, prefix, suffix (ids of the phrases without the last and without the first word), lang, words,
    a, and before and after: the counts of its prefixes from one word on, and of its suffixes from the longest on.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    shards = saved(docs.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")).mapInArrow(_shards(shard_positions), _SHARDS), "phrase-shards", long_rows=True)
    total = shards.select(F.explode(F.arrays_zip("vocabulary.lang", "vocabulary.n")).alias("x")).groupBy(F.col("x.lang").alias("lang")).agg(F.sum("x.n").alias("n"))
    each = shards.select("shard", F.posexplode(F.arrays_zip("vocabulary.lang", "vocabulary.word", "vocabulary.n")).alias("at", "x"))
    each = each.select("shard", (F.col("at") + 1).alias("key"), "x.lang", "x.word", "x.n")
    within = Window.partitionBy("lang", "word")
    own = F.shiftleft(F.col("shard"), KEY_BITS).bitwiseOR(F.col("key").cast("long"))  # a word's id is its number in one of its shards
    each = each.withColumns({"a": F.sum("n").over(within), "id": F.min(own).over(within)}).filter(F.col("a") >= least)
    # the lists of a shard are met by each length: as rows of single words they would move some forty bytes a word each time
    new = lambda c: F.when(F.col("id") == own, F.col(c)).alias(c)
    marked = [saved(each.select("shard", "key", "id", new("lang"), new("word"), new("a")).groupBy("shard").applyInArrow(_listed, _LISTED), "phrase-1", long_rows=True)]
    buckets = max(1, shards.count())  # a bucket has about as many counts as a shard
    none = F.array().cast("array<long>")
    tables = [marked[0].select(F.inline("first")).select("id", "lang", F.array("word").alias("words"), "a", none.alias("before"), none.alias("after"))]
    scratch = [shards, marked[0]]
    for length in range(2, longest + 1):
        lists = None
        for k, own in enumerate(marked):
            level = own.select("shard", F.lit(k).alias("level"), "key", "id")
            lists = level if lists is None else lists.unionByName(level)
        # a shard meets its lists by merging, which spills; collected, the lists of all shards of a task would lie in memory
        grown = shards.select("shard", "ids").groupBy("shard").cogroup(lists.groupBy("shard")).applyInArrow(_grown(buckets, length - 1), _DEALT)
        counted = grown.groupBy("bucket").applyInArrow(_summed(least), _SUMMED)
        summed = saved(counted, f"phrase-{length}")
        marked.append(summed.filter("shard is not null").select("shard", "key", "id"))
        shorter = tables[-1]
        head = shorter.select(F.col("id").alias("prefix"), "lang", F.col("words").alias("head"), F.array_append("before", F.col("a")).alias("before"))
        tail = shorter.select(F.col("id").alias("suffix"), F.element_at("words", -1).alias("last"), F.array_prepend("after", F.col("a")).alias("after"))
        own = summed.filter("shard is null").select(F.inline(F.arrays_zip("id", "prefix", "suffix", "a"))).join(head, "prefix").join(tail, "suffix")
        table = saved(own.select("id", "prefix", "suffix", "lang", F.array_append("head", F.col("last")).alias("words"), "a", "before", "after"), f"phrase-table-{length}", narrow=True)
        tables.append(table)
        scratch += [summed, table]
    return total, tables, scratch


def collocations(docs: DataFrame, least: int = 100, longest: int = 5, most: int = 2000, shard_positions: int = SHARD_POSITIONS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first ``most`` phrases of 2 to ``longest`` words.

    ``a`` is a phrase's count, ``n`` that of its language's words; l and r are the counts of its two parts at the cut that
    scores lowest, score = floor(1000 a n / (l r)), exact in decimals of 38 digits. A phrase is left out if it never
    stands but inside one longer phrase; such a phrase has one that is a single word longer and as frequent.
    """
    total, tables, scratch = frequent_phrases(docs, least, longest, shard_positions)
    kept = None
    for k in range(1, longest):
        own = tables[k]
        if k + 1 < longest:
            longer = tables[k + 1].select("prefix", "suffix", F.col("a").alias("b"))
            over = longer.select(F.col("prefix").alias("id"), "b").unionByName(longer.select(F.col("suffix").alias("id"), "b"))
            whole = own.select("id", "a").join(over, "id").filter("100 * b >= 100 * a").select("id").distinct()
            own = own.join(whole, "id", "left_anti")
        own = own.select("lang", F.array_join("words", " ").alias("phrase"), "a", "before", "after")
        kept = own if kept is None else kept.unionByName(own)
    wide = lambda c: f"cast({c} as decimal(19,0))"
    score = f"({wide('a')} * {wide('n')} * 1000BD) div ({wide('l')} * {wide('after[i]')})"
    cuts = f"array_min(transform(before, (l, i) -> named_struct('score', {score}, 'k', i, 'l', l, 'r', after[i])))"
    lowest = kept.join(total, "lang").select("lang", "phrase", "a", "n", F.expr(cuts).alias("m")).select("lang", "phrase", "a", "m.l", "m.r", "n", "m.score")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase")))
    out = lowest.withColumn("rank", rank).filter(F.col("rank") <= most)
    out = saved(out.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"), "collocations", narrow=True)
    discard(*scratch)
    return out
