"""Language identification by words first, then by ever shorter character n-grams.

A word that the lexicon knows scores its log frequency in each language. A word that it
does not know scores the mean log frequency of its n-grams of the greatest length, from
``longest`` down to 1, of which any is known. A document takes the language with the
greatest sum.

The model is fitted on a bounded sample of labelled rows: about ``max_docs`` documents of each
language, by a hash of the id, and at most ``max_words`` words and ``max_grams`` n-grams in all.
So what is broadcast has a fixed bound. Predictions read the text alone.

Defined results: null, empty and letterless texts are ``und`` with score 0; ties go to the
language that sorts first; without any labelled row every document is ``und``; repeated rows are
predicted again each; null ids count as not held out.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import bounded_batches, saved
from .text import give_back, pieces, span_hashes, words

if TYPE_CHECKING:
    import pandas as pd

#: Bytes between words, once lower-cased: everything but a-z and bytes of longer characters.
_GAP = np.ones(256, bool)
_GAP[97:123] = False
_GAP[128:] = False
_MOST_KNOWN, _MOST_LANGUAGES, _PIECE_BYTES = 1 << 18, 10_000, 1 << 19


#: Third bytes of the letters among U+2040 to U+207F (E2 81) and U+3000 to U+303F (E3 80).
_LETTERS = {0x81: (0xB1, 0xBF), 0x80: (0x85, 0x86, 0x87, 0xB1, 0xB2, 0xB3, 0xB4, 0xB5, 0xBB, 0xBC)}


def _gaps(data: np.ndarray) -> np.ndarray:
    """Bytes between words, with the white space and punctuation of U+0080 to U+00BF, U+2000 to U+207F and U+3000 to U+303F."""
    gap = _GAP[data]
    ahead, third = np.append(data[1:], 0), np.append(data[2:], (0, 0))[: len(data)]
    latin = np.flatnonzero((data == 0xC2) & ~np.isin(ahead, (0xAA, 0xB5, 0xBA)))
    general = (data == 0xE2) & ((ahead == 0x80) | ((ahead == 0x81) & ~np.isin(third, _LETTERS[0x81])))
    wide = np.flatnonzero(general | ((data == 0xE3) & (ahead == 0x80) & ~np.isin(third, _LETTERS[0x80])))
    for at in (latin, latin + 1, wide, wide + 1, wide + 2):
        gap[at[at < len(data)]] = True
    return gap


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text leaves 1 modulo 3."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def _word_counts(column: pa.Array) -> Iterator[tuple[str, int]]:
    for _, _, data, offsets in pieces(pc.utf8_lower(column)):
        start, end, _ = words(data, offsets, _gaps(data))
        _, first, n = np.unique(span_hashes(data, start, end), return_index=True, return_counts=True)
        raw = data.tobytes()
        for k, c in zip(first, n, strict=True):
            yield raw[start[k] : end[k]].decode("utf-8", "replace"), int(c)


def grams(word: str, n: int) -> list[str]:
    marked = f"^{word}$" if n > 1 else word
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


class Table:
    """Log frequencies in each language of some items: one row of a matrix for each."""

    def __init__(self, items: list[str], counts: np.ndarray):
        self.place = {item: k for k, item in enumerate(items)}
        self.logs = np.log((counts + 0.5) / (counts.sum(axis=0) + 0.5 * max(len(items), 1))).astype(np.float32)


class Model:
    """Log frequencies by language of words and of character n-grams."""

    def __init__(self, languages: list[str], words_: Table, grams_: Table, longest: int):
        self.languages, self.words, self.grams, self.longest = languages, words_, grams_, longest
        self.scorer: _Scorer | None = None

    def score(self, word: str) -> np.ndarray | None:
        """The log frequency of a word in each language; None if it has no letter."""
        if not any(map(str.isalpha, word)):
            return None
        known = self.words.place.get(word)
        if known is not None:
            return self.words.logs[known]
        place = self.grams.place
        for n in range(self.longest, 0, -1):
            found = [place[g] for g in grams(word, n) if g in place]
            if found:
                return self.grams.logs[found].mean(axis=0)
        return np.zeros(len(self.languages), np.float32)


def _table_of(counts: DataFrame, languages: list[str]) -> Table:
    """One row for each item, its counts in the languages side by side: what the driver takes is bounded by ``_most_frequent``."""
    wide = counts.groupBy("item").agg(*[F.sum(F.when(F.col("lang") == x, F.col("n")).otherwise(0)).alias(f"n{k}") for k, x in enumerate(languages)]).toArrow()
    columns = [wide.column(k + 1).to_numpy() for k in range(len(languages))]
    return Table(wide.column(0).to_pylist(), np.stack(columns, axis=1).astype(np.float64) if columns else np.zeros((wide.num_rows, 0)))


def _most_frequent(counts: DataFrame, limit: int) -> DataFrame:
    """The items of (lang, item, n) at or above the count that at most ``limit`` items reach."""
    totals = counts.groupBy("item").agg(F.sum("n").alias("total"))
    by_count = totals.groupBy(F.least(F.col("total"), F.lit(1 << 20)).alias("total")).agg(F.count(F.lit(1)).alias("items")).orderBy(F.desc("total")).collect()
    least, held = 2, 0
    for row in by_count:
        held += row["items"]
        if held > limit:
            least = max(2, row["total"] + 1)
            break
    return counts.join(totals.filter(F.col("total") >= least).select("item"), "item")


def fit(labelled: DataFrame, *, max_docs: int = 4000, max_words: int = 50_000, max_grams: int = 100_000, longest: int = 5) -> Model:
    """A model from (doc_id, text, lang); rows without text or language are left out."""
    bounded_batches(labelled.sparkSession)
    labelled = labelled.filter("text is not null and lang is not null").select("doc_id", "text", "lang")
    sizes = saved(labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("docs")), "languages", narrow=True)
    sizes = F.broadcast(sizes) if sizes.count() <= _MOST_LANGUAGES else sizes
    share = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) * F.col("docs") < F.lit(max_docs * 1_000_000)
    sample = labelled.join(sizes, "lang").filter(share).select("lang", "text")

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column(0).to_numpy(zero_copy_only=False)
            for lang in set(langs.tolist()):
                tally: Counter = Counter()
                for word, n in _word_counts(batch.column(1).filter(pa.array(langs == lang))):
                    tally[word] += n
                yield pa.record_batch([pa.array([lang] * len(tally), pa.string()), pa.array(list(tally), pa.string()), pa.array(list(tally.values()), pa.int64())], names=["lang", "item", "n"])

    def count_grams(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pandas as pd

        for frame in frames:
            tally: Counter = Counter()
            for lang, word, n in zip(frame["lang"], frame["item"], frame["n"], strict=True):
                for size in range(1, longest + 1):
                    for g in grams(word, size):
                        tally[lang, g] += n
            yield pd.DataFrame([(lang, g, n) for (lang, g), n in tally.items()], columns=["lang", "item", "n"])

    counts = saved(sample.mapInArrow(count_words, "lang string, item string, n long").groupBy("lang", "item").agg(F.sum("n").alias("n")), "language-words")
    pieces_ = saved(counts.mapInPandas(count_grams, "lang string, item string, n long").groupBy("lang", "item").agg(F.sum("n").alias("n")), "language-grams")
    languages = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
    if not languages:
        return Model([], Table([], np.zeros((0, 0))), Table([], np.zeros((0, 0))), longest)
    return Model(languages, _table_of(_most_frequent(counts, max_words), languages), _table_of(_most_frequent(pieces_, max_grams), languages), longest)


class _Scorer:
    """Scores of the words met so far in a Python worker, by hash; starts anew beyond 2^18 words."""

    def __init__(self, model: Model):
        self.model = model
        self.hashes, self.scores = np.zeros(0, np.uint64), np.zeros((0, len(model.languages) + 1), np.float32)

    def __call__(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """For each word its scores, and 1 if it has a letter."""
        unique, first, back = np.unique(span_hashes(data, start, end), return_index=True, return_inverse=True)
        at = np.searchsorted(self.hashes, unique)
        new = at == len(self.hashes)
        new[~new] = self.hashes[at[~new]] != unique[~new]
        if new.any():
            if len(self.hashes) + new.sum() > _MOST_KNOWN:
                self.hashes, self.scores = self.hashes[:0], self.scores[:0]
                new[:] = True
            raw, rows = data.tobytes(), []
            nothing = np.zeros(len(self.model.languages) + 1, np.float32)
            for k in first[new]:
                score = self.model.score(raw[start[k] : end[k]].decode("utf-8", "replace"))
                rows.append(nothing if score is None else np.append(score, 1))
            hashes, scores = np.concatenate([self.hashes, unique[new]]), np.concatenate([self.scores, np.array(rows, np.float32)])
            order = np.argsort(hashes)
            self.hashes, self.scores = hashes[order], scores[order]
        return self.scores[np.searchsorted(self.hashes, unique)][back]


def predict(docs: DataFrame, model: Model, *, text: str = "text", steady: int = 20) -> DataFrame:
    """``docs`` with lang_pred and score added, the posterior of the language from at most ``steady`` mean words.

    Columns of ``docs`` with those two names are replaced.
    """
    languages = [*model.languages, "und"]
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kept = [f for f in docs.schema.fields if f.name not in ("lang_pred", "score")]
    names = [f.name for f in kept]
    schema = docs.select(*[F.col(f"`{n}`") for n in names]).withColumns({"lang_pred": F.lit("und"), "score": F.lit(0.0)}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value  # a Python worker keeps it, and so the scorer, as long as its tasks use it
        scorer = model.scorer = model.scorer or _Scorer(model)
        for batch in batches:
            column = pc.utf8_lower(batch.column(names.index(text)))
            for first, last, data, offsets in pieces(column, _PIECE_BYTES):
                n = last - first
                start, end, row = words(data, offsets, _gaps(data))
                each = scorer(data, start, end)
                sums = np.stack([np.bincount(row, weights=each[:, k], minlength=n) for k in range(len(languages))], axis=1)
                seen, sums = sums[:, -1], sums[:, :-1]
                if not sums.shape[1]:
                    sums, seen = np.zeros((n, 1)), np.zeros(n)
                mean = sums / np.maximum(seen, 1)[:, None] * np.minimum(seen, steady)[:, None]
                best = np.where(seen > 0, mean.argmax(axis=1), len(languages) - 1)
                score = np.where(seen > 0, 1 / np.exp(mean - mean.max(axis=1, keepdims=True)).sum(axis=1), 0.0)
                pred = pa.array(np.array(languages, object)[best], pa.string())
                yield pa.record_batch([*batch.slice(first, n).columns, pred, pa.array(score, pa.float64())], names=[*names, "lang_pred", "score"])
        give_back()

    bounded_batches(docs.sparkSession)
    return docs.select(*[F.col(f"`{n}`") for n in names]).mapInArrow(run, schema)
