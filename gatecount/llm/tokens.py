"""Token ids of whole text columns by a public tokenizer file, each distinct word encoded once.

The tokenizer splits at white space and between letters and punctuation before it merges,
so a text's ids are the ids of its words in turn. Texts with the opening of a special
token's name go to the tokenizer whole.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .text import ASCII_LOWER, SPACE, pieces, ragged, span_hashes, words

_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[[ord(c) for c in ".,;:!?"]] = True
_LETTER = np.zeros(256, bool)
_LETTER[np.r_[65:91, 97:123]] = True
_MOST_KNOWN, _AT_ONCE = 1 << 19, 1024  # words kept; words encoded at a time, each of which takes about a kilobyte meanwhile
_PIECE_BYTES = 1 << 19  # text looked at in one go: its arrays take some fifty bytes a byte meanwhile


class WordTokenizer:
    """Encodes with a table of the words seen so far; the table starts anew beyond 2^19 words."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks fill the cores; a thread's heap would stay
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self._forget()

    def _forget(self) -> None:
        self.hashes, self.at, self.ids = np.zeros(0, np.uint64), np.zeros(1, np.int64), np.zeros(0, np.uint32)
        self.place = np.zeros(0, np.int64)

    def _learn(self, hashes: np.ndarray, texts: list[str]) -> None:
        if len(self.hashes) + len(hashes) > _MOST_KNOWN:
            self._forget()
        own = [np.array(e.ids, np.uint32) for k in range(0, len(texts), _AT_ONCE) for e in self.whole.encode_batch_fast(texts[k : k + _AT_ONCE], add_special_tokens=False)]
        sizes = np.fromiter(map(len, own), np.int64, len(own))
        self.place = np.concatenate([self.place, len(self.at) - 1 + np.arange(len(own))])
        self.at = np.concatenate([self.at, self.at[-1] + np.cumsum(sizes)])
        self.ids = np.concatenate([self.ids, *own])
        order = np.argsort(together := np.concatenate([self.hashes, hashes]))
        self.hashes, self.place = together[order], self.place[order]

    def _units(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words, cut once more before punctuation that follows an ASCII or Latin-1 letter."""
        start, end, row = words(data, offsets, SPACE)
        before = np.zeros(len(data), bool)
        before[1:] = _LETTER[data[:-1]]
        latin = (data[1:-1] >= 0x80) & (data[1:-1] != 0x97) & (data[1:-1] != 0xB7) & (data[:-2] == 0xC3)
        before[2:] |= latin
        cut = np.flatnonzero(before & _PUNCTUATION[data])
        if len(cut):
            word = np.searchsorted(start, cut, "right") - 1
            inner = (word >= 0) & (cut > start[word]) & (cut < end[word])
            cut, word = cut[inner], word[inner]
            begins = np.concatenate([start, cut])
            order = np.argsort(begins, kind="stable")
            row = np.concatenate([row, row[word]])[order]
            start = begins[order]
            ends = np.concatenate([end, cut])
            ends.sort()
            end = ends
        return start, end, row

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows on end, ids of each row); nulls have none."""
        all_ids, sizes = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for first, last, data, offsets in pieces(column, _PIECE_BYTES):
            odd = np.zeros(last - first, bool)
            for m in re.finditer(rb"<\|", data):
                odd[np.searchsorted(offsets, m.start(), "right") - 1] = True
            if len(data) > 2 * _PIECE_BYTES and not odd.any():  # one long text: between words it can be cut
                parts = [self._encode_rows(own, np.array([0, len(own)]), odd) for own in _cut(data)]
                all_ids += [flat for flat, _ in parts]
                sizes.append(np.array([sum(int(count[0]) for _, count in parts)]))
            else:
                flat, count = self._encode_rows(data, offsets, odd)
                all_ids.append(flat)
                sizes.append(count)
        return np.concatenate(all_ids), np.concatenate(sizes)

    def _encode_rows(self, data: np.ndarray, offsets: np.ndarray, odd: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows = len(odd)
        lower = ASCII_LOWER[data]
        start, end, row = self._units(lower, offsets)
        if odd.any():
            keep = ~odd[row]
            start, end, row = start[keep], end[keep], row[keep]
        hashes = span_hashes(lower, start, end)
        unique, at, back = np.unique(hashes, return_index=True, return_inverse=True)
        for again in (False, True):  # learning may have made the table forget what was known before
            pos = np.searchsorted(self.hashes, unique)
            new = pos == len(self.hashes)
            new[~new] = self.hashes[pos[~new]] != unique[~new]
            if not new.any():
                break
            if again:
                self._forget()
                new[:] = True
            raw = lower.tobytes()
            self._learn(unique[new], [raw[s:e].decode("utf-8", "replace") for s, e in zip(start[at[new]], end[at[new]], strict=True)])
        place = self.place[np.searchsorted(self.hashes, unique)]
        begin, size = self.at[place][back], (self.at[place + 1] - self.at[place])[back]
        flat = self.ids[np.repeat(begin, size) + ragged(size)]
        count = np.bincount(row, weights=size, minlength=rows).astype(np.int64) if len(row) else np.zeros(rows, np.int64)
        if odd.any():
            cut = np.split(flat, np.cumsum(count)[:-1])
            for k in np.flatnonzero(odd):
                text = data[offsets[k] : offsets[k + 1]].tobytes().decode("utf-8", "replace")
                cut[k] = np.array(self.whole.encode(text, add_special_tokens=False).ids, np.uint32)
                count[k] = len(cut[k])
            flat = np.concatenate(cut)
        return flat, count


def _cut(data: np.ndarray) -> Iterator[np.ndarray]:
    """The text in parts of about ``_PIECE_BYTES`` that end before white space; a longer word stays whole."""
    begin = 0
    while begin < len(data):
        end = begin + _PIECE_BYTES
        while end < len(data) and not SPACE[data[end : end + 4096]].any():
            end += 4096
        end += int(SPACE[data[end : end + 4096]].argmax()) if end < len(data) else 0
        yield data[begin:end]
        begin = end


_loaded: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    """The tokenizer of a file, loaded once in a Python worker and kept with its table of words."""
    if path not in _loaded:
        _loaded[path] = WordTokenizer(path)
    return _loaded[path]
