"""License scans: Aho-Corasick over words for tags and notices, shunting-yard for license expressions.

An Arrow batch is reduced to its words, lower case, one space between two of them and a line end
between two texts, and one automaton reads that: so a phrase is found where its words stand
consecutively, whatever stands between them, and never over two texts. Where an identifier tag is
found, the expression is read from the text itself, up to the end of its line.

Odd rows: a null or empty text has no words, null first and last words, empty labels and score 0.
A text of any length is scanned whole. Rows that repeat an id, or have none, each give a row.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .scratch import bounded_batches
from .text import ASCII_LOWER, give_back, pieces, words

#: Phrases of the base count and their labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

#: Further notice phrases, as words, and their labels.
NOTICES = {
    "gnu lesser general public license": "lgpl",
    "gnu library general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "gnu free documentation license": "gfdl",
    "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc by nc sa": "cc-by-nc-sa",
    "cc by nc nd": "cc-by-nc-nd",
    "creative commons attribution": "cc-by",
    "creative commons attribution sharealike": "cc-by-sa",
    "creative commons attribution share alike": "cc-by-sa",
    "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons attribution non commercial": "cc-by-nc",
    "creative commons zero": "cc0",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
    "redistribution and use in source and binary forms": "bsd",
    "bsd license": "bsd",
    "isc license": "isc",
    "zlib license": "zlib",
    "boost software license": "bsl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "common development and distribution license": "cddl",
    "european union public licence": "eupl",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "all rights reserved": "reserved",
}

#: Words of the tags after which a license expression stands.
TAGS = ("spdx license identifier", "license expression")

#: Families of license identifiers by how much their terms ask for: 1 notice only, 2 same terms for the
#: licensed files, 3 same terms for the whole work, 4 uses are excluded or terms are unknown.
STRENGTH = {
    "apache": 1, "bsd": 1, "bsl": 1, "cc-by": 1, "cc0": 1, "isc": 1, "mit": 1, "unlicense": 1, "zlib": 1,
    "cc-by-sa": 2, "cddl": 2, "epl": 2, "gfdl": 2, "lgpl": 2, "mpl": 2,
    "agpl": 3, "eupl": 3, "gpl": 3,
    "cc-by-nc": 4, "cc-by-nc-nd": 4, "cc-by-nc-sa": 4, "cc-by-nd": 4, "reserved": 4, "other": 4,
}

#: Binding power of the operators of an expression.
_POWER = {"or": 1, "and": 2, "with": 3}
_TOKEN = re.compile(r"[()]|[a-z0-9][a-z0-9.+:-]*")
_NEVER = 1 << 62

#: ASCII bytes that part words: all but digits and small letters; bytes of longer characters are parts of words.
GAP = np.ones(256, bool)
GAP[48:58] = GAP[97:123] = GAP[128:] = False

SCHEMA = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, binding string, expressions long"


def family(identifier: str) -> str:
    """The family of an identifier: the longest known name that it begins with, up to a mark; else ``other``."""
    name = identifier.rstrip("+")
    while name:
        if name in STRENGTH and name not in ("other", "reserved"):
            return name
        name = name.rpartition("-")[0]
    return "other"


def postfix(text: str) -> list[str]:
    """The expression at the start of ``text`` (lower case) in postfix order, by the shunting-yard algorithm.

    Reading ends at the first token that can't go on the expression, and at a bracket that closes nothing;
    an operator or bracket that is left open is dropped. What follows ``with`` is an exception's name.
    """
    out: list[str] = []
    held: list[str] = []
    operand = True  # an operand is due, or an opening bracket
    for token in (m[0] for m in _TOKEN.finditer(text)):
        if token == "(" and operand:
            held.append(token)
        elif token == ")" and not operand and "(" in held:
            while held[-1] != "(":
                out.append(held.pop())
            held.pop()
        elif token in _POWER and not operand:
            while held and held[-1] != "(" and _POWER[held[-1]] >= _POWER[token]:
                out.append(held.pop())
            held.append(token)
            operand = True
        elif token not in _POWER and token not in "()" and operand:
            out.append(token)
            operand = False
        else:
            break
    if operand:
        while held and held[-1] == "(":
            held.pop()
        if held:
            held.pop()  # its right side never came
    while held:
        token = held.pop()
        if token != "(":
            out.append(token)
    return out


def evaluate(steps: list[str]) -> tuple[int, frozenset[str], frozenset[str]]:
    """(strength, binding families, all families) of a postfix expression.

    ``or`` leaves the choice, so the weaker side binds, the left one if they are equal; ``and`` binds both
    and is as strong as the stronger; ``with`` takes one from a strength over 1. No steps: (0, {}, {}).
    """
    stack: list[tuple[int, frozenset[str], frozenset[str]]] = []
    for step in steps:
        if step not in _POWER:
            own = frozenset([family(step)])
            stack.append((STRENGTH[next(iter(own))], own, own))
            continue
        right, left = stack.pop(), stack.pop()
        if step == "or":
            strength, binding, _ = min(left, right, key=lambda side: side[0])
            stack.append((strength, binding, left[2] | right[2]))
        elif step == "and":
            stack.append((max(left[0], right[0]), left[1] | right[1], left[2] | right[2]))
        else:
            stack.append((max(1, left[0] - 1), left[1], left[2]))
    return stack[0] if stack else (0, frozenset(), frozenset())


def automaton() -> ahocorasick.Automaton:
    """All phrases and tags between spaces; values are (in the base count, label or empty for a tag, words, characters)."""
    found = ahocorasick.Automaton()
    for phrases, base in ((NOTICES, False), (BASE, True)):
        for phrase, label in phrases.items():
            found.add_word(f" {phrase} ", (base, label, len(phrase.split()), len(phrase)))
    for phrase in TAGS:
        found.add_word(f" {phrase} ", (False, "", len(phrase.split()), len(phrase)))
    found.make_automaton()
    return found


def spaced(data: np.ndarray, start: np.ndarray, end: np.ndarray, row: np.ndarray, n_rows: int) -> tuple[str, np.ndarray]:
    """(text, start of each word in it): all words between single spaces, a line end after each row.

    One character stands for each byte, so that offsets are those of bytes.
    """
    length = end - start
    before = np.cumsum(length) - length
    at = before + np.arange(len(start)) + 2 * row + 1
    line = np.full(1 + int(length.sum()) + len(start) + 2 * n_rows, 32, np.uint8)
    line[np.arange(int(length.sum())) + np.repeat(at - before, length)] = data[np.arange(int(length.sum())) + np.repeat(start - before, length)]
    last = np.zeros(n_rows, np.int64)
    np.add.at(last, row, length + 1)
    line[1 + np.cumsum(last) + 2 * np.arange(n_rows)] = 10
    return line.tobytes().decode("latin-1"), at


def scan(column: pa.Array, found: ahocorasick.Automaton) -> Iterator[dict[str, list]]:
    """The columns of ``SCHEMA`` for runs of rows of a text column."""
    for first, stop, raw, offsets in pieces(column):
        n = stop - first
        data = ASCII_LOWER[raw]
        start, end, row = words(data, offsets, GAP)
        text, at = spaced(data, start, end, row, n)
        count = np.bincount(row, minlength=n)
        begin = np.cumsum(count) - count
        whole = None
        n_base, low, high = [0] * n, [_NEVER] * n, [-1] * n
        base, every, binding = ([set() for _ in range(n)] for _ in range(3))
        strength, tags = [0] * n, [0] * n
        for last, (is_base, label, size, length) in found.iter(text):
            k = int(np.searchsorted(at, last - length))
            r = int(row[k])
            if is_base:
                n_base[r] += 1
                low[r], high[r] = min(low[r], k - int(begin[r])), max(high[r], k - int(begin[r]))
                base[r].add(label)
            if label:
                mine = (STRENGTH[label], {label}, {label})
            else:
                whole = data.tobytes() if whole is None else whole
                after, close = int(end[k + size - 1]), int(offsets[r + 1])
                line = min((x for x in (whole.find(b"\n", after, close), whole.find(b"\r", after, close)) if x >= 0), default=close)
                mine = evaluate(postfix(whole[after:line].decode("utf-8", "replace")))
                tags[r] += 1
            strength[r] = max(strength[r], mine[0])
            binding[r] |= mine[1]
            every[r] |= mine[2]
        joined = lambda sets: [",".join(sorted(x)) for x in sets]
        yield {
            "n_words": count.tolist(), "n_base": n_base, "first_word": [None if x == _NEVER else x for x in low], "last_word": [None if x < 0 else x for x in high],
            "base_labels": joined(base), "labels": joined(every), "score": [x / 4 for x in strength], "binding": joined(binding), "expressions": tags,
        }


def scan_licenses(docs: DataFrame) -> DataFrame:
    """doc_id and, of each whole text, its words, base phrases and license labels.

    n_base, first_word, last_word, base_labels: places of the base phrases. labels: families that notices and expressions
    name; binding: those that bind once each expression's choices are made; score: the greatest strength of what binds, in
    quarters, 0 without any; expressions: identifier tags read. One pass over the input, no shuffle.
    """
    bounded_batches(docs.sparkSession)
    types = pa.schema([("doc_id", pa.int64())] + [(n, {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}[t]) for n, t in (x.split() for x in SCHEMA.split(", "))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = automaton()
        for batch in batches:
            done = 0
            for columns in scan(batch.column("text"), found):
                n = len(columns["n_words"])
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(done, n), *[pa.array(columns[f.name], f.type) for f in types if f.name != "doc_id"]], schema=types)
                done += n
        give_back()

    return docs.selectExpr("cast(doc_id as bigint) as doc_id", "text").mapInArrow(run, f"doc_id long, {SCHEMA}")
