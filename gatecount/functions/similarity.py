"""Edit signatures, one-edit distance and name similarity."""

from __future__ import annotations

from difflib import SequenceMatcher

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalars import match_key, tokens


def deletion_signatures(c: Column) -> Column:
    """The text and each text with one character left out; none for the empty text."""
    cut = F.transform(F.sequence(F.lit(1), F.length(c)), lambda i: F.concat(F.substring(c, F.lit(1), i - 1), F.substring(c, i + 1, F.length(c))))
    return F.when(F.length(c) > 0, F.array_distinct(F.concat(F.array(c), cut))).otherwise(F.array().cast("array<string>"))


def swap_variants(c: Column) -> Column:
    """The texts with two different characters exchanged."""
    at = lambda i: F.substring(c, i, F.lit(1))

    def swapped(i: Column, j: Column) -> Column:
        return F.concat(F.substring(c, F.lit(1), i - 1), at(j), F.substring(c, i + 1, j - i - 1), at(i), F.substring(c, j + 1, F.length(c)))

    def with_first(i: Column) -> Column:
        others = F.filter(F.sequence(i + 1, F.length(c)), lambda j: at(i) != at(j))
        return F.transform(others, lambda j: swapped(i, j))

    return F.when(F.length(c) > 1, F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(1), F.length(c) - 1), with_first)))).otherwise(F.array().cast("array<string>"))


def within_one_edit(a: Column, b: Column) -> Column:
    """One insertion, deletion, substitution or exchange of neighbours at most."""
    at = lambda c, i: F.substring(c, i, F.lit(2))
    rest = lambda c, i: F.concat(F.substring(c, F.lit(1), i - 1), F.substring(c, i + 2, F.length(c)))
    crossed = F.exists(F.sequence(F.lit(1), F.greatest(F.length(a) - 1, F.lit(1))), lambda i: (at(a, i) == F.reverse(at(b, i))) & (rest(a, i) == rest(b, i)))
    return (F.levenshtein(a, b) <= 1) | ((F.length(a) == F.length(b)) & (F.length(a) > 1) & crossed)


def _ratio(left: pa.Array, right: pa.Array) -> pa.Array:
    return pa.array([0.0 if a is None or b is None else SequenceMatcher(None, a, b).ratio() for a, b in zip(left.to_pylist(), right.to_pylist(), strict=True)], pa.float64())


def sequence_ratio(a: Column, b: Column) -> Column:
    """Ratcliff and Obershelp's ratio: the one function that Spark has no expression for; 0 where a text is null."""

    def ratio(left: pa.Array, right: pa.Array) -> pa.Array:
        return _ratio(left, right)

    return F.arrow_udf(ratio, "double")(a, b)


def name_similarity(full: Column, first: Column, last: Column, ratio: bool = True) -> Column:
    """Likeness of a buyer's name and a member's two names, 0 to 1.

    Without ``ratio`` only the rules count: both names present; an initial and the last name; one
    edit on the whole; the last name and the share of words in common.
    """
    given, held = tokens(F.coalesce(full, F.lit(""))), tokens(F.concat_ws(" ", first, last))
    f, g = match_key(F.coalesce(first, F.lit(""))), match_key(F.coalesce(last, F.lit("")))
    has_last = F.array_contains(given, g)
    joined = lambda x: F.array_join(F.array_sort(x), "")
    initial = F.exists(given, lambda t: (F.length(t) == 1) & f.startswith(t))
    near = within_one_edit(match_key(F.coalesce(full, F.lit(""))), F.concat(f, g))
    common = F.size(F.array_intersect(given, held)) / F.greatest(F.size(F.array_distinct(held)), F.lit(1))
    score = F.greatest(F.when(has_last & initial, 0.84).otherwise(0.0), F.when(near, 0.95).otherwise(0.0), F.when(has_last, 0.55 + 0.40 * common).otherwise(0.0))
    both = F.array_contains(given, f) & has_last
    if ratio:
        # matching letters can't be more than the shorter text has, so other pairs never reach Python
        a, b = joined(given), joined(held)
        most = 2 * F.least(F.length(a), F.length(b)) / F.greatest(F.length(a) + F.length(b), F.lit(1))
        open_ = ~both & (most > score)
        score = F.greatest(score, sequence_ratio(F.when(open_, a), F.when(open_, b)))
    score = F.when(both, 1.0).otherwise(F.rint(F.least(score, F.lit(1.0)) * 1e4) / 1e4)
    return F.when((F.size(given) == 0) | (F.size(held) == 0), 0.0).otherwise(score)
