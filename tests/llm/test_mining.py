"""License scans, hard negatives and phrases against brute force, with odd rows."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from gatecount.llm import dualtree, licenses, phrases

LOWER = {i: i + 32 for i in range(65, 91)}


def documents(spark, texts, langs=None, ids=None):
    """Documents with columns whose names operators use inside."""
    langs, ids = langs or ["en"] * len(texts), ids or list(range(len(texts)))
    rows = [(i, t, x, "k", -1, -1, "w") for i, t, x in zip(ids, texts, langs, strict=True)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, labels string, n long, shard long, words string")


# --- licenses ----------------------------------------------------------------------------------------


def by_descent(text):
    """(strength, binding, all) of a whole well-formed expression, by recursive descent."""
    tokens = re.findall(r"[()]|[a-z0-9][a-z0-9.+:-]*", text.translate(LOWER))
    at = 0

    def peek():
        return tokens[at] if at < len(tokens) else None

    def atom():
        nonlocal at
        at += 1
        if tokens[at - 1] == "(":
            out = alternatives()
            assert peek() == ")"
            at += 1
            return out
        own = licenses.family(tokens[at - 1])
        return licenses.STRENGTH[own], {own}, {own}

    def excepted():
        nonlocal at
        out = atom()
        while peek() == "with":
            at += 2
            out = (max(1, out[0] - 1), out[1], out[2])
        return out

    def both():
        nonlocal at
        out = excepted()
        while peek() == "and":
            at += 1
            more = excepted()
            out = (max(out[0], more[0]), out[1] | more[1], out[2] | more[2])
        return out

    def alternatives():
        nonlocal at
        out = both()
        while peek() == "or":
            at += 1
            more = both()
            weaker = more if more[0] < out[0] else out
            out = (weaker[0], weaker[1], out[2] | more[2])
        return out

    out = alternatives()
    assert at == len(tokens)
    return out


def expression(rng, depth=0):
    kind = rng.random()
    if depth > 3 or kind < 0.4:
        name = rng.choice(["MIT", "Apache-2.0", "GPL-2.0-or-later", "LGPL-2.1+", "BSD-3-Clause", "CC-BY-NC-4.0", "CC0-1.0", "LicenseRef-Own", "AGPL-3.0-only"])
        return name if rng.random() < 0.8 else f"{name} WITH Some-exception-2.0"
    if kind < 0.55:
        return f"({expression(rng, depth + 1)})"
    return f"{expression(rng, depth + 1)} {rng.choice(['AND', 'OR', 'and', 'or'])} {expression(rng, depth + 1)}"


def scanned(text):
    """A row of the scan, by plain search over a list of words."""
    low = (text or "").translate(LOWER)
    found = list(re.finditer(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low))
    words = [m[0] for m in found]

    def places(phrase):
        own = phrase.split()
        return [k for k in range(len(words)) if words[k : k + len(own)] == own]

    base = {p: places(p) for p in licenses.BASE}
    starts = [k for x in base.values() for k in x]
    labels = {licenses.BASE[p] for p, x in base.items() if x} | {v for p, v in licenses.NOTICES.items() if places(p)}
    binding, strength, tags = set(labels), max([licenses.STRENGTH[x] for x in labels], default=0), 0
    for tag in licenses.TAGS:
        for k in places(tag):
            tags += 1
            rest = low[found[k + len(tag.split()) - 1].end() :]
            s, b, a = by_descent(re.split(r"[\r\n]", rest)[0])
            strength, binding, labels = max(strength, s), binding | b, labels | a
    base_labels = {licenses.BASE[p] for p, x in base.items() if x}
    joined = lambda x: ",".join(sorted(x))
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), joined(base_labels), joined(labels), strength / 4, joined(binding), tags


def test_licenses_against_brute_force(spark):
    rng = random.Random(5)
    fill = "the work under gnu general public license Apache-License cc BY-NC mit MIT license all rights reserved redistribution and use in source binary forms é ñ漢 x9".split()
    texts = [" ".join(rng.choice(fill) + rng.choice(["", ",", "\n", " - ", "\t"]) for _ in range(rng.randrange(0, 80))) for _ in range(120)]
    texts += [f"words\n# SPDX-License-Identifier: {expression(rng)}\nmore MIT\nLicense" for _ in range(60)] + [f'License-Expression = "{expression(rng)}"\r\nspdx license identifier: {expression(rng)}' for _ in range(20)]
    texts += [None, "", " \n", "mit license", "mit license", "MIT" + "\n" * 9 + "LICENSE!", "emit license", "mit licenses", "émit license", "gnu " * 40_000 + "general public license", "cc by nc sa cc by", "Apache license Apache License"]
    ids = [*range(len(texts) - 2), None, 3]
    got = licenses.scan_licenses(documents(spark, texts, ids=ids)).drop("doc_id").collect()
    assert Counter(map(tuple, got)) == Counter(map(scanned, texts))


def test_expressions_by_hand():
    known = lambda text: licenses.evaluate(licenses.postfix(text))
    assert known("mit or gpl-3.0-only") == (1, {"mit"}, {"mit", "gpl"})
    assert known("mit and gpl-3.0-only or cc-by-nc-4.0") == (3, {"mit", "gpl"}, {"mit", "gpl", "cc-by-nc"})
    assert known("mit and (gpl-3.0-only or apache-2.0)")[0] == 1
    assert known("gpl-2.0-only with classpath-exception-2.0")[0] == 2
    for broken in ("", "and mit", ")", "("):
        assert known(broken) == (0, set(), set())
    assert known("(mit or apache-2.0")[1] == {"mit"} and known("mit and")[1] == {"mit"} and known("mit mit gpl")[2] == {"mit"} and known("mit ) gpl")[2] == {"mit"}


def test_licenses_of_an_empty_table(spark):
    assert licenses.scan_licenses(documents(spark, [])).count() == 0


# --- hard negatives ----------------------------------------------------------------------------------


def negatives(rows):
    """Brute force; rows are (id, vector, label)."""
    usable = []
    for i, v, label in rows:
        if label is None or v is None or not len(v) or any(x is None or not np.isfinite(x) for x in v):
            continue
        usable.append((i, [int(np.floor(256.0 * float(x))) for x in v], label))
    out = []
    first = lambda r: (-r[0], 1 << 62 if r[1] is None else r[1])
    for k, (i, v, label) in enumerate(usable):
        if i is None or i % 100:
            continue
        scores = [(sum(a * b for a, b in zip(v, u, strict=True)), j, m == label) for c, (j, u, m) in enumerate(usable) if c != k and len(u) == len(v)]
        for ps, p, _ in sorted((s for s in scores if s[2]), key=first)[:5]:
            fits = sorted((s for s in scores if not s[2] and 80 * ps <= 100 * s[0] <= 100 * ps), key=first)[:5]
            out += [(i, p, rank, n, ps, s) for rank, (s, n, _) in enumerate(fits, 1)]
    return out


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, label, -1, b"x", 7) for i, v, label in rows], "vec_id long, embedding array<double>, label int, score long, q binary, n int")


def mined(spark, rows, **sizes):
    return Counter(map(tuple, dualtree.mine(vectors(spark, rows), **sizes).collect()))


@pytest.mark.parametrize("seed", [0, 1])
def test_negatives_against_brute_force(spark, monkeypatch, seed):
    monkeypatch.setattr(dualtree, "LEAF", 8)
    monkeypatch.setattr(dualtree, "ANCHOR_LEAF", 2)
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, 5))
    rows = [(int(k), (centres[rng.integers(6)] + rng.normal(scale=0.2, size=5)).round(2).tolist(), int(rng.integers(4))) for k in rng.permutation(900) * 5]
    hot = [(20_000 + 20 * k, [0.5, 0.5, 0.5, 0.5, 0.5], k % 3) for k in range(450)]  # a third of all rows, tied
    odd = [(100, None, 1), (200, [], 1), (300, [1.0, None, 0.0, 0.0, 0.0], 1), (400, [float("nan")] * 5, 1), (None, [0.5] * 5, 0), (None, [0.5] * 5, 1), (500, [0.5] * 5, None), (600, [1.0, 2.0], 1), (601, [1.0, 2.5], 1), (602, [1.0, 2.2], 2)]
    again = [rows[3], rows[3], (700, [0.1] * 5, 2), (700, [0.1] * 5, 2), (800, [-0.3] * 5, 2), (900, [0.0] * 5, 3), (901, [0.0] * 5, 3)]
    every = rows + hot + odd + again
    want = Counter(negatives(every))
    assert len(want) > 1000
    assert mined(spark, every, block_rows=32, group_rows=4) == want


def test_negatives_past_double_precision(spark):
    rng = np.random.default_rng(3)
    rows = [(k, (rng.uniform(0.9, 1.1, size=3) * 2.0**20).tolist(), int(k % 3)) for k in range(0, 400, 4)]
    assert mined(spark, rows, block_rows=16, group_rows=2) == Counter(negatives(rows))


def test_negatives_of_few_rows(spark):
    assert not mined(spark, [])
    assert not mined(spark, [(100, [1.0], 1)])
    assert not mined(spark, [(1, [1.0], 1), (2, [1.0], 2)])
    assert mined(spark, [(0, [1.0], 1), (1, [1.0], 1), (2, [0.9], 2)]) == Counter([(0, 1, 1, 2, 65536, 58880)])


def test_shifted_labels(spark):
    df = spark.createDataFrame([(7, 9), (8, 9), (14, None), (None, 3), (0, -4)], "vec_id long, label int")
    assert [r[0] for r in df.select(dualtree.shifted_label(F.col("vec_id"), F.col("label"))).collect()] == [0, 9, None, 3, -3]


def test_intervals_hold_all_products():
    rng = np.random.default_rng(2)
    a, b = rng.integers(-90, 90, (20, 6)), rng.integers(-90, 90, (30, 6))
    low, high = dualtree.interval(a.min(0), a.max(0), b.min(0), b.max(0))
    products = a @ b.T
    assert low <= products.min() and products.max() <= high
    radius = lambda x: np.sqrt(np.square(x - x.mean(0)).sum(1).max())
    assert products.max() <= dualtree.ball_bound(a.mean(0), radius(a), b.mean(0)[None], np.array([radius(b)]))[0]


# --- phrases -----------------------------------------------------------------------------------------


def collocated(texts, langs, least, longest=5, most=2000):
    """Brute force with exact integers."""
    f, n = defaultdict(Counter), Counter()
    for text, lang in zip(texts, langs, strict=True):
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        held = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        inside = {(q, held[p]) for p in held for k in range(2, len(p)) for i in range(len(p) - k + 1) for q in [p[i : i + k]]}
        rows = []
        for p, a in held.items():
            if (p, a) in inside:
                continue
            score, _, left, right = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            rows.append((score, a, " ".join(p), left, right))
        rows.sort(key=lambda r: (-r[0], -r[1], r[2].encode()))
        out += [(lang, k, phrase, a, left, right, n[lang], score) for k, (score, a, phrase, left, right) in enumerate(rows[:most], 1)]
    return Counter(out)


def prose(seed, n=400):
    rng = random.Random(seed)
    fixed = ["New York City", "as well as", "la la la la la la", "x y", "by the way of the", "ÉTÉ été"]
    fill = [f"w{k}" for k in range(25)] + ["a b", "naïve", "漢字"]
    part = lambda: rng.choice(fixed) if rng.random() < 0.3 else rng.choice(fill)
    texts = ["".join(part() + rng.choice([" ", " ", " ", "\t", "  ", ", ", ".\n", "\x0b", "\x1c "]) for _ in range(rng.randrange(60))) for _ in range(n)]
    return texts, [rng.choice(["en", "fr", None, ""]) for _ in texts]


@pytest.mark.parametrize(("least", "positions", "most"), [(8, 200, 2000), (3, 1 << 21, 2000), (8, 1000, 7)])
def test_phrases_against_brute_force(spark, least, positions, most):
    texts, langs = prose(least)
    texts += [None, "", " ,;", "new york " * 9_000, *["same text again"] * 9]
    langs += ["en"] * 13
    df = documents(spark, texts, langs).repartition(5)
    got = phrases.collocations(df, least=least, most=most, shard_positions=positions).collect()
    want = collocated(texts, langs, least, most=most)
    assert Counter(map(tuple, got)) == want and len(want) > 20


def test_lists_of_words_are_a_row_a_shard(spark):
    """Lists meet their shards once a length, so a row a word would be moved as often."""
    df = documents(spark, [f"w{k} w{k} w{k + 1}" for k in range(40)])
    _, tables, scratch = phrases.frequent_phrases(df, least=1, longest=2, shard_positions=60)
    lists = scratch[1].filter("shard is not null").groupBy("shard").count()
    assert lists.filter("count > 1").count() == 0 and lists.count() > 1
    assert {(r.words[0], r.a) for r in tables[0].collect()} == {("w0", 2), ("w40", 1)} | {(f"w{k}", 3) for k in range(1, 40)}


def test_planes_give_their_numbers_back():
    for ids in (np.zeros(0, np.int32), np.array([0, 1, 255, 256, 1 << 16, (1 << 31) - 1], np.int32)):
        assert phrases._from_planes(phrases.pa.py_buffer(phrases._planes(ids))).tolist() == ids.tolist()


def test_phrases_of_empty_and_rare(spark):
    assert phrases.collocations(documents(spark, [])).count() == 0
    assert phrases.collocations(documents(spark, ["one two three", None])).count() == 0


def test_scores_past_64_bits(spark):
    """The score of a frequent pair in a very long text: 1000 a n passes 2**63 only far beyond test data, so the decimals are held against integers."""
    a, n, left, right = 10**12, 10**14, 10**13, 3
    got = spark.range(1).select(F.expr(f"(cast({a} as decimal(19,0)) * cast({n} as decimal(19,0)) * 1000BD) div (cast({left} as decimal(19,0)) * cast({right} as decimal(19,0)))")).first()[0]
    assert got == 1000 * a * n // (left * right)


def test_bitmaps_shift_over_chunks():
    items = np.full(48, -1, np.int64)
    items[[0, 15, 16, 31, 47]] = [1, 2, 1, 1, 3]
    maps = phrases.Bitmaps.at(items).shifted()
    bits = sorted((int(c), k * 16 + b) for k in range(3) for c, m in zip(maps.codes[k], maps.masks[k], strict=True) for b in range(16) if m >> b & 1)
    assert bits == [(1, 1), (1, 17), (1, 32), (2, 16)]


def test_long_rows_are_written_by_their_bytes(spark):
    """A hundred shards of megabytes would lie in a task's memory before Parquet looked at their size."""
    import glob

    from pyarrow.parquet import ParquetFile

    from gatecount.llm.scratch import saved

    table = saved(spark.range(6, numPartitions=1).select(F.randstr(F.lit(6 << 20), F.lit(1)).alias("x")), "long", long_rows=True)
    groups = [ParquetFile(f.removeprefix("file://")).metadata.num_row_groups for f in table.inputFiles()]
    assert sum(groups) > 1 and table.filter(F.length("x") == 6 << 20).count() == 6
