"""Operators on documents: brute force, round trips, and the defined results of odd rows."""

import hashlib
import re
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gatecount.llm import audio, jaccard, langid, mixing, ngram, packing, sharding

TOKENS = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, key string, shard int, n long"


def documents(spark, texts, sources=None, langs=None, ids=None):
    """Documents with columns whose names operators use inside."""
    rows = [((ids or list(range(len(texts))))[k], t, (langs or ["en"] * len(texts))[k], (sources or ["s"] * len(texts))[k], 0, -1, "k", -1, -1) for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


ODD = [None, "", "  \n", "one", "one two three four five six seven", "one two three four five six seven", "é ß 漢字 " * 50, "word " * 30_000]


def components(texts, ids, width=5):
    """Brute force over all pairs."""
    sets = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({i: i + 32 for i in range(65, 91)}))
        sets.append({tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set()))
    root = list(range(len(texts)))

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(texts)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                root[max(top(a), top(b))] = min(top(a), top(b))
    least = {}
    for k in range(len(texts)):
        least[top(k)] = min(least.get(top(k), ids[k]), ids[k])
    return [(ids[k], len(sets[k]), least[top(k)]) for k in range(len(texts))]


def near_copies(seed=0, groups=6, each=8, n=60):
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(groups):
        base = [f"w{x}" for x in rng.integers(0, 400, n)]
        for _ in range(each):
            copy = list(base)
            for _ in range(rng.integers(0, 4)):
                copy[rng.integers(0, len(copy))] = f"x{rng.integers(0, 9999)}"
            out.append(" ".join(copy[: len(copy) - rng.integers(0, 12)]).replace("w1", "W1"))
    return out


def test_jaccard_against_brute_force(spark):
    texts = [*near_copies(), *ODD]
    ids = [3 * k + 7 for k in range(len(texts))][::-1]
    got = jaccard.similar_documents(documents(spark, texts, ids=ids)).collect()
    assert sorted(map(tuple, got)) == sorted(components(texts, ids))


def test_jaccard_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "_BROADCAST_IDS", 0)
    monkeypatch.setattr(jaccard, "_BLOCK", 3)
    texts = near_copies(1, groups=3, each=9)
    ids = list(range(len(texts)))
    got = jaccard.similar_documents(documents(spark, texts)).collect()
    assert sorted(map(tuple, got)) == sorted(components(texts, ids))


def test_long_lists_that_end_with_a_batch(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "_BLOCK", 4)
    sets = spark.createDataFrame([(k, [7], k % 4) for k in range(30)] + [(k, [9], 1) for k in range(100, 103)], "key long, prefix array<long>, n long")
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "8")
    try:
        rows = jaccard.shared_lists(sets).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    long = [r for r in rows if r.list == 7]
    assert sorted(r.block for r in long) == list(range(8))
    assert sorted(k for r in long for k in r.keys) == list(range(30))
    assert [list(r.keys) for r in rows if r.list != 7] == [[100, 101, 102]]


def test_jaccard_with_one_hot_shingle_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "_BLOCK", 40)
    rng = np.random.default_rng(5)
    texts = []
    for k in range(150):  # short texts round one passage, of rising sizes, so that its list has many blocks and leaves
        base = ["hot", "words", "in", "every", "text", *[f"w{x}" for x in rng.integers(0, 9999, 1 + k % 30)]]
        texts += [" ".join(base), " ".join([*base[:-1], "other"])]
    ids = list(range(len(texts)))
    got = jaccard.similar_documents(documents(spark, texts)).collect()
    assert sorted(map(tuple, got)) == sorted(components(texts, ids))


def test_tree_pairs_lose_nothing():
    rng = np.random.default_rng(0)
    sets = [set(rng.choice(3000, rng.integers(20, 200), replace=False).tolist()) for _ in range(40)]
    sets += [set(list(s)[: int(len(s) * 0.9)]) for s in sets]
    n = np.array([len(s) for s in sets])
    points = []
    for s, level in zip(sets, jaccard._levels(n) + jaccard._FINER, strict=True):
        h = jaccard.mix(np.array(sorted(s), np.uint64))
        points.append(jaccard.pack_point(np.bincount((h >> np.uint64(64 - level)).astype(int), minlength=1 << level)))
    i, j, _ = jaccard.tree_pairs(n, points)
    found = set(zip(i.tolist(), j.tolist(), strict=True))
    linked = {(a, b) for b in range(len(sets)) for a in range(b) if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])}
    assert linked and linked <= found and len(found) < len(sets) * (len(sets) - 1) // 4


def test_empty_table(spark):
    empty = documents(spark, [])
    assert jaccard.similar_documents(empty).count() == 0
    assert mixing.taken_words(empty).count() == 0
    assert sharding.shard(empty).count() == 0
    assert packing.pack_documents(empty, TOKENS).count() == 0
    assert langid.predict(empty, langid.fit(empty)).count() == 0
    assert audio.describe_audio(audio.store_text_audio(empty)).count() == 0
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert ngram.quality(empty, labels).count() == 0


def test_mixing_meets_targets(spark):
    texts = [f"w{k} " * (k % 40 + 1) for k in range(300)] + [None, ""]
    sources = [("a", "b", "c", None)[k % 4 if k % 3 else 0] for k in range(302)]
    out = mixing.taken_words(documents(spark, texts, sources), block_words=16).collect()
    assert len(out) == 302 and all(0 <= r.taken <= 2 * r.size for r in out)
    total = sum(r.size for r in out)
    by = {}
    for r in out:
        by.setdefault(r.source, []).append(r)
    for rows in by.values():
        assert rows[0].source_size == sum(r.size for r in rows)
        assert abs(sum(r.taken for r in rows) - rows[0].target) <= 1
    assert abs(sum(r[0].target for r in by.values()) - 1.5 * total) < 1e-6
    again = mixing.taken_words(documents(spark, texts, sources).repartition(5), block_words=16).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))


def test_schedule_is_spread(spark):
    targets = spark.createDataFrame([("a", 100, 6000.0), ("b", 100, 2000.0)], "source string, source_size long, target double")
    slots = sorted((r.slot, r.source) for r in mixing.schedule(targets, 10).collect())
    assert [sum(s == "a" for _, s in slots), sum(s == "b" for _, s in slots)] == [600, 200]
    for at in range(0, 720, 80):  # any stretch of the mix holds near three of a to one of b
        assert 55 <= sum(s == "a" for _, s in slots[at : at + 80]) <= 65


def test_shards(spark):
    texts = ["same text again"] * 120 + [f"text {k} " * (k % 9 + 1) for k in range(300)] + [None, ""]
    out = sharding.shard(documents(spark, texts).repartition(3), n_shards=4).select("row.doc_id", "row.text", "row.shard", F.col("shard").alias("own"), "size", "slot").collect()
    assert len(out) == 422 and {r.shard for r in out} == {-1}
    by = {}
    for r in out:
        assert r.size == len((r.text or "").encode()) + 1
        by.setdefault(r.own, []).append(r)
    sizes = [sum(r.size for r in rows) for rows in by.values()]
    assert len(by) == 4 and max(sizes) - min(sizes) < 200
    assert all(sorted(r.slot for r in rows) == list(range(len(rows))) for rows in by.values())


def test_packing_against_tokenizer(spark):
    texts = [*ODD, "<|endoftext|> a <|ENDOFTEXT|>", "don't stop, it's: 12,3 é,!", "Z" * 5000]
    out = packing.pack_documents(documents(spark, texts), TOKENS).collect()
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(TOKENS)
    docs, sequences = {}, {}
    for r in out:
        docs.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
        assert r.length * 4 == len(r.ids) and r.length > 0
    for k, t in enumerate(texts):
        ids = [*whole.encode(t or "", add_special_tokens=False).ids, 1]
        rows = sorted(docs[k], key=lambda r: r.start)
        assert np.frombuffer(b"".join(r.ids for r in rows), "<u4").tolist() == ids
        assert [r.start for r in rows] == np.cumsum([0, *[r.length for r in rows]])[:-1].tolist() and {r.doc_tokens for r in rows} == {len(ids)}
    padding = 0
    for rows in sequences.values():
        rows.sort(key=lambda r: r.offset)
        total = sum(r.length for r in rows)
        assert [r.offset for r in rows] == np.cumsum([0, *[r.length for r in rows]])[:-1].tolist() and total <= 2048
        padding += 0 if total & (total - 1) == 0 else 2048 - total
    assert padding == 0


def test_long_texts_are_cut_between_words(monkeypatch):
    """Ids of texts far longer than a piece, with a word longer than one, are the tokenizer's own."""
    from gatecount.llm import tokens

    monkeypatch.setattr(tokens, "_PIECE_BYTES", 1 << 12)
    rng = np.random.default_rng(3)
    letters = np.array(list("abcdefgXYZ \u00e9\u00df.,;!?'-0123456789 \u3000\u4e2d\t  "))
    texts = ["".join(rng.choice(letters, n)) for n in (0, 5, 9000, 70000)] + ["x" * 20000 + " tail", None, "a <|endoftext|> " * 2000, " " * 20000]
    encoder = tokens.WordTokenizer(TOKENS)
    flat, count = encoder.encode(pa.array(texts))
    own = np.split(flat, np.cumsum(count)[:-1])
    for ids, text in zip(own, texts, strict=True):
        assert ids.tolist() == encoder.whole.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("seed", range(20))
def test_pack_covers_every_token(seed):
    rng = np.random.default_rng(seed)
    lengths = np.maximum(1, rng.lognormal(rng.uniform(1, 8), 1.3, rng.integers(1, 300)).astype(int))
    used = [np.zeros(n, int) for n in lengths]
    for size, window in packing.pack(lengths):
        assert sum(p[2] for p in window) == size and size & (size - 1) == 0
        for doc, start, n in window:
            used[doc][start : start + n] += 1
    assert all((u == 1).all() for u in used)


def test_language_by_words_then_grams(spark):
    words = {"en": "the house stands near water", "de": "das haus steht am wasser", "fr": "la maison est près de eau"}
    rng = np.random.default_rng(0)
    texts, langs = [], []
    for k in range(240):
        lang = ("en", "de", "fr")[k % 3]
        texts.append(" ".join(rng.choice(words[lang].split(), 12)))
        langs.append(lang)
    docs = documents(spark, texts, langs=langs)
    model = langid.fit(docs.filter(~langid.held_out(F.col("doc_id"))))
    out = langid.predict(docs, model).filter(langid.held_out(F.col("doc_id"))).collect()
    assert len(out) > 50 and all(r.lang_pred == r.lang and 0 <= r.score <= 1 for r in out)
    odd = documents(spark, ["", None, "123 !?", "— …", "hausen steht wassern", "THE HOUSE"])
    assert [r.lang_pred for r in langid.predict(odd, model).orderBy("doc_id").collect()] == ["und"] * 4 + ["de", "en"]
    assert {r.lang_pred for r in langid.predict(odd, langid.fit(docs.limit(0))).collect()} == {"und"}


def test_letters_decide_before_the_lexicon(spark):
    texts = [f"the house \u2014 stands {k} \u00bb near\u00a0water \u2026 and 12 \u0665" for k in range(60)] + [f"das haus steht {k} am wasser" for k in range(60)]
    model = langid.fit(documents(spark, texts, langs=["en"] * 60 + ["de"] * 60))
    assert {"near", "water"} <= set(model.words.place) and not any("\u00a0" in w for w in model.words.place)
    odd = ["\u2014 \u2014 \u2014", "\u00bb \u2026 12", "\u0665 \u0665", "\u00a0", "haus\u00a0steht", "\u2014house\u2014near"] + ["the house " * 30_000]
    assert [r.lang_pred for r in langid.predict(documents(spark, odd), model).orderBy("doc_id").collect()] == ["und"] * 4 + ["de", "en", "en"]
    assert {r.score for r in langid.predict(documents(spark, odd[:4]), model).collect()} == {0.0}
    twice = langid.predict(documents(spark, odd[4:5] * 2, ids=[1, 1]), model).collect()
    assert len(twice) == 2 and len({r.score for r in twice}) == 1


def _brute_kneser_ney(train, text, order):
    """Log probability of a text under the same closed vocabulary, written out."""
    from collections import Counter

    def grams(words):
        run = ["<s>"] * (order - 1) + [*words, "</s>"]
        return [tuple(run[k : k + order]) for k in range(len(run) - order + 1)]

    tables = [Counter(g for t in train for g in grams(t))]
    while len(tables) < order:
        tables.append(Counter(g[1:] for g in tables[-1]))
    tables = tables[::-1]  # by order; below the highest, distinct words before
    cuts = [ngram.discounts(np.array([sum(c == k for c in t.values()) for k in (1, 2, 3, 4)])) for t in tables]
    size = 34 + len({w for t in train for w in t if sum(w == x for y in train for x in y) > 1})

    def p(gram):
        table, cut = tables[len(gram) - 1], cuts[len(gram) - 1]
        c = table[gram]
        seen = c - cut[min(c, 3) - 1] if c else 0
        if len(gram) == 1:
            return seen / sum(table.values()) + sum(cut[min(x, 3) - 1] for x in table.values()) / sum(table.values()) / size
        own = [x for g, x in table.items() if g[:-1] == gram[:-1]]
        return seen / sum(own) + sum(cut[min(x, 3) - 1] for x in own) / sum(own) * p(gram[1:]) if own else p(gram[1:])

    return sum(np.log(p(g)) for g in grams(text))


@pytest.mark.parametrize("order", [2, 3, 4])
def test_quality_scores_are_kneser_ney(spark, order):
    rng = np.random.default_rng(0)
    texts = [" ".join(rng.choice(["red", "green", "blue", "pink"], 8)) for _ in range(60)]
    docs = documents(spark, texts)
    labels = spark.createDataFrame([(k, 1, 0) for k in range(60)], "doc_id long, quality int, toxic int")
    out = {r.doc_id: r for r in ngram.quality(docs, labels, order=order, least_documents=1).collect()}
    held = {r.doc_id for r in docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 0).select("doc_id").collect()}
    train = [t.split() for k, t in enumerate(texts) if k not in held]
    for k in list(held)[:5]:
        want = np.exp(-_brute_kneser_ney(train, texts[k].split(), order) / 9)
        assert out[k].perplexity == pytest.approx(want, rel=1e-3)


def test_quality_does_not_depend_on_how_it_is_dealt(spark, monkeypatch):
    rng = np.random.default_rng(3)
    texts = [" ".join(rng.choice([f"w{k}" for k in range(80)], 30)) for _ in range(200)]
    labels = spark.createDataFrame([(k, 1, 0) for k in range(0, 200, 2)], "doc_id long, quality int, toxic int")
    want = {r.doc_id: r.perplexity for r in ngram.quality(documents(spark, texts), labels).collect()}
    for name, value in (("_LEAST_SHARDS", 3), ("_BLOCK_WORDS", 500), ("_BLOCK_ROWS", 7), ("_HELD_WORDS", 300)):
        monkeypatch.setattr(ngram, name, value)
    got = {r.doc_id: r.perplexity for r in ngram.quality(documents(spark, texts).repartition(5), labels, broadcast_labels=0).collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], rel=1e-4) for k in want)


def test_reading_for_the_model_holds_little_of_a_batch():
    """A worker's arrays follow a small piece of text: two workers share an executor with the JVM's heap."""
    known = ngram.Languages(["en"])
    texts = pa.array(["some plain words of a text, again and again " * 20] * 4000)
    next(ngram._read(texts.slice(0, 600), np.zeros(600, np.int64), known))  # tables that stay
    tracemalloc.start()
    found = sum(len(h) for *_, h, _, _, _ in ngram._read(texts, np.zeros(len(texts), np.int64), known))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == 4000 * 20 * 9
    assert peak < 20 << 20, peak


def test_quality_of_odd_rows(spark):
    rng = np.random.default_rng(1)
    clean = [" ".join(rng.choice(["red", "green", "blue", "pink", "grey"], 20)) for _ in range(300)]
    texts = [*clean, None, "", "ZQX## KKK!! " * 10, "red green blue pink"]
    labels = spark.createDataFrame([(k, 1, 0) for k in range(300)] + [(302, 0, 0), (None, 1, 0), (5, None, None)], "doc_id long, quality int, toxic int")
    rows = {r.doc_id: r for r in ngram.quality(documents(spark, texts, langs=["en"] * 303 + [None]), labels).collect()}
    assert [rows[k].kept for k in (300, 301, 302)] == [False, False, False]
    assert rows[303].kept and rows[303].perplexity is None
    assert sum(rows[k].kept for k in range(300)) >= 290


def test_quality_counts_every_repeat_of_a_bigram(spark):
    rng = np.random.default_rng(0)
    texts = [" ".join(rng.choice(["red", "green", "blue", "pink"], 8)) for _ in range(60)] + ["red " * n for n in (60_000, 200_000)]
    labels = spark.createDataFrame([(k, 1, 0) for k in range(60)], "doc_id long, quality int, toxic int")
    out = {r.doc_id: r for r in ngram.quality(documents(spark, texts), labels, least_documents=1).collect()}
    assert out[61].perplexity == pytest.approx(out[60].perplexity, rel=1e-3)


def test_quality_counts_words_seen_once_and_spells_unseen_ones(spark):
    rng = np.random.default_rng(2)
    letters = lambda n: "".join(rng.choice(list("aeiounrst"), n))
    texts = [" ".join([*rng.choice(["red", "green", "blue", "pink"], 12), letters(6)]) for _ in range(200)]
    known = next(k for k in range(200) if k not in {r.doc_id for r in documents(spark, texts).filter(F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 0).collect()})
    once = texts[known].split()[-1]
    texts += [f"red {w} green" for w in (once, "ratoine", "qzxkvwj")] + ["qzxkvwj " * 13]
    labels = spark.createDataFrame([(k, 1, 0) for k in range(200)], "doc_id long, quality int, toxic int")
    out = {r.doc_id: r for r in ngram.quality(documents(spark, texts), labels, least_documents=1).collect()}
    assert 2 * out[200].perplexity < out[201].perplexity
    assert 2 * out[201].perplexity < out[202].perplexity
    assert not out[203].kept


def test_audio_round_trip(spark):
    out = audio.describe_audio(audio.store_text_audio(documents(spark, ODD))).orderBy("doc_id").collect()
    for r, t in zip(out, ODD, strict=True):
        raw = (t or "").encode()
        payload = raw.ljust(max(1, -(-len(raw) // 64)) * 64, b"\0")
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        file = audio.wav(payload, (audio.MULAW, audio.ALAW)[zlib.crc32(payload) & 1])
        assert (r.media_bytes, r.media_sha256) == (len(file), hashlib.sha256(file).hexdigest())
    assert out[4].feature == out[5].feature and out[0].feature == out[1].feature


def test_stored_pcm_is_the_whole_recording(spark):
    text = "whole recording, every sample. " * 9
    stored = audio.store_text_audio(documents(spark, [text]))
    payload = text.encode().ljust(320, b"\0")
    pcm = np.frombuffer(bytes(stored.first()["pcm"]), "<i2")
    assert np.array_equal(pcm, audio.TABLES[(audio.MULAW, audio.ALAW)[zlib.crc32(payload) & 1]][np.frombuffer(payload, np.uint8)])
    assert audio.describe_audio(stored).first()["feature"] == audio.features(pcm, 8000)
    assert audio.resample(np.array([8, 8, 8, 8, 3, 4], np.int16), 8000, 2000, rest=True).tolist() == [8, 3]


def test_media_features_are_of_resampled_sound(spark):
    texts = ["whole recording, every sample. " * 9, "", "é" * 33]
    stored = audio.store_text_audio(documents(spark, texts), pcm_rate=None)
    assert stored.columns == ["doc_id", "n_bytes", "media"]
    for r, t in zip(audio.describe_audio(stored, pcm_rate=16000).orderBy("doc_id").collect(), texts, strict=True):
        payload = t.encode().ljust(max(1, -(-len(t.encode()) // 64)) * 64, b"\0")
        own = audio.TABLES[(audio.MULAW, audio.ALAW)[zlib.crc32(payload) & 1]][np.frombuffer(payload, np.uint8)].tolist()
        between = [(a + b) // 2 for a, b in zip(own, [*own[1:], own[-1]], strict=True)]
        both = np.array([x for pair in zip(own, between, strict=True) for x in pair], np.int64)
        signs = both < 0
        assert r.feature == f"rate=16000;samples={2 * len(payload)};power={int((both**2).sum()) // len(both)};peak={abs(both).max()};crossings={(signs[1:] != signs[:-1]).sum()};pcm_crc32={zlib.crc32(both.astype('<i2').tobytes())}"


def test_the_query_stores_all_formats_and_their_sound(spark, tmp_path):
    """A third of the payloads are ADPCM; the PCM of all is stored whole, and features are of it at 16 kHz."""
    from gatecount.llm.queries import op7_media

    texts = [f"line {k} of a call, " * (4 * k + 1) for k in range(40)] + ["", None, "é" * 33, "x" * 1020, "y" * 2040]
    documents(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    rows = op7_media(spark, str(tmp_path)).orderBy("doc_id").collect()
    stored = audio.store_text_audio(documents(spark, texts), kinds=(audio.MULAW, audio.ALAW, audio.IMA_ADPCM)).orderBy("doc_id").collect()
    kinds = []
    for r, x, t in zip(rows, stored, texts, strict=True):
        raw = (t or "").encode()
        payload, file = raw.ljust(max(1, -(-len(raw) // 64)) * 64, b"\0"), bytes(x.media)
        kinds.append(audio.read_wav(file)[0])
        assert (r.payload_bytes, r.payload_sha256, r.media_bytes, r.media_sha256) == (len(payload), hashlib.sha256(payload).hexdigest(), len(file), hashlib.sha256(file).hexdigest())
        if kinds[-1] == audio.IMA_ADPCM:
            own = [s for k in range(0, len(payload), 1020) for s in _adpcm_block(bytes(4) + payload[k : k + 1020], 2 * len(payload[k : k + 1020]) + 1)]
        else:
            own = audio.TABLES[kinds[-1]][np.frombuffer(payload, np.uint8)].tolist()
        assert np.frombuffer(bytes(x.pcm), "<i2").tolist() == own
        assert r.feature == audio.features(audio.resample(np.array(own, np.int16), 8000, 16000, rest=True), 16000)
    assert set(kinds) == {audio.MULAW, audio.ALAW, audio.IMA_ADPCM}


def test_companding_tables():
    mu, a = audio.TABLES[audio.MULAW], audio.TABLES[audio.ALAW]
    assert (mu[0xFF], mu[0x7F], mu[0x80], mu[0x00]) == (0, 0, 32124, -32124)
    assert (a[0xD5], a[0x55], a[0xAA], a[0x2A]) == (8, -8, 32256, -32256)
    assert len(set(mu.tolist())) == 255 and len(set(a.tolist())) == 256


def _adpcm_block(block, n):
    """One block, one sample at a time."""
    head, index, out = int.from_bytes(block[:2], "little", signed=True), min(block[2], 88), []
    out.append(head)
    codes = [c for b in block[4:] for c in (b & 15, b >> 4)]
    for code in codes[: n - 1]:
        step = int(audio.STEP_SIZES[index])
        move = step >> 3
        for bit, part in ((4, step), (2, step >> 1), (1, step >> 2)):
            move += part if code & bit else 0
        head = max(-32768, min(32767, head + (-move if code & 8 else move)))
        index = max(0, min(88, index + int(audio.INDEX_STEPS[code & 7])))
        out.append(head)
    return out


def test_adpcm_blocks_side_by_side():
    rng = np.random.default_rng(0)
    blocks = [bytes([*rng.integers(0, 256, 2).tolist(), int(rng.integers(0, 89)), 0, *rng.integers(0, 256, 60).tolist()]) for _ in range(7)]
    file = audio.wav(b"".join(blocks), audio.IMA_ADPCM, 8000, 64, 121)
    pcm, rate = audio.pcm_of(file)
    assert rate == 8000 and pcm.tolist() == [x for b in blocks for x in _adpcm_block(b, 121)]
    assert len(audio.resample(pcm, 8000, 2000)) == len(pcm) // 4
    assert audio.resample(np.array([0, 100], np.int16), 1000, 2000).tolist() == [0, 50, 100, 100]
    with pytest.raises(ValueError):
        audio.read_wav(b"RIFFxxxxWAVEdata")


def test_letters_among_punctuation():
    import sys
    import unicodedata

    for k in [*range(0x80, 0xC0), *range(0x2000, 0x2080), *range(0x3000, 0x3040)]:
        data = np.frombuffer(chr(k).encode(), np.uint8)
        letter = unicodedata.category(chr(k))[0] == "L" or k == 0x3007
        assert langid._gaps(data).any() != letter, hex(k)
    assert sys.maxunicode > 0x3040
