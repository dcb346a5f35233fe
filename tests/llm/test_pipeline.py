"""Each stage of the corpus pipeline against brute force, on small tables with odd rows."""

import re

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gatecount.llm import ngram

from .test_documents import components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = {"en": "the house stands near water and trees", "de": "das haus steht nah am wasser und", "fr": "la maison est près de eau et"}


@pytest.fixture(scope="module")
def corpus():
    rng = np.random.default_rng(7)
    rows = []
    for k in range(360):
        lang = ("en", "de", "fr")[k % 3]
        text = " ".join(rng.choice(WORDS[lang].split(), 14 + k % 20)) + f" {lang}{k}"
        rows.append((k, text, lang, ("a", "b", "c", None)[k % 4 if k % 5 else 0], len(text)))
    rows += [(400, rows[3][1], "en", "b", 1), (401, rows[3][1] + " again", "en", "b", 1), (402, None, "en", "a", 0), (403, "", None, "a", 0), (404, "123 !?", "en", "c", 6)]
    rows += [(405, rows[6][1] + " one", "en", "a", 1), (405, rows[7][1] + " two", "de", "a", 1), (405, rows[7][1] + " two", "de", "a", 1), (None, rows[9][1], "en", "c", 1), (None, None, None, None, None)]
    return rows


@pytest.fixture(scope="module")
def docs(spark, corpus):
    return spark.createDataFrame(corpus, SCHEMA)


def test_language_drops_texts_without_letters_alone(spark, docs, corpus):
    out = corpus_pipeline.language(spark, docs, "").collect()
    assert sorted(r.text for r in out) == sorted(r[1] for r in corpus if r[1] and re.search("[a-z]", r[1]))
    assert all(r.lang == dict((t, lang) for _, t, lang, *_ in corpus)[r.text] for r in out if r.text[:3] != "123")


def test_quality_drops_what_the_model_rejects(spark, docs, corpus, tmp_path):
    labels = spark.createDataFrame([(k, 1, 0) for k in range(0, 300)], "doc_id long, quality long, toxic long")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    bad = [(500, "zqx kkw " * 30, "en", "a", 1)]
    whole = spark.createDataFrame([*corpus, *bad], SCHEMA)
    rejected = {r.doc_id for r in ngram.quality(whole, labels).filter("not kept").collect()}
    out = corpus_pipeline.quality(spark, whole, str(tmp_path)).collect()
    assert 500 in rejected and {402, 403} <= rejected and len(rejected) < 20
    got = sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in out)
    own = [r for r in whole.collect() if r.doc_id not in (None, 405)]
    assert [x for x in got if x[1] not in (0, 405)] == sorted((False, r.doc_id, r.text or "") for r in own if r.doc_id not in rejected and r.doc_id)
    assert sum(r.doc_id == 405 for r in out) == 3 and [r.text for r in out if r.doc_id is None] == [corpus[9][1]], "an empty text goes, whatever its id"


def test_rows_that_share_an_id_are_decided_on_by_themselves(spark, corpus, tmp_path):
    labels = spark.createDataFrame([(k, 1, 0) for k in range(0, 300)], "doc_id long, quality long, toxic long")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    shared = [(None, "zqx kkw " * 30, "en", "a", 1), (700, "zqx kkw " * 30, "en", "a", 1), (700, corpus[12][1], "en", "a", 1)]
    out = corpus_pipeline.quality(spark, spark.createDataFrame([*corpus, *shared], SCHEMA), str(tmp_path)).collect()
    assert not any(r.text and "zqx" in r.text for r in out)
    assert [r.text for r in out if r.doc_id == 700] == [corpus[12][1]]


def test_one_of_each_group_of_near_copies_stays(spark, docs, corpus):
    keys = [r[0] if r[0] not in (None, 405) else 10_000 + k for k, r in enumerate(corpus)]
    kept = {k for k, _, root in components([r[1] for r in corpus], keys) if k == root}
    out = corpus_pipeline.near_duplicates(spark, docs, "").collect()
    assert {400, 401} & kept == set()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in out) == sorted((r[0] is None, r[0] or 0, r[1] or "") for k, r in zip(keys, corpus, strict=True) if k in kept)
    assert not any(r.doc_id == 405 for r in out), "each is a near copy of a document whose id is its own"
    pair = [(9, "one two three four five six", "en", "a", 1), (9, "one two three four five six", "en", "a", 1), (9, "quite another text of six words", "en", "a", 1), (None, "one two three four five six", "en", "a", 1)]
    left = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(pair, SCHEMA), "").collect()
    assert sorted(r.text for r in left) == ["one two three four five six", "quite another text of six words"]


def test_mix_takes_documents_up_to_two_times(spark, docs, corpus):
    rows = [r for r in corpus if r[0] != 405 and r[0] is not None]
    table = spark.createDataFrame(rows, SCHEMA)
    out = corpus_pipeline.mix(spark, table, "").collect()
    from collections import Counter

    times, words = Counter(r.doc_id for r in out), lambda t: len((t or "").split())
    assert max(times.values()) == 2 and times[402] == times[403] == 1
    total, got, size = sum(words(r[1]) for r in rows), Counter(), Counter()
    for r in rows:
        size[r[3]] += words(r[1])
        got[r[3]] += words(r[1]) * times[r[0]]
    # brute-force water filling of 5, 2, 1, 5 parts under two times each source
    weights, target, left, open_ = dict(zip(["a", "b", "c", None], (5, 2, 1, 5), strict=True)), {}, 1.5 * total, set(size)
    while open_:
        level = left / sum(weights[s] for s in open_)
        full = {s for s in open_ if 2 * size[s] <= level * weights[s]}
        for s in full or open_:
            target[s] = 2 * size[s] if full else level * weights[s]
        left -= sum(target[s] for s in full)
        open_ = open_ - full if full else set()
    assert all(abs(got[s] - target[s]) <= 40 for s in size)
    again = corpus_pipeline.mix(spark, table.repartition(3), "").collect()
    assert sorted(map(str, out)) == sorted(map(str, again))


def test_packing_holds_every_token_once(spark, docs):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    table = docs.filter("doc_id < 405")
    rows = corpus_pipeline.pack(spark, table, "").collect()
    for d in table.collect():
        own = sorted((r for r in rows if r.doc_id == d.doc_id), key=lambda r: r.start)
        ids = np.concatenate([np.frombuffer(r.ids, "<u4") for r in own]).tolist()
        assert ids == [*whole.encode(d.text or "", add_special_tokens=False).ids, 1]


def test_run_is_the_stages_in_turn(spark, docs, tmp_path):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(k, 1, 0) for k in range(0, 300)], "doc_id long, quality long, toxic long").write.parquet(f"{tmp_path}/labels.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "quality", "near_duplicates", "mixing", "packing"]
    assert out.filter(F.col("length") <= 0).count() == 0 and out.select("doc_id").distinct().count() > 50
