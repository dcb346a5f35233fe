"""The registered queries on the smallest tables: their SQL, or the parts of their contract that plain Python can recompute."""

import glob
import math
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from gatecount.llm.oracles import ORACLE_SQL
from gatecount.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in glob.glob(f"{FOLDER}/*.parquet"):
        con.sql(f"create view {f.rpartition('/')[2][:-8]} as select * from '{f}'")
    return con


def _cell(v):
    return "nan" if isinstance(v, float) and math.isnan(v) else round(v, 6) if isinstance(v, float) else v


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLE_SQL])
def test_matches_oracle(spark, duck, name):
    df, rel = QUERIES[name](spark, FOLDER), duck.sql(ORACLE_SQL[name])
    columns = sorted(df.columns)
    assert columns == sorted(rel.columns)
    got = Counter(tuple(_cell(r[c]) for c in columns) for r in df.collect())
    assert got == Counter(tuple(_cell(v) for v in r) for r in rel.select(*[f'"{c}"' for c in columns]).fetchall())


@pytest.fixture(scope="module")
def texts(duck):
    return {i: t or "" for i, t in duck.sql("select doc_id, text from documents").fetchall()}


def _rows(spark, name):
    return QUERIES[name](spark, FOLDER).collect()


def test_quality_has_a_row_for_each_document(spark, texts):
    rows = _rows(spark, "op1_quality")
    assert Counter(r.doc_id for r in rows) == Counter(list(texts)) and {r.kept for r in rows} <= {True, False}


def test_html_counts_code_points(spark, duck):
    rows = _rows(spark, "op2_html")
    assert Counter(r.page_id for r in rows) == Counter(x for (x,) in duck.sql("select page_id from pages").fetchall())
    assert all(r.n_chars == len(r.text) and "<p" not in r.text for r in rows) and sum(r.n_chars > 100 for r in rows) > len(rows) / 2


def test_language_predicts_what_was_held_out(spark, duck):
    lang = dict(duck.sql("select doc_id, lang from documents").fetchall())
    rows = _rows(spark, "op4_language")
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in rows) and len(rows) == len(lang)
    own = [r for r in rows if r.held_out and r.lang_pred != "und"]
    assert sum(r.lang_pred == lang[r.doc_id] for r in own) >= 0.9 * len(own)


def test_vectors_link_as_by_brute_force(spark, duck):
    ids, x = zip(*duck.sql("select vec_id, embedding from embeddings order by vec_id").fetchall(), strict=True)
    x = np.array(x, np.float64)
    x /= np.linalg.norm(x, axis=1)[:, None]
    link = x @ x.T >= 0.95
    np.fill_diagonal(link, False)
    rows = {r.vec_id: r for r in _rows(spark, "op6_vectors")}
    want = dict(zip(ids, link.sum(1).tolist(), strict=True))
    assert all(rows[i].n_links <= n for i, n in want.items()) and sum(rows[i].n_links for i in ids) >= 0.9 * sum(want.values())
    assert all(r.kept == (r.component_id == r.vec_id) for r in rows.values())


def test_media_payloads_are_the_padded_texts(spark, texts):
    from hashlib import sha256

    for r in _rows(spark, "op7_media"):
        raw = texts[r.doc_id].encode()
        padded = raw + bytes(-len(raw) % 64 if raw else 64)
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(padded), sha256(padded).hexdigest(), zlib.crc32(padded[-64:]))


def test_shards_hold_near_equal_bytes(spark, texts):
    rows = _rows(spark, "op8_sharding")
    held, slots = Counter(), {}
    for r in rows:
        raw = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "bytes", None)
        held[r.shard] += r.size
        slots.setdefault(r.shard, []).append(r.slot)
    assert Counter(r.doc_id for r in rows) == Counter(list(texts)) and set(held) <= set(range(8))
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert max(held.values()) - min(held[k] for k in range(8)) <= 2 * max(r.size for r in rows)


def test_packing_fills_sequences(spark, texts):
    rows = _rows(spark, "op10_packing")
    pieces, used = {}, Counter()
    for r in rows:
        pieces.setdefault(r.doc_id, []).append((r.start, r.length, r.doc_tokens))
        used[r.sequence_id] += r.length
    assert set(pieces) == set(texts)
    for own in pieces.values():
        own.sort()
        assert [s for s, _, _ in own] == [sum(n for _, n, _ in own[:k]) for k in range(len(own))] and {t for _, _, t in own} == {sum(n for _, n, _ in own)}
    assert max(used.values()) <= 2048
    padded = sum(0 if n & (n - 1) == 0 else 2048 - n for n in used.values())
    assert padded <= 0.01 * sum(used.values())


def test_licenses_have_a_row_for_each_document(spark, texts):
    rows = _rows(spark, "op11_licenses")
    assert Counter(r.doc_id for r in rows) == Counter(list(texts))
    assert all((r.n_base > 0) == (r.base_labels != "") and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1 for r in rows)
