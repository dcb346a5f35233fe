"""Pages and vectors: extraction, archives, multi-index."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from gatecount.llm import html, multiindex, warc

PAGE = (
    '<!DOCTYPE html><html><head><title>T {k}</title><style>p{{}}</style></head><body><header class="site"><a href="/">Home</a></header><nav><ul><li>A<li>B</ul></nav>'
    '<div class="cookie-banner">We use cookies</div><aside>Popular {k}</aside><div id="main{k}"><article><header><h1>Title {k}</h1></header><p>First &amp; only\n\t paragraph {k}.<p>Second <b>bold</b> part<br>goes on {k}</p>'
    '<div class="ad-slot">Buy {k}</div><form><input value="x">Mail</form></article></div><section class="comments"><p>Nice {k}!</p></section><script>var t = "</p>";</script><footer>&copy; site</footer></body></html>'
)


def page_table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, text string, host int")


def test_articles_without_the_rest(spark):
    rows = [(k, f"http://h.example/{k}", PAGE.format(k=k)) for k in range(12)] + [(50, None, None), (51, "http://h.example/e", ""), (52, "nohost", "just words &eacute;"), (53, "http://one.example", PAGE.format(k=99))]
    out = {r.page_id: r for r in html.extract(page_table(spark, rows)).collect()}
    for k in (*range(12), 53):
        n = 99 if k == 53 else k
        assert out[k].text == f"Title {n}\n\nFirst & only paragraph {n}.\n\nSecond bold part goes on {n}"
        assert out[k].n_chars == len(out[k].text)
    assert out[3].templated and not out[53].templated
    assert (out[50].text, out[51].text, out[52].text) == ("", "", "just words é")


def test_headline_and_lead_beside_the_body_stay(spark):
    body = "".join(f"<p>Body {{k}} paragraph {x} is long enough to hold most of the text.</p>" for x in range(9))
    for top, bottom in (("<article>", "</article>"), ('<div class="story">', "</div>")):
        page = f'<html><body><nav>Home</nav><div class="sidebar">Popular {{k}}</div>{top}<h1>Title {{k}}</h1><p>Lead {{k}}.</p><div class="body">{body}</div><div class="more"><p>Sequel {{k}}.</p></div>{bottom}<footer>&copy; site</footer></body></html>'
        rows = [(k, f"http://h.example/{k}", page.format(k=k)) for k in range(8)] + [(50, "http://one.example", page.format(k=50))]
        for r in html.extract(page_table(spark, rows)).collect():
            blocks = r.text.split("\n\n")
            assert blocks[:2] == [f"Title {r.page_id}", f"Lead {r.page_id}."] and blocks[-1] == f"Sequel {r.page_id}." and len(blocks) == 12


def test_joined_templates_give_the_same(spark):
    rows = [(k, f"http://h.example/{k}", PAGE.format(k=k)) for k in range(6)]
    by = lambda n: sorted((r.page_id, r.text) for r in html.extract(page_table(spark, rows), broadcast_tokens=n).collect())
    assert by(0) == by(10**6)


def test_no_pages(spark):
    assert html.extract(page_table(spark, [])).count() == 0
    out, manifest = warc.write_archive(page_table(spark, []))
    assert manifest.count() == 0


def test_archive_round_trip(spark):
    big = "<p>" + "same words here " * 100
    rows = [(k, f"http://h/{k}", big if k % 3 == 0 else f"<p>{k}" * (k * 30 + 1)) for k in range(40)] + [(100, None, None), (101, "http://h/ x\r\nY: z", "é" * 700), (102, "u", "short"), (103, "u", "short")]
    pages = page_table(spark, rows).repartition(3)
    out, manifest = warc.write_archive(pages, shard_bytes=40_000, roll_bytes=2_000)
    got = {r.page_id: r for r in warc.read_archive(spark, out, manifest).collect()}
    assert len(got) == len(rows) and manifest.count() > 3
    last = max(k for k, _, h in rows if h == big)
    for k, _, h in rows:
        raw = (h or "").encode()
        r = got[k]
        assert (r.payload_bytes, r.payload_digest) == (len(raw), hashlib.sha1(raw).hexdigest())
        if h == big and k != last:
            assert (r.record_type, r.refers_to, r.payload) == ("revisit", last, None)
        else:
            assert (r.record_type, r.refers_to, bytes(r.payload)) == ("response", None, raw)
    again, second = warc.write_archive(pages.repartition(5), shard_bytes=40_000, roll_bytes=2_000)
    files = lambda m: sorted((r.file, r.sha256, r.records) for r in m.collect())
    assert files(manifest) == files(second) and again != out


def test_repeated_pages_have_records_of_their_own(spark):
    from pathlib import Path
    from urllib.parse import urlparse

    long, other = "x" * 1200, "y" * 1200
    rows = [(1, "http://a/", long), (1, "http://a/", long), (1, "http://b/", long), (1, "http://a/", other), (2, "http://a/", long), (2, "http://c/", long), (None, "http://a/", "z"), (None, "http://a/", "z"), (None, None, None)]
    out, _ = warc.write_archive(page_table(spark, rows))
    ids, refers = [], []
    for file in Path(urlparse(out).path).glob("*.warc.gz"):
        for m in warc.members(memoryview(file.read_bytes())):
            head = m.split(b"\r\n\r\n")[0].decode()
            fields = dict(x.split(": ", 1) for x in head.split("\r\n")[1:])
            ids.append(fields["WARC-Record-ID"])
            refers.append((fields["WARC-Record-ID"], fields["WARC-Type"], fields.get("WARC-Refers-To")))
    kinds = {i: t for i, t, _ in refers}
    assert len(ids) == len(set(ids)) and sum(t != "warcinfo" for t in kinds.values()) == len(rows)
    assert sum(t == "revisit" for t in kinds.values()) == 3 and all(kinds[r] == "response" for _, t, r in refers if t == "revisit")


def test_damage_is_seen():
    record = warc.page_record(1, "http://h/", b"payload", "2024-01-01T00:00:00Z")
    (data,) = warc.members(memoryview(record))
    assert warc.parse_record(data)["payload"] == b"payload"
    with pytest.raises(ValueError):
        warc.parse_record(data.replace(b"payload\r\n", b"pAyload\r\n"))
    with pytest.raises(ValueError):
        list(warc.members(memoryview(record[:-5])))


def vectors_of(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [float(x) for x in v], 1, "x") for i, v in rows], "vec_id long, embedding array<float>, label int, key string")


def test_vectors_against_brute_force(spark):
    rng = np.random.default_rng(0)
    base = rng.standard_normal((150, 16))
    rows = [*base, *(base[:60] + 0.05 * rng.standard_normal((60, 16))), *([base[0]] * 5), *(base[1] + 0.02 * rng.standard_normal((40, 16)))]
    ids = [2 * k + 3 for k in range(len(rows))]
    odd = [(1000, None), (1001, [0.0] * 16), (1002, [float("nan")] * 16), (1003, []), (1004, [1.0, 2.0])]
    out = {r.vec_id: r for r in multiindex.near_duplicates(vectors_of(spark, [*zip(ids, rows, strict=True), *odd])).collect()}
    x = np.array(rows, np.float32).astype(float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    link = (x @ x.T >= 0.95) & ~np.eye(len(x), dtype=bool)
    want, got = link.sum(), sum(out[i].n_links for i in ids)
    assert 0.97 * want <= got <= want
    for i, _ in odd:
        assert (out[i].n_links, out[i].component_id, out[i].kept) == (0, i, True)
    assert all(out[i].kept == (out[i].component_id == i) for i in ids)
    assert out[ids[210]].component_id == ids[0]


def test_multi_sequence_order():
    rng = np.random.default_rng(0)
    a, b = rng.random(7), rng.random(9)
    cells = multiindex.multi_sequence(a, b, 0.8)
    sums = [a[i] + b[j] for i, j in cells]
    assert sums == sorted(sums) and len(set(cells)) == len(cells) == int((a[:, None] + b[None] <= 0.8).sum())


def test_no_vectors(spark):
    assert multiindex.near_duplicates(vectors_of(spark, [])).count() == 0
    assert multiindex.near_duplicates(vectors_of(spark, [(1, None)])).first().kept
    assert vectors_of(spark, [(1, [1.0])]).filter(F.col("vec_id") > 0).count() == 1


@pytest.mark.parametrize("page", [
    '<body><div class="top">Menu</div><div style="overflow:hidden"><p>Some text here.</p></div></body>',
    '<body><article><header class="entry-header"><h1>Title</h1></header><p>Some text here.</p></article></body>',
    '<body><div class="content has-sidebar"><p>Some text here.</p></div></body>',
    '<body><form id="aspnetForm"><div><p>Some text here.</p></div></form></body>',
    '<body><div data-id="comments"><h2 title="the hidden cost">Cost</h2><p>Some text here.</p></div></body>',
])
def test_attributes_are_names_and_values(page):
    text = html.main_text(page, None)
    assert "Some text here." in text
    assert ("Title" in text) == ("Title" in page) and ("Cost" in text) == ("Cost" in page)


LONG = "This paragraph of article {k} is long enough to be a sentence of its own, and more than that."
NAMED = {
    "a name that says more than advert": (f'<div class="ad-free-content"><p>{LONG}</p><p>End {{k}}.</p></div><div class="contact">Contact us</div>', ["{long}", "End {k}."]),
    "a name that says more than social": (f'<article><h1>T {{k}}</h1><p>Lead {{k}}.</p><section class="social-history"><p>{LONG}</p></section></article>', ["T {k}", "Lead {k}.", "{long}"]),
    "a form around the article": (f'<div class="top">Contact</div><form id="f"><div><h1>T {{k}}</h1><p>{LONG}</p></div></form>', ["T {k}", "{long}"]),
    "names inside an article": (f'<article><h2 id="tags">On tags {{k}}</h2><p>{LONG}</p><section id="search-methods"><p>Method {{k}}.</p></section><p>A <label>word {{k}}</label> stays.</p></article>', ["On tags {k}", "{long}", "Method {k}.", "A word {k} stays."]),
    "a header of the article": (f'<div class="post"><header><h1>Title {{k}}</h1></header><p>{LONG}</p></div>', ["Title {k}", "{long}"]),
    "comments under another name": (f'<div class="story"><h1>T {{k}}</h1><p>{LONG}</p><p>{LONG} Again.</p><p>{LONG} Once more.</p></div><div class="feedback"><div class="entry"><b>Ann {{k}}</b><p>I liked this text a lot, {{k}} times.</p></div><div class="entry"><b>Bob</b><p>So did I, but less than {{k}} times.</p></div></div>', ["T {k}", "{long}", "{long} Again.", "{long} Once more."]),
    "sections are no comments": (f'<div class="story"><h1>T {{k}}</h1><p>{LONG}</p><div class="parts"><div class="part"><h2>One {{k}}</h2><p>{LONG} Again.</p></div><div class="part"><h2>Two {{k}}</h2><p>{LONG} More.</p></div></div></div>', ["T {k}", "{long}", "One {k}", "{long} Again.", "Two {k}", "{long} More."]),
    "a short article beside long lists": (f'<div class="story"><p>{LONG}</p></div><div class="related-posts">' + "".join(f"<p>Another long title {{k}} of number {x}, which you may like as well as this</p>" for x in range(9)) + "</div>", ["{long}"]),
}


@pytest.mark.parametrize("case", NAMED)
def test_names_decide_less_than_text(spark, case):
    body, blocks = NAMED[case]
    page = f"<html><body><nav>Home</nav>{body}<footer>&copy; site</footer></body></html>"
    want = lambda k: [b.replace("{long}", LONG).format(k=k) for b in blocks]
    alone = html.main_text(page.format(k=7), None).split("\n\n")
    assert [b for b in alone if b not in ("Contact us", "Contact")] == want(7)
    rows = [(k, f"http://h.example/{k}", page.format(k=k)) for k in range(8)]
    for r in html.extract(page_table(spark, rows)).collect():
        assert r.templated and r.text.split("\n\n") == want(r.page_id)


def test_classes_are_those_of_brute_force(spark):
    """Valid template segments are the tokens whose counts agree with those of two others, a tag among them, in half of the pages."""
    from collections import Counter, defaultdict

    rng = np.random.default_rng(4)
    rows = []
    for k in range(30):
        extra = "<aside><b>Offer</b><i>Buy</i></aside>" if k % 3 else ""
        body = "".join(f"<p>Text {rng.integers(0, 9**9)}</p>" for _ in range(rng.integers(1, 4)))
        rows.append((k, "http://h.example/x", f"<body><div><b>Home</b><b>News</b></div>{extra}<div>{body}</div><u>Foot</u></body>"))
    vectors, kinds = defaultdict(dict), {}
    for k, _, page in rows:
        seen = Counter()
        read = html.Page(page)
        for kind, key in [("tag", x.keys[-1]) for x in read.elements] + [("text", html._segment_key(x, text)) for x, text in read.items if text and not text.isspace()]:
            seen[key] += 1
            kinds[key] = kind
        for key, n in seen.items():
            vectors[key][k] = n
    classes = defaultdict(list)
    for key, counts in vectors.items():
        classes[tuple(sorted(counts.items()))].append(key)
    want = {k for c, keys in classes.items() if len(c) >= 15 and len(keys) >= 3 and any(kinds[x] == "tag" for x in keys) for k in keys if kinds[k] == "text"}
    got = html.templates(page_table(spark, rows)).collect()
    assert len(got) == 1 and set(got[0].boiler) == want and want


def test_pages_without_id_and_far_ids(spark):
    rows = [(None, None, None), (None, "http://a", "x" * 2000), (-1, "http://b", "y"), (10**18, "http://c", "x" * 2000), *[(k, f"http://d/{k}", "z" * 300 + str(k)) for k in range(500)]]
    pages = page_table(spark, rows)
    out, manifest = warc.write_archive(pages, shard_bytes=20_000)
    got = warc.read_archive(spark, out, manifest).collect()
    assert len(got) == len(rows) and sorted(r.payload_bytes for r in got if r.page_id is None) == [0, 2000]
    assert {r.record_type for r in got} == {"response"} and sum(r.page_id == -1 for r in got) == 1
    assert max(r.records for r in manifest.collect()) < 60


def test_vectors_of_other_lengths_and_kinds(spark):
    rng = np.random.default_rng(1)
    rows = [(k, rng.standard_normal(3).tolist()) for k in range(5)] + [(10, [1.0, 2.0]), (11, [1.0, 2.0]), (12, [2.0, 4.1]), (None, [1.0, 2.0]), (13, None)]
    double = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in multiindex.near_duplicates(double).collect() if r.vec_id is not None}
    assert [got[k] for k in (10, 11, 12)] == [(2, 10)] * 3 and got[13] == (0, 13)


def test_recall_near_the_threshold(spark):
    rng = np.random.default_rng(2)
    base = rng.standard_normal((600, 32))
    base /= np.linalg.norm(base, axis=1)[:, None]
    noise = rng.standard_normal(base.shape)
    noise -= (noise * base).sum(axis=1)[:, None] * base
    noise /= np.linalg.norm(noise, axis=1)[:, None]
    c = rng.uniform(0.951, 0.97, 600)[:, None]
    rows = np.concatenate([base, c * base + np.sqrt(1 - c**2) * noise])
    table = spark.createDataFrame([(k, x.tolist()) for k, x in enumerate(rows)], "vec_id long, embedding array<double>")
    found = sum(r.n_links for r in multiindex.near_duplicates(table).collect())
    unit = rows / np.linalg.norm(rows, axis=1)[:, None]
    true = int(((unit @ unit.T) >= 0.95).sum()) - len(rows)
    assert found >= 0.97 * true


def test_vectors_whose_squares_overflow_or_vanish(spark):
    rows = [(1, [1e200, 1e200]), (2, [1e200, 1e200]), (3, [2e200, 2.1e200]), (4, [1e-200, 1e-200]), (5, [5e-324, 5e-324]), (6, [-1e200, 1e200]), (7, [0.0, -0.0]), (8, [1.0, 1.0])]
    got = {r.vec_id: (r.n_links, r.component_id) for r in multiindex.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert got == {**{k: (5, 1) for k in (1, 2, 3, 4, 5, 8)}, 6: (0, 6), 7: (0, 7)}
