"""Main text of web pages by template deduction over equivalence classes.

A page is a run of tokens: each opening tag with its path of open elements, and each text
segment with its path. Over the pages of a host, tokens with the same occurrence vector (the
same count in every page) form an equivalence class. A vector is kept as sums of its counts
times per-page random numbers, so classes come from one aggregation, however many pages a
host has. A class is valid if it has at least ``class_size`` tokens, one of them a tag, and
occurs in ``support`` of the host's pages. Valid classes nest by their tokens' paths and make up the
template; blocks of text whose segments all lie in valid classes belong to it. What varies between template tokens
are the slots; the main one is found by walking down the tree, from the article or main where one marks most of the
text, as long as one child holds all varying text outside parts in doubt. A name or a form puts a part in doubt, and what
it holds decides: a part with most of a page's varying text is the article's, whatever its name. Comments are known by a
name, or as the repeated records at a page's end that begin with a short line.

Defined results: a null or empty page, and one without text, gives an empty text; a null url or one
without host belongs to the host ``""``; hosts with fewer than ``least_pages`` pages have no template and
each page walks down its own tree; repeated rows are pages of their own. Only the three
named columns are read.
"""

from __future__ import annotations

import html as entities
import re
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: HTML element names by kind.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes plaintext".split())
BLOCK = set("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
LEAF = set("p h1 h2 h3 h4 h5 h6 li pre blockquote td th dd dt figcaption".split())
NEVER = set("head script style noscript template textarea title xmp iframe noembed noframes svg math canvas object select button nav footer aside menu dialog input audio video map".split())
ARTICLE = set("article main".split())
#: Words in class, id and role that mark parts other than the article.
ASIDE_WORDS = set(
    "ad ads adv advert adverts advertisement advertising adsense adbox adslot banner breadcrumb breadcrumbs comment comments commentlist consent contentinfo cookie cookies copyright disqus "
    "footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notification pager pagination popup promo promotion recommended related replies reply "
    "search share sharing sidebar signup skip social sponsor sponsored subscribe subscription tags toolbar topbar widget widgets complementary discussion respond responses reactions".split()
)

#: Words that may stand beside those in a name without saying what a part is.
HOLDER_WORDS = set(
    "area article articles author bar block blocks body bottom box bottom btn button buttons cell center col column container content count entries entry fixed float form global grid group head heading holder inner item items "
    "large latest layout left link links list main meta mobile more most news outer page panel panels placement popular post posts primary reader readers right row secondary section site slot small stack sticky stories story "
    "strip tab tabs text thread title top unit user users view wide wrap wrapper zone".split()
)
#: Words that make a header one of the article.
CONTENT_WORDS = set("article entry post story".split())
HEADING = set("h1 h2 h3 h4 h5 h6".split())
RECORD = set("div li article section dd".split())
#: Characters of a block that is no mere label.
SENTENCE = 60

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
_ATTRIBUTE = re.compile(r"([^\s=\"'>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_ASKED = {"class", "id", "role", "hidden", "aria-hidden"}
_HAS = re.compile(r"\b(?:has|with|without|no)[-_]?[\w-]+", re.I)  # says what stands beside an element, not what it is
_HOST = re.compile(r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)")
_WORD = re.compile(r"[a-z]+|[A-Z][a-z]*")
_MASK = (1 << 31) - 1

STATS = "host string, kind string, key long, parent long, leaf boolean, article boolean, v1 long, v2 long, pages long, chars long"


def host_of(url: str | None) -> str:
    found = _HOST.match(url or "")
    return found[1].lower() if found else ""


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text) - (1 << 63)


def _marks(value: str) -> bool:
    """Whether a class, id or role names a part outside the article: one of its names has a word that does, and no word that says more."""
    for name in value.split():
        own = [w.lower() for w in _WORD.findall(_HAS.sub(" ", name)) if len(w) > 1]
        said = {w for w in own if w in ASIDE_WORDS}
        if said and all(w in ASIDE_WORDS or w in HOLDER_WORDS for w in own) and not (said == {"header"} and CONTENT_WORDS & set(own)):
            return True
    return False


class _Open:
    """An element: its name, path keys, the elements above that are in doubt by name or as a form, and what it holds.

    ``never``: stands outside the article by its tag. ``doubts``: numbers of the marked elements and forms from the root down to it.
    """

    __slots__ = ("above", "article", "blocks", "chars", "doubts", "first", "keys", "last", "name", "never", "number")

    def __init__(self, name: str, attributes: str, above: _Open | None, number: int):
        label, marked = name, False
        if attributes:
            for m in _ATTRIBUTE.finditer(attributes):
                what, value = m[1].lower(), m[2] or m[3] or m[4] or ""
                if what not in _ASKED:
                    continue
                if what in ("class", "id"):
                    label += f".{re.sub('[0-9]+', '#', value)}"
                if what in ("class", "id", "role"):
                    marked |= _marks(value)
                elif what == "hidden" or value == "true":
                    marked = True
        self.name, self.above, self.number = name, above, number
        self.article = (above.article if above else False) or name in ARTICLE
        self.keys = (*(above.keys if above else ()), _hash(f"{above.keys[-1] if above else 0}/{label}"))
        site_header = name == "header" and not self.article and (marked or above is None or above.name in ("body", "html"))
        self.never = (above.never if above else False) or name in NEVER or site_header
        doubtful = name == "form" or (marked and name not in HEADING and name not in ("body", "html", "article", "main"))
        self.doubts = (*(above.doubts if above else ()), number) if doubtful else above.doubts if above else ()
        self.chars, self.blocks, self.first, self.last = 0, 0, None, -1


class Page:
    """One reading of a page: its elements in order, and its items: (element or None, text) for text, (None, None) at block borders.

    White space between tags is an item of one space.
    """

    def __init__(self, page: str):
        self.elements: list[_Open] = []
        self.items: list[tuple[_Open | None, str | None]] = []
        stack: list[_Open] = []
        at, size = 0, len(page)
        while at < size:
            m = _TOKEN.search(page, at)
            text = page[at : m.start() if m else size]
            if text:
                self.items.append((stack[-1] if stack else None, " " if text.isspace() else text))
            if not m:
                return
            at = m.end()
            name = (m[2] or m[5] or "").lower()
            if not name:
                continue
            if m[1] or m[4]:
                k = next((k for k in range(len(stack) - 1, -1, -1) if stack[k].name == name), None)
                if k is not None:
                    del stack[k:]
                if name in BLOCK:
                    self.items.append((None, None))
                continue
            if name in BLOCK:
                # a paragraph ends where a block begins; an item, cell or row ends where the next one does
                p = next((k for k in range(len(stack) - 1, -1, -1) if stack[k].name == "p"), None)
                if p is not None:
                    del stack[p:]
                if name in ("li", "dd", "dt", "td", "th", "tr", "option"):
                    alike = ("dd", "dt") if name in ("dd", "dt") else ("td", "th") if name in ("td", "th") else (name,)
                    k = next((k for k in range(len(stack) - 1, -1, -1) if stack[k].name in (*alike, "ul", "ol", "dl", "table")), None)
                    if k is not None and stack[k].name in alike:
                        del stack[k:]
                self.items.append((None, None))
            elif name == "br":
                self.items.append((stack[-1] if stack else None, " "))
            attributes = m[3] or m[6] or ""
            stack.append(_Open(name, attributes, stack[-1] if stack else None, len(self.elements)))
            self.elements.append(stack[-1])
            if name in VOID or attributes.endswith("/"):
                stack.pop()
            elif name in RAW:
                end = re.compile(f"</{re.escape(name)}\\s*>", re.I).search(page, at)
                at = end.end() if end else size
                stack.pop()

    def closed(self, boiler: frozenset[int] = frozenset()) -> set[int]:
        """Numbers of the elements whose text is not the article's: those in doubt, and lists of comments.

        Where nothing varies outside of them in an article or main, nor as long as a sentence, those in doubt that hold most of what varies
        are the article after all.
        """
        total, begun, block, longest = 0, False, 0, 0
        for element, text in (*self.items, (None, None)):
            if text is None:
                begun, block, longest = False, 0, max(longest, block)
            elif element is not None and not element.never and not text.isspace() and (not boiler or _segment_key(element, text) not in boiler):
                total += len(text)
                block += 0 if element.doubts else max(len(text), SENTENCE * element.article)
                x, fresh, heading = element, not begun, element.name in HEADING
                while x is not None:
                    x.chars += len(text)
                    x.blocks += fresh
                    x.last = total
                    if x.first is None:
                        x.first = (total - len(text), len(text), heading)
                    heading |= x.name in HEADING
                    x = x.above
                begun = True
        out = {x.number for x in self.elements if x.doubts and x.doubts[-1] == x.number and (longest >= SENTENCE or 2 * x.chars <= total)}
        return out | {x.number for x in self._comment_lists(total)}

    def _comment_lists(self, total: int) -> Iterator[_Open]:
        """Elements at the end of a page, of less than half of its text, made of two alike records or more that begin with a short line which is no heading."""
        alike: dict[tuple, list[_Open]] = defaultdict(list)
        for x in self.elements:
            if x.name in RECORD and x.above is not None and x.first is not None:
                alike[x.above.number, x.keys[-1]].append(x)
        for (parent, _), records in alike.items():
            above = self.elements[parent]
            if len(records) < 2 or above.name in ("body", "html", "article", "main") or 2 * above.chars > total or above.first[0] < total / 2 or above.last < 0.9 * total:
                continue
            if all(r.blocks >= 2 and r.first[1] <= 40 and not r.first[2] and r.chars >= 2 * r.first[1] for r in records) and sum(r.chars for r in records) >= 0.6 * above.chars:
                yield above


def _segment_key(element: _Open | None, text: str) -> int:
    return _hash(f"{element.keys[-1] if element else 0}|{' '.join(text.split())}")


def _open_text(element: _Open | None, closed: set[int]) -> bool:
    """Whether an element's text may be the article's."""
    x = element
    if x is None or x.never:
        return False
    while x is not None:
        if x.number in closed:
            return False
        x = x.above
    return True


def _page_numbers(page_id: object) -> tuple[int, int]:
    h = xxhash.xxh64_intdigest(str(page_id), seed=7)
    return (h & _MASK) + 1, ((h >> 32) & _MASK) + 1


def token_statistics(pages: DataFrame) -> DataFrame:
    """One row for each host and token or path (see STATS): vector sums, pages with it, and text outside NEVER elements."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total: dict[tuple, list] = {}
            for page_id, url, page in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                host, (r1, r2) = host_of(url), _page_numbers(page_id)
                own: dict[tuple, list] = defaultdict(lambda: [0, 0])
                own["page", 0, 0, False, False][0] = 1
                read = Page(page or "")
                closed = read.closed()
                for x in read.elements:
                    own["tag", x.keys[-1], x.keys[-2] if len(x.keys) > 1 else 0, x.name in LEAF, _outermost(x)][0] += 1
                for x, text in read.items:
                    if text is None or text.isspace():
                        continue
                    segment = own["text", _segment_key(x, text), x.keys[-1] if x else 0, False, False]
                    segment[0] += 1
                    if _open_text(x, closed):
                        segment[1] += len(text)
                        while x is not None:
                            own["tag", x.keys[-1], x.keys[-2] if len(x.keys) > 1 else 0, x.name in LEAF, _outermost(x)][1] += len(text)
                            x = x.above
                for key, (n, chars) in own.items():
                    row = total.setdefault((host, *key), [0, 0, 0, 0])
                    row[0] += n * r1
                    row[1] += n * r2
                    row[2] += 1
                    row[3] += chars
            keys, sums = list(zip(*total, strict=True)) or [()] * 6, list(zip(*total.values(), strict=True)) or [()] * 4
            kinds = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), *[pa.int64()] * 4)
            yield pa.record_batch([pa.array(c, t) for c, t in zip([*keys, *sums], kinds, strict=True)], names=[x.split()[0] for x in STATS.split(", ")])

    rows = pages.select("page_id", "url", "html").mapInArrow(count, STATS)
    return rows.groupBy("host", "kind", "key").agg(F.first("parent").alias("parent"), F.first("leaf").alias("leaf"), F.first("article").alias("article"), *[F.sum(c).alias(c) for c in ("v1", "v2", "pages", "chars")])


def templates(pages: DataFrame, *, support: float = 0.5, class_size: int = 3, least_pages: int = 5) -> DataFrame:
    """host, main, boiler: the path key of the main slot and the keys of the template's text segments.

    Only tokens in ``support`` of a host's pages come together in one group: at most
    1 / support times the tokens of a page.
    """
    stats = token_statistics(pages)
    hosts = stats.filter("kind = 'page'").select("host", F.col("pages").alias("all"))
    common = stats.join(hosts.filter(F.col("all") >= least_pages), "host").filter((F.col("kind") != "page") & (F.col("pages") >= F.col("all") * support))

    def deduce(host_rows: pd.DataFrame) -> pd.DataFrame:
        classes = host_rows.groupby(["v1", "v2", "pages"])
        valid = host_rows[(classes["key"].transform("size") >= class_size) & (host_rows["kind"] == "tag").groupby([host_rows[c] for c in ("v1", "v2", "pages")]).transform("any")]
        tags = valid[valid["kind"] == "tag"]
        fixed = valid[valid["kind"] == "text"]
        boiler = sorted(fixed["key"].tolist())
        loose = host_rows[(host_rows["kind"] == "tag") & ~host_rows["key"].isin(tags["key"])]
        return pd.DataFrame({"host": [host_rows["host"].iloc[0]], "main": [main_slot(_varying(pd.concat([tags, loose]), fixed))], "boiler": [boiler]})

    return common.groupBy("host").applyInPandas(deduce, "host string, main long, boiler array<long>")


def _outermost(x: _Open) -> bool:
    """Whether an element is an article or main that stands in no other."""
    return x.name in ARTICLE and not (x.above and x.above.article)


def _varying(tags: pd.DataFrame, fixed: pd.DataFrame) -> pd.DataFrame:
    """``tags`` without the text of template segments, in their own elements and all above."""
    above, less = dict(zip(tags["key"], tags["parent"], strict=True)), defaultdict(int)
    for key, chars in zip(fixed["parent"], fixed["chars"], strict=True):
        while key in above:
            less[key] += chars
            key = above[key]
    return tags.assign(chars=[c - less[k] for k, c in zip(tags["key"], tags["chars"], strict=True)])


def main_slot(tags: pd.DataFrame, share: float = 0.75) -> int:
    """The article or main, if its name marks ``share`` of the text, or else the root (0); from there down while one child, not itself a block of text, holds all of it."""
    children, marked = defaultdict(list), []
    for key, parent, leaf, article, chars in zip(tags["key"], tags["parent"], tags["leaf"], tags["article"], tags["chars"], strict=True):
        children[parent].append((chars, key, leaf))
        if article:
            marked.append((chars, key))
    at, held = 0, sum(c for c, _, _ in children[0])
    if marked and max(marked)[0] >= max(1, share * held):
        held, at = max(marked)
    while children[at]:
        chars, key, leaf = max(children[at])
        if leaf or chars <= 0 or chars < held:
            break
        at, held = key, chars
    return int(at)


def main_text(page: str, main: int | None, boiler: frozenset[int] = frozenset()) -> str:
    """The text of a page's main slot: blocks joined by two line feeds.

    Blocks of template text alone are left out. If that leaves nothing, template text counts; then the page's
    own main slot; then all text but that of elements that never hold an article.
    """
    read = Page(page)
    closed = read.closed(boiler)
    every = set()
    for own, skip, shut in ((main, boiler, closed), (main, (), closed), (None, (), closed), (0, boiler, every), (0, (), every)):
        own = _own_main(read, closed) if own is None else own
        blocks, words, varies = [], [], False
        for x, text in (*read.items, (None, None)):
            if text is None:
                if varies and (block := " ".join(entities.unescape("".join(words)).split())):
                    blocks.append(block)
                words, varies = [], False
            elif text.isspace():
                words.append(" ")
            elif (x is None and not own) or (x is not None and _open_text(x, shut) and (not own or own in x.keys)):
                words.append(text)
                varies = varies or not skip or _segment_key(x, text) not in skip
        if blocks:
            return "\n\n".join(blocks)
    return ""


def _own_main(read: Page, closed: set[int]) -> int:
    """The main slot of one page alone."""
    rows: dict[int, list] = {}
    for x, text in read.items:
        if text is not None and not text.isspace() and _open_text(x, closed):
            while x is not None:
                rows.setdefault(x.keys[-1], [x.keys[-2] if len(x.keys) > 1 else 0, x.name in LEAF, _outermost(x), 0])[3] += len(text)
                x = x.above
    return main_slot(pd.DataFrame([(k, *v) for k, v in rows.items()], columns=["key", "parent", "leaf", "article", "chars"]))


def extract(pages: DataFrame, *, broadcast_tokens: int = 1_000_000, **options) -> DataFrame:
    """page_id, url, text, n_chars, templated for each row of ``pages`` (page_id, url, html).

    Templates are broadcast while they hold at most ``broadcast_tokens`` tokens in all; beyond, pages
    meet their host's template in a join whose large partitions Spark splits.
    """
    from .scratch import bounded_batches, saved

    bounded_batches(pages.sparkSession)
    found = saved(templates(pages, **options), "templates")
    names = ["page_id", "url", "html", "main", "boiler"]
    kept = pages.select("page_id", "url", "html")
    size = found.agg(F.coalesce(F.sum(F.size("boiler") + 10), F.lit(0))).first()[0]
    schema = kept.select("page_id", "url").withColumns({"text": F.lit(""), "n_chars": F.lit(0).cast("long"), "templated": F.lit(True)}).schema
    if size <= broadcast_tokens:
        held = {row["host"]: (row["main"], frozenset(row["boiler"])) for row in found.collect()}
        sent = pages.sparkSession.sparkContext.broadcast(held)
    else:
        sent = None
        host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), _HOST.pattern, 1))
        kept = kept.withColumn("h", host).join(found.withColumnRenamed("host", "h"), "h", "left").select(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in range(1, batch.num_columns)]
            texts, templated = [], []
            for k, url in enumerate(columns[0]):
                if sent is not None:
                    main, boiler = sent.value.get(host_of(url), (None, frozenset()))
                else:
                    main, boiler = columns[2][k], frozenset(columns[3][k] or ())
                page = columns[1][k] or ""
                texts.append(main_text(page, main, boiler))
                templated.append(main is not None)
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()), pa.array(templated)], names=schema.names)

    return kept.mapInArrow(run, schema)
