"""Main text of web pages by site style trees (operator 4).

The pages of a host are merged into one tree of element paths (tags with their class and id names). With m pages that have a path,
the presentation importance of its branch is the entropy, to the base m, of the branch's shapes (nested tags), and its content
importance is 1 less the mean entropy of its distinct texts, where a text of c pages has log_m c. The branch's importance is their
mean, weighed by SHAPE. A branch is free if the entropy of its element's rows of children is FREE or more, as in an article, whose
paragraphs differ from page to page; others are templates, as a body that always holds a menu, an advert and an article.

Walking down a page, of the sections of a template those go whose importance is below SHARE of their best sibling's: adverts
and footers have one shape, menus few, however much their words differ. What is free stays whole. Anywhere, branches of an importance below
LOW and single texts go that EVERYWHERE of the host's pages have; what fewer share may be a copied article. Where pages of a
host hardly differ, its tree says nothing.

Names and tags settle what importance leaves open: branches of hosts with fewer than MIN_PAGES pages of a path, sections
as important as their best sibling, and reader comments, which differ as articles do. An element that says that it is a menu, advert or comment goes;
of the rest an article or main element, or else names such as content, decide, but what the tree found to be best stays.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxmill.llm.common import cut, small_batches, spread, table

#: Weight of presentation in a branch's importance.
SHAPE = 0.6
#: Sections of a template below this share of their best sibling's importance go.
SHARE = 0.8
#: Least best importance among siblings that others are held against.
BEST = 0.3
#: Entropy of an element's rows of children from which on it is no template.
FREE = 0.2
#: Branches below this importance go.
LOW = 0.1
#: Share of a host's pages that have what is the same on them and so no content.
EVERYWHERE = 0.9
#: Least importance of an average text of a host's pages for any verdict on it.
DIFFER = 0.2
#: Pages that a path must have before its importance counts.
MIN_PAGES = 4
#: Elements below this depth have the path of the one at it; elements don't nest deeper than NESTING, but follow each other there.
PATH_DEPTH, NESTING = 48, 512
#: Verdicts that may be sent to every task; about 10 MB.
SHIP = 100_000
#: Keys that a task sums pages by before it passes them on.
FLUSH = 50_000

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.I)
_NAME = re.compile(r"[a-z]+")
_RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "noframes", "xmp", "svg", "math", "object", "select", "canvas", "audio", "video"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "q", "ruby", "rb", "rt", "rp", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "img", "nobr", "center-inline"}
_CLOSES_P = {"address", "article", "aside", "blockquote", "details", "div", "dl", "fieldset", "figure", "figcaption", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "nav", "ol", "p", "pre", "section", "table", "ul"}
#: Elements that a start tag of the same group ends, up to the element that holds them.
_SIBLINGS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table", "tbody", "thead", "tfoot"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
#: Elements that hold no main text.
_NOISE_TAGS = {"nav", "footer", "aside", "form", "button", "dialog", "menu", "head", "input", "label", "fieldset"}
_NOISE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "menu", "menubar", "dialog", "alert", "alertdialog", "toolbar", "tablist", "advertisement"}
#: Words in class and id names that say so.
_NOISE_WORDS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "adsense", "adbox", "adslot", "banner", "sponsor", "sponsored", "promo", "promotion", "promoted",
    "nav", "navbar", "navigation", "menu", "menus", "breadcrumb", "breadcrumbs", "toc", "pagination", "pager", "sidebar", "sidebars", "aside", "widget", "widgets", "rail",
    "footer", "foot", "masthead", "topbar", "header", "siteheader", "sitefooter", "colophon", "copyright",
    "notice", "notices", "cookie", "cookies", "consent", "gdpr", "popup", "modal", "overlay", "toast", "alert", "paywall", "disclaimer",
    "comment", "comments", "commentlist", "disqus", "respond", "reply", "replies", "discussion", "reactions",
    "newsletter", "subscribe", "subscription", "signup", "login", "register", "form", "search", "share", "sharing", "social", "related", "recommended", "recommendations", "trending", "outbrain", "taboola", "tags", "skip", "hidden",
}
_COMMENTS = {"comment", "comments", "commentlist", "disqus", "respond", "reply", "replies", "discussion", "reactions"}
#: Elements that are held against their siblings; headings, paragraphs and the like aren't.
_SECTIONS = {"article", "aside", "center", "dir", "div", "dl", "fieldset", "footer", "form", "header", "main", "menu", "nav", "ol", "section", "table", "td", "tr", "tbody", "ul"}
_MAIN_WORDS = {"article", "main", "content", "post", "entry", "story", "body"}


def host_of(url: str | None) -> str:
    """Lower-case host of a URL without user and port; null and other texts have the empty host."""
    m = re.match(r"\s*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return m[1].lower() if m else ""


@dataclass
class Page:
    """Elements in page order (the first is the root) and texts, each with its element and the block it belongs to."""

    tag: list[str] = field(default_factory=list)
    words: list[frozenset] = field(default_factory=list)
    role: list[str] = field(default_factory=list)
    hidden: list[bool] = field(default_factory=list)
    parent: list[int] = field(default_factory=list)
    path: list[str] = field(default_factory=list)
    children: list[list[str]] = field(default_factory=list)
    texts: list[tuple[int, int, str]] = field(default_factory=list)

    def add(self, tag: str, attributes: str, parent: int, depth: int = 0) -> int:
        words, role, hidden = frozenset(), "", False
        if attributes and attributes.strip(" /\n\t"):
            names = []
            for m in _ATTRIBUTE.finditer(attributes):
                value, key = (m[2] or m[3] or m[4] or "").lower(), m[1].lower()
                if key == "role":
                    role = value.strip()
                elif key in ("class", "id"):
                    names += _NAME.findall(value)
                else:
                    hidden = hidden or key == "hidden" or value == "true"
            words = frozenset(names)
        i = len(self.tag)
        self.tag.append(tag)
        self.words.append(words)
        self.role.append(role)
        self.hidden.append(hidden)
        self.parent.append(parent)
        name = ".".join([tag, *sorted(words)])
        self.path.append(name if not i else f"{self.path[parent]}/{name}" if depth < PATH_DEPTH else self.path[parent])
        self.children.append([])
        if i:
            self.children[parent].append(name)
        return i


def parse(html: str) -> Page:
    """Tolerant parsing: missing end tags are implied, others that match nothing are skipped; nothing raises."""
    page = Page()
    stack = [page.add("root", "", 0)]
    tags = ["root"]
    block = at = 0

    def text(a: int, b: int) -> None:
        if b > a:
            page.texts.append((stack[-1], block, html[a:b]))

    while True:
        m = _TAG.search(html, at)
        if not m:
            text(at, len(html))
            return page
        text(at, m.start())
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag in tags:
                k = len(tags) - 1 - tags[::-1].index(tag)
                # an end tag of a phrase doesn't end the block around it
                if tag in _INLINE and any(t not in _INLINE for t in tags[k + 1 :]):
                    continue
                if any(t not in _INLINE for t in tags[k:]):
                    block += 1
                del stack[k:], tags[k:]
            continue
        if tag in _RAW:
            if not m[3].rstrip().endswith("/") or tag not in ("svg", "math"):
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(html, at)
                at = end.end() if end else len(html)
            block += tag not in _INLINE
            continue
        if tag in _CLOSES_P and "p" in tags:
            k = len(tags) - 1 - tags[::-1].index("p")
            if not {"button", "table", "td", "th", "object"} & set(tags[k:]):
                del stack[k:], tags[k:]
        if tag in _SIBLINGS:
            ends, within = _SIBLINGS[tag]
            for k in range(len(tags) - 1, 0, -1):
                if tags[k] in within:
                    break
                if tags[k] in ends:
                    del stack[k:], tags[k:]
        if tag not in _INLINE:
            block += 1
        i = page.add(tag, m[3], stack[-1], len(stack))
        if tag not in _VOID and len(stack) < NESTING:
            stack.append(i)
            tags.append(tag)


def _plain(text: str) -> str:
    return " ".join((entities.unescape(text) if "&" in text else text).split())


def _key(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


_MASK = (1 << 64) - 1
_STEP = 0x9E3779B97F4A7C15


def _rolled(h: int, x: int) -> int:
    h = ((h ^ x) * _STEP) & _MASK
    return h ^ (h >> 29)


@lru_cache(1 << 14)
def _name_key(name: str) -> int:
    return _key(name) & _MASK


def _signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def features(page: Page) -> tuple[dict[str, int], dict[str, int], dict[int, set[str]]]:
    """Of each path the rows of children of its elements, and their shapes, as hashes; of each text's hash the paths that it stands at."""
    n = len(page.tag)
    shape = [_name_key(t) for t in page.tag]
    for i in range(n - 1, 0, -1):  # children come after their parent, so each is whole before it counts
        shape[page.parent[i]] = _rolled(shape[page.parent[i]], shape[i])
    rows: dict[str, int] = {}
    shapes: dict[str, int] = {}
    for path, children, h in zip(page.path, page.children, shape, strict=True):
        shapes[path] = _rolled(shapes.get(path, 0), h)
        if children:
            own = rows.get(path, 0)
            for c in children:
                own = _rolled(own, _name_key(c))
            rows[path] = _rolled(own, 1)
    texts: dict[int, set[str]] = {}
    for node, _, text in page.texts:
        if plain := _plain(text):
            texts.setdefault(_key(plain), set()).add(page.path[node])
    return {p: _signed(h) for p, h in rows.items()}, {p: _signed(h) for p, h in shapes.items()}, texts


def _noise(page: Page, i: int, in_article: bool, holder: bool) -> bool:
    tag = page.tag[i]
    if tag in _NOISE_TAGS or page.role[i] in _NOISE_ROLES or page.hidden[i]:
        return True
    if tag in ("root", "html", "body", "article", "main"):
        return bool(page.words[i] & {"comment", "comments", "reply"}) if tag == "article" else False
    if tag == "header":
        return not in_article
    return not holder and bool(page.words[i] & _NOISE_WORDS) and tag not in _INLINE | {"h1"}


#: Verdicts on a path, as bits.
IS_LOW, IS_WEAK, IS_STRONG, IS_FREE = 1, 2, 4, 8
_NO_VERDICTS: tuple[dict, frozenset] = ({}, frozenset())


def extract(html: str | None, verdicts: tuple[dict[str, int], frozenset] = _NO_VERDICTS, names: bool = True) -> str:
    """Main text of a page: blocks in page order, joined by one space; empty if there is none.

    verdicts: of the page's host, bits by path, and (path, hash) of the texts that are no content. names: whether names and tags settle the rest.
    """
    if not html:
        return ""
    page = parse(html)
    bits_of, weak_texts = verdicts
    n = len(page.tag)
    noise, article, main, named, holder, strong, free = ([False] * n for _ in range(7))
    for i in range(n):
        if page.tag[i] in ("article", "main") and not holder[i]:
            p = page.parent[i]
            while not holder[p]:
                holder[p] = True
                p = page.parent[p]
    for i in range(n):
        p, tag, bits = page.parent[i], page.tag[i], bits_of.get(page.path[i], 0)
        up = i > 0
        article[i] = (up and article[p]) or tag == "article" or page.role[i] == "article"
        main[i] = (up and main[p]) or tag == "main" or page.role[i] == "main"
        free[i] = (up and free[p]) or bool(bits & IS_FREE)
        open_ = up and not free[p] and not article[p]
        # what holds an article or main element isn't noise by its name, nor by the importance of the whole
        holds = holder[i] or tag in ("root", "html", "body", "article", "main")
        by_tree = not holds and (bits & IS_LOW or (bits & IS_WEAK and open_ and tag in _SECTIONS))
        best = open_ and not holds and bool(bits & IS_STRONG)
        strong[i] = (up and strong[p]) or best
        # names don't hold against the best and free branch, unless they tell of comments
        sure = best and bits & IS_FREE and tag not in _NOISE_TAGS and not page.words[i] & _COMMENTS and not page.hidden[i]
        by_name = names and not sure and _noise(page, i, article[i] or main[i], holder[i])
        noise[i] = (up and noise[p]) or bool(by_tree) or by_name or tag == "head"
        named[i] = (up and named[p]) or (tag in ("div", "section", "td") and bool(page.words[i] & _MAIN_WORDS))
    kept = []
    for node, block, text in page.texts:
        if noise[node] or (weak_texts and (page.path[node], _key(_plain(text))) in weak_texts):
            continue
        kept.append((node, block, entities.unescape(text) if "&" in text else text))
    for chosen in (article, main, named) if names else ():
        inside = [x for x in kept if chosen[x[0]]]
        if any(t.strip() for _, _, t in inside):
            kept = [x for x in kept if chosen[x[0]] or strong[x[0]]]
            break
    blocks, last = [], None
    for _, block, text in kept:
        if block == last:
            blocks[-1].append(text)
        else:
            blocks.append([text])
            last = block
    return " ".join(" ".join("".join(parts).split()) for parts in blocks if any(p.strip() for p in parts)).strip()


#: What a row of _rows counts: rows of children, shapes, texts that stand at one path, texts that stand at several or above those.
_OWN, _SHAPE, _TEXT, _ABOVE = range(4)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages by (host, path, kind, value), summed over up to FLUSH keys at a time.

    A text that stands at one path of a page counts for each path above it too, once its counts are summed. One that stands at
    several counts once a page for each path above any of them, which is told here.
    """
    counts: Counter = Counter()

    def flush() -> pa.RecordBatch:
        cols = list(zip(*counts, strict=True)) or [[]] * 4
        out = pa.RecordBatch.from_pydict({"host": pa.array(cols[0], pa.string()), "path": pa.array(cols[1], pa.string()), "kind": pa.array(cols[2], pa.int32()), "value": pa.array(cols[3], pa.int64()), "c": pa.array(counts.values(), pa.int64())})
        counts.clear()
        return out

    for batch in small_batches(batches, "html"):
        for url, html in zip(batch.column("url").to_pylist(), batch.column("html").to_pylist(), strict=True):
            if html:
                host = host_of(url)
                rows, shapes, texts = features(parse(html))
                counts.update((host, path, _OWN, value) for path, value in rows.items())
                counts.update((host, path, _SHAPE, value) for path, value in shapes.items())
                for value, paths in texts.items():
                    if len(paths) == 1:
                        counts[host, next(iter(paths)), _TEXT, value] += 1
                    else:
                        above = {"/".join(parts[:k]) for parts in (p.split("/") for p in paths) for k in range(1, len(parts) + 1)}
                        counts.update((host, path, _ABOVE, value) for path in above)
        if len(counts) > FLUSH:
            yield flush()
    yield flush()


def counted(pages: DataFrame) -> DataFrame:
    """(host, path, kind, value, c): pages with that row of children (_OWN), shape (_SHAPE) or text in the branch (_TEXT)."""
    rows = pages.select("url", "html").mapInArrow(_rows, "host string, path string, kind int, value long, c long")
    rows = rows.groupBy("host", "path", "kind", "value").agg(F.sum("c").alias("c"))
    parts = F.split("path", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, 1, k), "/"))
    paths = F.when(F.col("kind") == _TEXT, above).otherwise(F.array("path"))
    kind = F.least("kind", F.lit(_TEXT)).alias("kind")
    return rows.select("host", F.explode(paths).alias("path"), kind, "value", "c").groupBy("host", "path", "kind", "value").agg(F.sum("c").alias("c"))


def importance(counts: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, path, pages, own, presentation, content, average, importance) of each path with a text in its branch, of min_pages pages or more.

    own: entropy of the rows of children; average: 1 less the mean entropy of the texts, where one of c pages counts c times.
    """
    c, log_c = F.col("c"), F.log(F.col("c").cast("double"))
    of = lambda kind, x: F.coalesce(F.sum(F.when(F.col("kind") == kind, x)), F.lit(0.0))
    paths = counts.groupBy("host", "path").agg(
        F.sum(F.when(F.col("kind") == _SHAPE, c)).alias("pages"), of(_SHAPE, c * log_c).alias("shaped"), of(_OWN, c).alias("parents"), of(_OWN, c * log_c).alias("rowed"),
        of(_TEXT, F.lit(1.0)).alias("texts"), of(_TEXT, log_c).alias("common"), of(_TEXT, c).alias("uses"), of(_TEXT, c * log_c).alias("used"),
    )
    log_m = F.log(F.col("pages").cast("double"))
    parts = {
        "own": F.coalesce(F.when(F.col("parents") > 1, 1 - F.col("rowed") / F.col("parents") / F.log("parents")), F.lit(0.0)),
        "presentation": 1 - F.col("shaped") / F.col("pages") / log_m, "content": 1 - F.col("common") / F.col("texts") / log_m, "average": 1 - F.col("used") / F.col("uses") / log_m,
    }
    found = paths.where((F.col("pages") >= max(min_pages, 2)) & (F.col("texts") > 0)).withColumns(parts)
    return found.withColumn("importance", SHAPE * F.col("presentation") + (1 - SHAPE) * F.col("content")).select("host", "path", "pages", *parts, "importance")


def judged(counts: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, path, bits, value): verdicts on paths (bits), and texts (value) that are no content where they stand."""
    parent, section = F.regexp_extract("path", "^(.*)/", 1), F.regexp_extract("path", r"([^/.]*)[^/]*$", 1).isin(*_SECTIONS)
    found = cut(importance(counts, min_pages).withColumns({"parent": parent, "section": section}))
    differ = found.where((F.col("path") == "root") & (F.col("average") >= DIFFER)).select("host", (EVERYWHERE * F.col("pages")).alias("most"))
    best = found.where("section").groupBy("host", "parent").agg(F.max("importance").alias("best"))
    held = found.join(differ, "host").join(best, ["host", "parent"], "left")
    against = F.col("section") & (F.coalesce("best", F.lit(0.0)) >= BEST)
    weak = against & (F.col("importance") < SHARE * F.col("best"))
    bits = (
        F.when((F.col("importance") < LOW) & (F.col("pages") >= F.col("most")), IS_LOW).otherwise(0) + F.when(weak, IS_WEAK).otherwise(0)
        + F.when(against & ~weak, IS_STRONG).otherwise(0) + F.when(F.col("own") >= FREE, IS_FREE).otherwise(0)
    )
    paths = held.select("host", "path", bits.cast("int").alias("bits"), F.lit(None).cast("long").alias("value")).where("bits > 0")
    texts = counts.where(F.col("kind") == _TEXT).join(differ, "host").where(F.col("c") >= F.col("most")).select("host", "path", F.lit(0).alias("bits"), "value")
    return paths.unionByName(texts)


def _extracted(verdicts_of, names: bool):
    """verdicts_of: from a batch and a row's number and host to the host's verdicts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "html"):
            urls = batch.column("url").to_pylist()
            out = [extract(html, verdicts_of(batch, i, host_of(u)), names) for i, (u, html) in enumerate(zip(urls, batch.column("html").to_pylist(), strict=True))]
            yield pa.RecordBatch.from_pydict({"page_id": batch.column("page_id"), "url": batch.column("url"), "text": pa.array(out, pa.string()), "n_chars": pa.array(map(len, out), pa.int64())})

    return run


def main_text(pages: DataFrame, min_pages: int = MIN_PAGES, ship: int = SHIP, names: bool = True) -> DataFrame:
    """page_id, url, text, n_chars for each row of pages (page_id, url, html).

    Null and empty pages have the empty text. Pages without a host share one. Repeated rows count as pages each. Paths of fewer than
    min_pages pages lose nothing by statistics. Further columns are ignored. Up to `ship` verdicts go to every task; more are joined by host.
    Without `names` the tree alone decides.
    """
    told = cut(judged(cut(counted(pages)), min_pages))
    schema = "page_id long, url string, text string, n_chars long"
    if told.count() <= ship:
        known: dict[str, tuple[dict, set]] = {}
        for r in told.collect():  # at most `ship` rows
            bits, texts = known.setdefault(r["host"], ({}, set()))
            if r["value"] is None:
                bits[r["path"]] = r["bits"]
            else:
                texts.add((r["path"], r["value"]))
        shipped = pages.sparkSession.sparkContext.broadcast(known)
        return pages.select("page_id", "url", "html").mapInArrow(_extracted(lambda batch, i, host: shipped.value.get(host, _NO_VERDICTS), names), schema)
    host = F.lower(F.coalesce(F.regexp_extract("url", r"^\s*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))
    verdicts = told.groupBy("host").agg(F.collect_list(F.struct("path", "bits", "value")).alias("verdicts"))
    joined = pages.select("page_id", "url", "html", host.alias("host")).join(verdicts, "host", "left")

    def of_row(batch, i, host):
        rows = batch.column("verdicts")[i].as_py() or ()
        return {r["path"]: r["bits"] for r in rows if r["value"] is None}, frozenset((r["path"], r["value"]) for r in rows if r["value"] is not None)

    return joined.mapInArrow(_extracted(of_row, names), schema)


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(spread(table(spark, sf_dir, "pages")))


QUERIES = {"op4_extract": op4}
