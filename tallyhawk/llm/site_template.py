"""HTML extraction with site template removal.

First pass: every page's element subtrees are hashed twice, with their texts
and by their shape alone (tags, class names, kinds of children); Spark counts
on how many distinct pages of a host each hash occurs (pages with equal main
elements are one page, so a copied article is no template).  Second pass:
subtrees that recur on a large share of the host's pages are deleted.  A
subtree that recurs with its text goes anywhere, inside the main element as
well as outside; one that recurs by shape, such as a menu or an advert whose
words change from page to page, goes outside the page's main content only.
Elements that are never part of an article (menus, forms, adverts, reader
comments, ...) are skipped, and the text of the remaining main element is read
block by block.

A host has at most (mean subtrees per page) / SHARE recurring subtrees, so
their hashes come back to the pages as one short array per host.
"""

from __future__ import annotations

import functools
import hashlib
import html as entities
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhawk.llm.common import cut, join_lookup, table

#: A subtree on more than this share of a host's distinct pages, and on so many
#: of them at least (more than a pair), is part of the site's template.
SHARE, LEAST_PAGES = 0.5, 3

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)(?:>|\Z)",
    re.S,
)
_ATTR = re.compile(r"(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "noframes", "xmp"}
_VOID = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr",
}
_BLOCK = {
    "address", "article", "aside", "blockquote", "body", "button", "canvas", "caption", "center", "dd", "details",
    "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4",
    "h5", "h6", "head", "header", "hgroup", "html", "legend", "li", "main", "menu", "nav", "object", "ol", "option",
    "optgroup", "p", "pre", "search", "section", "select", "summary", "svg", "table", "tbody", "td", "tfoot", "th",
    "thead", "tr", "ul", "video", "audio",
}
#: Never part of an article's text.
_DROP = {
    "script", "style", "textarea", "title", "noscript", "template", "iframe", "noframes", "xmp", "head", "nav", "footer",
    "aside", "form", "button", "select", "option", "optgroup", "fieldset", "menu", "dialog", "svg", "canvas", "object",
    "audio", "video", "search", "header",
}
_DROP_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu", "menubar"}
#: Words that name such a part, and words that may stand beside them in a name.
_DROP_NAMES = set(
    "ad ads advert adverts advertisement advertisements adsense adbox adunit adslot adbanner sponsor sponsored sponsors promo promos promotion"
    " promotions banner cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription"
    " paywall signup login nav navbar navigation menu sidebar aside widget widgets breadcrumb breadcrumbs crumbs pagination pager"
    " share sharing social related recommended comment comments commentlist respond reply replies disqus footer masthead topbar"
    " toolbar copyright legal disclaimer skip".split()
)
_BESIDE = set(
    "area article articles bar block body box btn button buttons container content form global group header holder icon icons"
    " item items left link links list main media message panel page post posts primary right row secondary section side site slot"
    " teaser teasers text thread top bottom unit wrap wrapper".split()
)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
#: Headings and paragraphs are judged by their text, never by a name.
_UNNAMED = {"html", "body", "main", "h1", "h2", "h3", "h4", "h5", "h6", "p", "li", "blockquote", "pre", "figure", "figcaption"}
#: Prose goes with its text only: its shape is that of any other paragraph.
_PROSE = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "figure", "figcaption", "html", "body", "main", "article"}


def names_a_part(value: str) -> bool:
    """Whether one of the names is made of words that name a part of the site
    (and words that may stand beside them): ``post-comments``, ``cookieNotice``."""
    for name in value.split():
        words = [w.lower() for w in _PART.findall(name)]
        if any(w in _DROP_NAMES for w in words) and all(w in _DROP_NAMES or w in _BESIDE for w in words):
            return True
    return False


#: What an open element of the key ends when it starts.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
    "thead": ({"tr", "td", "th"}, {"table"}),
    "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"tbody", "tr", "td", "th"}, {"table"}),
}


class Page:
    """Block elements of a page in page order: tag, parent, whether skipped,
    and items (text or the number of a child)."""

    def __init__(self, source: str, lists: bool = True):
        self.tags, self.parents, self.skip, self.items, self.mains = ["#"], [0], [False], [[]], []
        self.classes = [""]
        self.lists = lists  # whether tags, roles and names decide
        self.open = [0]
        self.standing = Counter()  # open elements by tag
        self._parse(source)

    def _add(self, tag: str, skipped: bool, classes: str) -> None:
        parent, n = self.open[-1], len(self.tags)
        self.tags.append(tag)
        self.parents.append(parent)
        self.skip.append(skipped)
        self.classes.append(classes)
        self.items.append([])
        self.items[parent].append(n)
        self.open.append(n)
        self.standing[tag] += 1

    def _pop(self, at: int) -> None:
        for n in self.open[at:]:
            self.standing[self.tags[n]] -= 1
        del self.open[at:]

    def _text(self, text: str) -> None:
        if text:
            self.items[self.open[-1]].append(entities.unescape(text) if "&" in text else text)

    def _end(self, tags: set, stop: set) -> None:
        if not any(self.standing[t] for t in tags):
            return
        for at in range(len(self.open) - 1, 0, -1):
            tag = self.tags[self.open[at]]
            if tag in tags:
                self._pop(at)
                return self._end(tags, stop)
            if tag in stop:
                return None
        return None

    def _start(self, tag: str, attrs: str, closed: bool) -> None:
        skipped = tag in _DROP
        role = classes = ""
        if attrs:
            for m in _ATTR.finditer(attrs):
                name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
                if name == "role":
                    role = value.lower()
                    skipped |= role in _DROP_ROLES
                elif name == "hidden":
                    skipped |= attrs[m.start() - 1 : m.start()].isspace()
                elif name == "aria-hidden":
                    skipped |= value.lower() == "true"
                elif name == "class" or tag == "div":  # an id counts on a div only
                    classes += f" {value}"
                    skipped |= tag not in _UNNAMED and names_a_part(value)
        skipped &= self.lists or tag in _RAW or tag == "head"
        above = self.open[-1]
        if tag not in _BLOCK and not skipped and not (self.skip[above] and self.tags[above] == tag):
            return
        if tag in _BLOCK:
            if any(self.tags[i] == "p" for i in self.open[-3:]):
                self._end({"p"}, set(_BLOCK) - {"p"})
            if tag in _ENDS:
                self._end(*_ENDS[tag])
        if tag in ("main", "article") or role == "main":
            self.mains.append(len(self.tags))
        self._add(tag, skipped, " ".join(sorted(classes.split())))
        if closed or tag in _VOID:
            self._pop(len(self.open) - 1)

    def _close(self, tag: str) -> None:
        if self.standing[tag]:
            for at in range(len(self.open) - 1, 0, -1):
                if self.tags[self.open[at]] == tag:
                    return self._pop(at)
        return None

    def _parse(self, source: str) -> None:
        at = 0
        while True:
            m = _TOKEN.search(source, at)
            if m is None:
                self._text(source[at:])
                return
            self._text(source[at : m.start()])
            at = m.end()
            if m["cdata"]:
                self.items[self.open[-1]].append(m["cdata"])
            tag = m["tag"] or m["tag2"]
            if not tag:
                continue
            tag = tag.lower()
            attrs = m["attrs"] if m["tag"] else m["attrs2"]
            if m["end"] or m["end2"]:
                self._close(tag)
            elif tag in _VOID:
                if tag in ("br", "hr"):
                    self.items[self.open[-1]].append(" ")
            elif tag in _RAW:
                end = re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(source, at)
                at = end.end() if end else len(source)
            else:
                self._start(tag, attrs, attrs.endswith("/") and tag not in _BLOCK)

    def digests(self) -> list[bytes]:
        """64-bit hash of every subtree (tag, text, children), b'' if it has no text."""
        out = [b""] * len(self.tags)
        for n in range(len(self.tags) - 1, 0, -1):
            parts = []
            for x in self.items[n]:
                part = out[x] if isinstance(x, int) else " ".join(x.split()).encode("utf-8", "replace")
                if part:
                    parts.append(part)
            if parts:
                out[n] = hashlib.blake2b(b"\x00".join([self.tags[n].encode(), *parts]), digest_size=8).digest()
        return out

    def shapes(self) -> list[bytes]:
        """64-bit hash of the shape of every subtree that may go by its shape
        (b'' for the others): tag, class names and the kinds of its children."""
        size, main = [0] * len(self.tags), [False] * len(self.tags)
        for n in self.mains:
            main[n] = True
        out = [b""] * len(self.tags)
        for n in range(len(self.tags) - 1, 0, -1):
            size[n] += sum(len(x) for x in self.items[n] if isinstance(x, str))
            size[self.parents[n]] += size[n]
            main[self.parents[n]] |= main[n]
            kinds = {out[x] if isinstance(x, int) else b"text" for x in self.items[n] if isinstance(x, int) or not x.isspace()}
            told = [b"shape", self.tags[n].encode(), self.classes[n].encode("utf-8", "replace"), *sorted(kinds)]
            out[n] = hashlib.blake2b(b"\x00".join(told), digest_size=8).digest()
        whole = size[0] + sum(len(x) for x in self.items[0] if isinstance(x, str))
        inside = [False] * len(self.tags)
        for n in range(1, len(self.tags)):
            inside[n] = inside[self.parents[n]] or n in self._main_set
        return [
            b"" if n == 0 or main[n] or inside[n] or self.tags[n] in _PROSE or 2 * size[n] > whole else h for n, h in enumerate(out)
        ]

    @functools.cached_property
    def _main_set(self) -> set[int]:
        return set(self.mains)

    def roots(self, gone: list) -> list[int]:
        """The outermost main elements that are not gone."""
        inside = [False] * len(self.tags)
        mains = set(self.mains)
        found = []
        for n in range(1, len(self.tags)):
            above = inside[self.parents[n]]
            inside[n] = above or (n in mains and not gone[n])
            if inside[n] and not above:
                found.append(n)
        return found

    def _gone(self, template: set, hashes: list[bytes]) -> list[bool]:
        gone = list(self.skip)
        shapes = self.shapes() if template else []
        for n in range(1, len(self.tags)):
            gone[n] |= gone[self.parents[n]] or (bool(template) and (hashes[n] in template or shapes[n] in template))
        return gone

    def key(self, hashes: list[bytes]) -> bytes:
        """Equal for pages with equal main elements (with equal blocks if they name none)."""
        parts = self.roots(self._gone(set(), hashes)) or self.items[0]
        told = [hashes[x] if isinstance(x, int) else x.encode("utf-8", "replace") for x in parts]
        return hashlib.blake2b(b"\x00".join(told), digest_size=16).digest()

    def text(self, template: set) -> str:
        """Blocks of the main elements (of the whole page if it names none)."""
        gone = self._gone(template, self.digests() if template else [])
        roots = self.roots(gone)
        if template and not roots and self.roots(self._gone(set(), [])):
            return self.text(set())  # every main element recurs: the page has no other content
        roots = roots or [0]
        blocks: list[str] = []
        for root in roots:
            stack: list = [(root, 0, [])]
            while stack:
                n, at, run = stack.pop()
                items = self.items[n]
                while at < len(items):
                    x = items[at]
                    at += 1
                    if isinstance(x, str):
                        run.append(x)
                    elif gone[x] and self.tags[x] not in _BLOCK:
                        continue
                    else:
                        blocks.append("".join(run))
                        run = []
                        if not gone[x]:
                            stack.append((n, at, run))
                            stack.append((x, 0, []))
                            break
                else:
                    blocks.append("".join(run))
        return "\n".join(b for b in (" ".join(b.split()) for b in blocks) if b)


def _host():
    return F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))


def site_templates(pages: DataFrame, share: float = SHARE, least: int = LEAST_PAGES) -> DataFrame:
    """host, template (array of subtree hashes): the subtrees on more than
    ``share`` of the host's distinct pages, on ``least`` at least."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                keys, found = [], []
                for source in part.column("html").to_pylist():
                    page = Page(source or "")
                    hashes = page.digests()
                    keys.append(page.key(hashes))
                    found.append(sorted({h for h in hashes if h} | {h for h in page.shapes() if h} | {b""}))  # b'' stands for the page
                yield pa.RecordBatch.from_arrays(
                    [part.column("host"), pa.array(keys, pa.binary()), pa.array(found, pa.list_(pa.binary()))],
                    ["host", "key", "hashes"],
                )

    rows = pages.select(_host().alias("host"), "html").where("host <> ''")
    counts = cut(
        rows.mapInArrow(run, "host string, key binary, hashes array<binary>")
        .select("host", "key", F.explode("hashes").alias("hash"))
        .distinct()
        .groupBy("host", "hash")
        .agg(F.count("*").alias("on"))
        .where(F.col("on") >= least)
    )
    totals = counts.where("hash = X''").select("host", F.col("on").alias("pages"))
    return (
        join_lookup(counts.where("hash <> X''"), totals, "host", "inner")
        .where(F.col("on") > F.lit(share) * F.col("pages"))
        .groupBy("host")
        .agg(F.collect_list("hash").alias("template"))
    )


def extract_text(pages: DataFrame, share: float = SHARE, least: int = LEAST_PAGES) -> DataFrame:
    """page_id, url, text, n_chars of every row.

    Main text: the outermost main or article elements, else the whole page,
    without skipped elements and the host's template, inside an article too.  A
    page all of whose main elements recur keeps them whole.  Null or empty
    html gives an empty text.  A null or odd url has no host and no template.
    Pages of a host with equal main elements count as one; each row gets its
    text; other columns are ignored.
    """
    found = cut(site_templates(pages, share, least)).withColumnRenamed("host", "t_host")
    rows = pages.select("page_id", "url", "html", _host().alias("host"))
    joined = join_lookup(rows, found, F.col("host") == F.col("t_host"), "left").select("page_id", "url", "html", "template")

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [
                    Page(source).text(set(template or ())) if source else ""
                    for source, template in zip(part.column("html").to_pylist(), part.column("template").to_pylist())
                ]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                    ["page_id", "url", "text", "n_chars"],
                )

    kind = pages.schema["page_id"].dataType.simpleString()
    return joined.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars bigint")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))
