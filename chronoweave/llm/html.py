"""Main text of web pages by tree scoring.

A page becomes a tree of elements and text blocks. Elements that are never article
text (menus, forms, scripts, notices, reader comments, hidden parts) are cut, by tag
or by the words of their class, id and role. Every remaining block of running text
passes points (one, one per comma, one per 100 characters up to three) to the
containers above it: all of them to the first, half to the second, a third of that
half to the next ones. Points are discounted by the container's link density. The best
container is kept with its siblings that score or read like it, and with the
headings that stand before it; its blocks are the text, in page order.

Defined results: a null or empty page gives an empty text; so does one without text
outside the parts that are cut. Unclosed and misplaced tags, unknown elements and
pages that break off are read as far as they go. No text is cut by length.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoweave.llm.base import query, table, text_batches

# Element names of HTML, and words that mark parts of a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe noembed noframes xmp plaintext".split())
CUT = frozenset(
    "head nav footer aside form script style noscript template iframe object button select textarea svg math canvas"
    " audio video dialog menu map datalist progress meter noembed noframes title fieldset".split()
)
BLOCK = frozenset(
    "html body address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre search section summary table tbody td tfoot th thead"
    " tr ul caption".split()
)
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
LEAF = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre td th figcaption caption summary address blockquote".split())
CLOSES = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
}
MARKED = frozenset(
    "ad ads advert advertisement adverts advertising sponsor sponsored promo promotion banner nav navbar navigation menu"
    " breadcrumb breadcrumbs sidebar aside rail footer masthead comment comments commentlist disqus respond replies"
    " reply responses discussion cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe"
    " subscription signup login share sharing social related recommended recommendations outbrain taboola widget toolbar"
    " pagination pager skip copyright disclaimer alert hidden feedback".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
GOOD = frozenset("article main content post entry story body text page".split())
BONUS = {"article": 25.0, "main": 20.0, "div": 5.0, "section": 5.0, "blockquote": 3.0, "pre": 3.0, "td": 3.0, "ul": -3.0, "ol": -3.0, "dl": -3.0}

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*?)>|<[!?/][^>]*>", re.S)
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
_WORDS = re.compile(r"[a-z]+", re.I)
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

SIBLING_SHARE = 0.2  # a sibling container with this share of the best score is kept
DENSE = 0.5  # share of link text from which a sibling block counts as links


def _cut_by_attributes(text: str) -> bool:
    found = {}
    for name, value in _ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), entities.unescape(value.strip("\"'")))
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true":
        return True
    style = found.get("style", "").replace(" ", "").lower()
    if "display:none" in style or "visibility:hidden" in style or found.get("role", "").lower() in ROLES:
        return True
    named = set(w.lower() for w in _WORDS.findall(_CAMEL.sub(" ", f"{found.get('class', '')} {found.get('id', '')}")))
    return bool(named & MARKED) and not named & GOOD - {"body", "text", "page", "content"} or bool(named & {"comment", "comments", "commentlist"})


class _Page:
    """Elements as parallel lists (parents before children) and text blocks in page order."""

    def __init__(self, source: str) -> None:
        self.tag, self.parent, self.cut = ["#root"], [-1], [False]
        self.blocks: list[tuple[int, str, int]] = []  # element, text, characters of link text
        self._stack, self._names = [0], {"#root": 1}
        self._parts: list[str] = []
        self._links, self._linked = 0, 0
        self._read(source)
        self._flush()

    def _read(self, source: str) -> None:
        at, end = 0, len(source)
        while at < end:
            m = _TOKEN.search(source, at)
            if m is None:
                rest = source[at:]
                broken = rest.rfind("<")  # a page may break off inside a tag
                self._text(rest if broken < 0 or not re.match(r"</?[a-zA-Z!]", rest[broken:]) else rest[:broken])
                return
            if m.start() > at:
                self._text(source[at : m.start()])
            at = m.end()
            if not m[2]:
                continue
            name = m[2].lower()
            if m[1]:
                self._close(name)
            else:
                self._open(name, m[3])
                if name in RAW:
                    stop = re.compile(rf"</{re.escape(name)}[\s/>]", re.I).search(source, at)
                    at = stop.start() if stop else end

    def _text(self, text: str) -> None:
        if not self.cut[self._stack[-1]]:
            self._parts.append(text)
            if self._links:
                self._linked += len(text.strip())

    def _flush(self) -> None:
        if self._parts:
            text = " ".join(entities.unescape("".join(self._parts)).split())
            if text:
                block = next(e for e in reversed(self._stack) if self.tag[e] in BLOCK or e == 0)
                self.blocks.append((block, text, min(self._linked, len(text))))
            self._parts = []
        self._linked = 0

    def _open(self, name: str, attributes: str) -> None:
        if name in BLOCK:
            self._flush()
            if self._names.get("p") and name != "#root":
                self._pop_to(("p",), ("table", "td", "th", "div", "article", "section", "blockquote", "li", "button"))
        if name in CLOSES:
            self._pop_to(*CLOSES[name])
        if name == "br" or name in VOID:
            if name in ("br", "hr", "img"):
                self._parts.append(" ")
            return
        parent = self._stack[-1]
        cut = self.cut[parent] or name in CUT or (bool(attributes) and name not in ("html", "body") and _cut_by_attributes(attributes))
        if name == "header" and not cut:  # the header of an article holds its headings, that of a page is cut
            cut = not any(self.tag[e] in ("article", "main") for e in self._stack)
        self.tag.append(name)
        self.parent.append(parent)
        self.cut.append(cut)
        self._stack.append(len(self.tag) - 1)
        self._names[name] = self._names.get(name, 0) + 1
        if name == "a":
            self._links += 1

    def _pop_to(self, names: tuple[str, ...], fence: tuple[str, ...]) -> None:
        """Close the innermost of ``names`` unless an element of ``fence`` lies inside it."""
        for i in range(len(self._stack) - 1, 0, -1):
            tag = self.tag[self._stack[i]]
            if tag in names:
                self._cut_stack(i)
                return
            if tag in fence:
                return

    def _close(self, name: str) -> None:
        if not self._names.get(name):
            if name in BLOCK:
                self._flush()
            return
        at = next(i for i in range(len(self._stack) - 1, 0, -1) if self.tag[self._stack[i]] == name)
        if name not in BLOCK and any(self.tag[e] in BLOCK for e in self._stack[at + 1 :]):
            return  # a stray inline end does not close blocks
        self._cut_stack(at)

    def _cut_stack(self, at: int) -> None:
        if any(self.tag[e] in BLOCK for e in self._stack[at:]):
            self._flush()
        for e in self._stack[at:]:
            self._names[self.tag[e]] -= 1
            if self.tag[e] == "a":
                self._links -= 1
        del self._stack[at:]


def main_text(source: str | None) -> str:
    """The blocks of the main text, one per line."""
    if not source:
        return ""
    page = _Page(source)
    if not page.blocks:
        return ""
    n = len(page.tag)
    points, chars, linked = [0.0] * n, [0] * n, [0] * n
    for element, text, links in page.blocks:
        chars[element] += len(text)
        linked[element] += links
        tag = page.tag[element]
        if tag in HEADING:
            continue
        container = page.parent[element] if tag in LEAF and page.parent[element] >= 0 else element
        worth = (1.0 + text.count(",") + min(len(text) / 100, 3.0)) * (1.0 - links / len(text))
        share = 1.0
        level = 0
        while container > 0 and level < 5:
            points[container] += worth * share
            level += 1
            share = 0.5 if level == 1 else 0.5 / (1.5 * level)
            container = page.parent[container]
    for e in range(n - 1, 0, -1):  # parents come first, so this sums whole subtrees
        chars[page.parent[e]] += chars[e]
        linked[page.parent[e]] += linked[e]
    scores = {
        e: (points[e] + BONUS.get(page.tag[e], 0.0)) * (1.0 - linked[e] / chars[e]) for e in range(1, n) if points[e] > 0
    }
    if not scores:
        return "\n".join(text for _, text, _ in page.blocks)
    best = max(scores, key=lambda e: (scores[e], -e))
    outer = page.parent[best]
    while outer > 0:  # an article is kept whole
        if page.tag[outer] == "article" or (page.tag[outer] == "main" and page.tag[best] != "article"):
            best = outer
        outer = page.parent[outer]
    above = page.parent[best]
    limit = max(1.0, scores.get(best, 0.0) * SIBLING_SHARE)
    kept = {best}
    for e in range(1, n):
        if page.parent[e] != above or e == best or page.cut[e] or not chars[e]:
            continue
        density = linked[e] / chars[e]
        if page.tag[e] in HEADING or page.tag[e] in ("header", "hgroup"):
            if e < best:
                kept.add(e)
        elif density < DENSE and (page.tag[e] in LEAF - HEADING and page.tag[e] != "li" or scores.get(e, 0.0) >= limit):
            kept.add(e)
    inside = [False] * n
    for e in range(1, n):
        inside[e] = e in kept or inside[page.parent[e]]
    return "\n".join(text for element, text, _ in page.blocks if inside[element])


def extract_text(pages: DataFrame, html: str = "html", out: str = "text") -> DataFrame:
    """The pages with the main text of ``html`` in ``out``, in place of that column; no shuffle."""
    kept = [c for c in pages.columns if c not in (html, out)]
    schema = T.StructType([*(pages.schema[c] for c in kept), T.StructField(out, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, "__html"):
            texts = [main_text(x) for x in batch.column("__html").to_pylist()]
            columns = [batch.column(c) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], [*kept, out])

    picked = pages.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{html}`").alias("__html"))
    return picked.mapInArrow(run, schema)


@query("op1_html_text")
def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = extract_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return texts.withColumn("n_chars", F.length("text").cast("long"))
