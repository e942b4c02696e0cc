"""Operator 4: main text of web pages by composite text density.

After Sun, Song and Liao, "DOM based content extraction via text density" (2011). A page
is read into a tree as browsers do it in the cases that matter for text (raw text of
scripts, void elements, implied ends, missing and stray end tags). Elements that are not
part of an article by their kind, role or class are taken out; of the rest, every node
gets its characters per tag, weighed down by the share of its links:

    density = C/T * log_b(C/LC * T/LT),  b = ln(C/(C-LC) * LC + LC_body/C_body * C + e)

for its characters C, tags T, link characters LC and link tags LT (zero counts as one).
A node's density sum adds the densities of its children and its own text. The node with
the largest sum leads the selection; the least density on its path to the body is the
threshold; in every node that reaches it, the subtree of largest sum is content. Where the
leading node lies in an ``article`` or ``main`` element, that element is the content.

Text is given by blocks: white space becomes one blank, blocks are joined by line feeds.

Defined cases: NULL, empty and text-less html gives the empty text; plain text without tags is
content; pages of any length and depth are read whole; rows with equal ids are rows of
their own; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import table, text_chunks
from .registry import query

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(\"[^\"]*\"?|'[^']*'?|[^\s>]+))?")
_TOKEN = re.compile(r"[a-z]+|[A-Z][a-z]*")

# Kinds of HTML elements.
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_RAW = set("script style xmp iframe noembed noframes textarea title".split())
_INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark meter "
    "nobr output q rp rt ruby s samp small span strike strong sub sup time tt u var wbr "
    "script style template link meta input button select textarea svg object embed audio video iframe canvas".split()
)
_ENDS_P = set(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
)
# An opening tag ends an open element of these kinds, up to the given container.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
    "body": ({"head"}, {"html"}),
}
_SCOPE = set("html body article section div table td th ul ol main form".split())

# What an article is not made of.
_NEVER = set(
    "head script style noscript template iframe object embed applet svg canvas audio video "
    "nav footer aside menu select button textarea input dialog noembed noframes datalist".split()
)
_MAYBE = {"form", "header"}
_ROLES = set(
    "navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar "
    "toolbar status".split()
)
_WORDS = set(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo "
    "promotion cookie cookies consent gdpr notice notices alert popup modal overlay newsletter "
    "subscribe subscription signup login share sharing social related recommended recommendations "
    "sidebar menu nav navbar navigation breadcrumb breadcrumbs pagination pager footer header masthead "
    "comment comments disqus respond reply replies widget toolbar search copyright skip".split()
)
_TITLED = {"article", "post", "entry", "story", "content", "title", "page", "main"}
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}


def _attributes(text: str) -> dict[str, str]:
    found = {}
    for name, value in _ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), html.unescape(value.strip("\"'")))
    return found


def _doubt(tag: str, attributes: str) -> int:
    """2: never content; 1: no content unless it holds the article; 0: may be content."""
    if tag in _NEVER:
        return 2
    doubt = int(tag in _MAYBE)
    if not attributes or tag in ("html", "body", "main"):
        return doubt
    own = _attributes(attributes)
    if "hidden" in own or own.get("aria-hidden", "").lower() == "true" or own.get("role", "").lower() in _ROLES:
        return max(doubt, 1)
    style = own.get("style", "").replace(" ", "").lower()
    if "display:none" in style or "visibility:hidden" in style:
        return 1
    named = f"{own.get('class', '')} {own.get('id', '')}"
    if named.strip():
        tokens = {t.lower() for t in _TOKEN.findall(named)}
        hits = tokens & _WORDS
        if hits == {"header"} and tokens & _TITLED:
            hits = set()
        return max(doubt, int(bool(hits)))
    return doubt


class _Page:
    """The tree of a page as lists in document order; a parent precedes its children."""

    def __init__(self, source: str):
        self.parent, self.tag, self.doubt = [-1], ["#root"], [0]
        self.texts: list[tuple[int, int, str]] = []  # node, block, text
        self._open, self._block = [0], 0
        at = 0
        while found := _TAG.search(source, at):
            self._add_text(source[at : found.start()])
            at = found.end()
            tag = found[2] or found[5]
            if tag is None:
                continue
            tag = tag.lower()
            if found[1] or found[4]:
                self._end(tag)
                continue
            attributes = found[3] if found[2] else found[6]
            self._start(tag, attributes)
            if tag in _RAW:
                end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(source, at)
                at = end.start() if end else len(source)
        self._add_text(source[at:])

    def _add_text(self, text: str) -> None:
        if text:
            self.texts.append((self._open[-1], self._block, text))

    def _pop_to(self, kinds: set[str], stop: set[str]) -> None:
        for depth in range(len(self._open) - 1, 0, -1):
            tag = self.tag[self._open[depth]]
            if tag in kinds:
                del self._open[depth:]
                self._block += 1
                return
            if tag in stop:
                return

    def _start(self, tag: str, attributes: str) -> None:
        if tag in _ENDS_P:
            self._pop_to({"p"}, _SCOPE)
        if tag in _ENDS:
            self._pop_to(*_ENDS[tag])
        if tag in _HEADINGS and self.tag[self._open[-1]] in _HEADINGS:
            self._open.pop()
        if tag not in _INLINE:
            self._block += 1
        if tag == "br":
            self._add_text(" ")
        self.parent.append(self._open[-1])
        self.tag.append(tag)
        self.doubt.append(_doubt(tag, attributes))
        if tag not in _VOID and not attributes.endswith("/"):
            self._open.append(len(self.tag) - 1)

    def _end(self, tag: str) -> None:
        if tag not in _INLINE:
            self._block += 1
        for depth in range(len(self._open) - 1, 0, -1):
            own = self.tag[self._open[depth]]
            if own == tag:
                del self._open[depth:]
                return
            # A stray end of an inline element does not end blocks.
            if tag in _INLINE and own not in _INLINE:
                return


def _density(c: int, t: int, lc: int, lt: int, body_share: float) -> float:
    if not c:
        return 0.0
    t, links, plain = max(t, 1), max(lc, 1), max(c - lc, 1)
    base = math.log(c / plain * lc + body_share * c + math.e)
    value = c / t * math.log(max(c / links * t / max(lt, 1), 1.0)) / max(math.log(base), 0.5)
    return max(value, 0.0)


def main_text(source: str | None) -> str:
    page = _Page(source or "")
    n, parent, tag = len(page.tag), page.parent, page.tag
    own, own_links, inside = [0] * n, [0] * n, [False] * n
    for i in range(1, n):
        inside[i] = inside[parent[i]] or tag[i] == "a"
    clean: list[tuple[int, int, str]] = []
    for node, block, text in page.texts:
        if "&" in text:
            text = html.unescape(text)
        clean.append((node, block, text))
        size = len("".join(text.split()))
        own[node] += size
        if inside[node]:
            own_links[node] += size

    def summed(values: list[int]) -> list[int]:
        out = list(values)
        for i in range(n - 1, 0, -1):
            out[parent[i]] += out[i]
        return out

    # What is not content: sure by kind, or doubtful and without the page's article.
    dead = [False] * n
    for i in range(1, n):
        dead[i] = dead[parent[i]] or page.doubt[i] == 2
    alive = summed([0 if dead[i] else own[i] for i in range(n)])
    holds = summed([int(tag[i] in ("article", "main") and not dead[i]) for i in range(n)])
    titled = summed([int(tag[i] == "h1") for i in range(n)])
    within = [False] * n
    for i in range(1, n):
        up = parent[i]
        within[i] = within[up] or tag[up] in ("article", "main")
        if dead[up]:
            dead[i] = True
        elif page.doubt[i] == 1 and not dead[i]:
            holder = holds[i] > int(tag[i] in ("article", "main"))
            holder |= not holds[0] and 2 * alive[i] > alive[0]
            title = tag[i] == "header" and within[i] and titled[i] > 0
            dead[i] = not (holder or title)

    body = next((i for i in range(n) if tag[i] == "body"), 0)
    chars_all, links_all = summed(own), summed(own_links)
    share = links_all[body] / max(chars_all[body], 1)
    live = [not d for d in dead]
    chars = summed([own[i] * live[i] for i in range(n)])
    link_chars = summed([own_links[i] * live[i] for i in range(n)])
    tags = summed([int(live[i]) for i in range(n)])
    link_tags = summed([int(live[i] and tag[i] == "a") for i in range(n)])
    if not chars[0]:
        return ""
    density = [
        _density(chars[i], tags[i] - 1, link_chars[i], link_tags[i], share) if live[i] else 0.0 for i in range(n)
    ]
    sums = [0.0] * n
    for i in range(n):
        if live[i]:
            plain = own[i] - own_links[i]
            sums[i] += _density(plain, 1, 0, 0, share)
            if i:
                sums[parent[i]] += density[i]
    # Of equal sums the outermost node leads.
    lead = max(range(n), key=lambda i: (sums[i], -i))
    node = lead
    article, least = None, density[lead]
    while node > 0 and node != body:
        if tag[node] in ("article", "main"):
            article = node
        least = min(least, density[node])
        node = parent[node]
    least = min(least, density[node])
    chosen = [False] * n
    if article is not None:
        chosen[article] = True
    else:
        best = list(range(n))
        for i in range(n - 1, 0, -1):
            if live[i] and sums[best[i]] >= sums[best[parent[i]]]:
                best[parent[i]] = best[i]
        chosen[lead] = True
        for i in range(n):
            if live[i] and chars[i] and density[i] >= least:
                chosen[best[i]] = True
    for i in range(1, n):
        chosen[i] = chosen[i] or chosen[parent[i]]
    blocks: list[tuple[int, list[str]]] = []
    for node, block, text in clean:
        if chosen[node] and live[node]:
            if not blocks or blocks[-1][0] != block:
                blocks.append((block, []))
            blocks[-1][1].append(text)
    lines = (" ".join("".join(parts).split()) for _, parts in blocks)
    return "\n".join(line for line in lines if line)


_RESULT = "page_id long, url string, text string, n_chars long"


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, "html"):
            found = [main_text(h) for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"), batch.column("url"), pa.array(found, pa.string()),
                    pa.array([len(t) for t in found], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

    source = pages.selectExpr("cast(page_id AS long) page_id", "url", "html")
    return source.mapInArrow(run, _RESULT)


@query("op4_text_density")
def op4_text_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
