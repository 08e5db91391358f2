"""Main-text extraction from HTML by scoring the page's tree.

Each page is parsed into a light tree of its block elements.  Boilerplate
elements by tag or role are left out with all they hold.  A word of a class or id only makes
an element suspect: its points count a fifth and go no further than itself.  It is
left out where it stands inside the kept elements, unless it holds the best container or most
of the unlinked text (nearly all of it, for reader comments).  A name that takes
the word back (``no-sidebar``, ``ad-free``, ``has-share``) means nothing.
Every paragraph passes points, one plus its commas and its length in
hundreds up to three, to its parent, half of them to the grandparent and less to
higher ancestors; an element's points are discounted by the share of its text
that stands in links.  The best element, or the article around it, is kept,
with siblings that score a fifth of it.  The text of the kept elements comes out in page order.

A page is parsed inside one task from start to end, in time linear in its length;
nothing is cut off.  Defined cases: of equally good elements the first in page order is the best; a null or empty page gives an empty text, as does a page with nothing
but boilerplate; an unfinished tag at the end is dropped, unclosed elements end with
the page; repeated rows give the same result each.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names of HTML and words that sites use for what is not the article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
                   "span strike strong sub sup time tt u var wbr".split())
BOILERPLATE = frozenset("head nav header footer aside form script style noscript iframe template svg math button select textarea "
                        "title menu dialog object embed canvas noembed noframes xmp video audio".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
WORDS = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar menu nav navbar navigation "
                  "breadcrumb breadcrumbs footer comment comments disqus replies cookie cookies consent gdpr notice notices newsletter "
                  "subscribe signup share sharing social related recommended popup modal overlay widget toolbar pager pagination".split())
COMMENTS = frozenset("comment comments disqus replies".split())
TAKES_BACK = frozenset("no not non without hide hides hidden has with free less off none disabled".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
                     "hr main menu nav ol p pre section table ul".split())
SAME_CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
               "option": ("option",), "thead": ("tr", "td", "th"), "tbody": ("tr", "td", "th", "thead"), "tfoot": ("tr", "td", "th", "tbody")}
LIST_SCOPE = frozenset("ul ol dl table menu".split())
WEIGHT = {"article": 10, "main": 10, "div": 5, "section": 5, "pre": 3, "td": 3, "blockquote": 3, "form": -3, "ul": -3, "ol": -3, "dl": -3,
          "li": -3, "dd": -3, "dt": -3, "address": -3, "h1": -5, "h2": -5, "h3": -5, "h4": -5, "h5": -5, "h6": -5, "th": -5}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
HOLDERS = frozenset("div section article main body html td center root".split())
SAFE = frozenset("html body article main root".split())

TOKEN = re.compile(r"""<(?:!--(?P<comment>.*?)(?:-->|\Z)|(?P<end>/)?(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>"']|"[^"]*"|'[^']*')*+)>"""
                   r"""|(?P<odd>/?[a-zA-Z][^>]*>)|[!?/][^>]*>|(?P<cut>/?[a-zA-Z!?][^>]*\Z))""", re.S)
ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
SPLIT = re.compile(r"[\s_:-]+")


#: Share of its points that a suspect element keeps, and the share of the unlinked text that saves it.
SUSPECT_POINTS = 0.2
SAVES, SAVES_COMMENTS = 0.5, 0.9


def _is_boilerplate(name: str, attrs: str) -> bool:
    """Whether an element goes by its tag or role."""
    if name in BOILERPLATE:
        return True
    return name not in SAFE and "=" in attrs and any(
        key.lower() == "role" and any(w in ROLES for w in SPLIT.split(max(values, key=len).lower())) for key, *values in ATTRIBUTE.findall(attrs))


def _suspect(name: str, attrs: str) -> float:
    """0, or the share of the text that an element has to hold in spite of its class or id."""
    if name in SAFE or "=" not in attrs:
        return 0.0
    found = 0.0
    for key, *values in ATTRIBUTE.findall(attrs):
        if key.lower() != "role":
            for one in max(values, key=len).lower().split():
                words = SPLIT.split(one)
                if not TAKES_BACK.intersection(words):
                    if COMMENTS.intersection(words):
                        return SAVES_COMMENTS
                    if WORDS.intersection(words):
                        found = SAVES
    return found


class _Tree:
    """Block elements of a page, in page order, with the text pieces that stand in them."""

    def __init__(self, page: str):
        self.tag, self.parent, self.suspect = ["root"], [-1], [0.0]
        self.own, self.linked, self.commas = [0], [0], [0]
        self.pieces: list[tuple[int, int, str]] = []     # (element, block number, text)
        # open elements: (name, element or -1, inside boilerplate), where each name is open, and the open elements
        self.stack = [("root", 0, False)]
        self.open: dict[str, list[int]] = {"root": [0]}
        self.nodes = [0]
        self.blocks = [0]                                # places of the open elements that are not inline
        self.block = 0
        at, size = 0, len(page)
        while at < size:
            m = TOKEN.search(page, at)
            if m is None:
                self._text(page[at:])
                break
            if m.start() > at:
                self._text(page[at:m.start()])
            at = m.end()
            name = (m["name"] or "").lower()
            if not name:
                if m["odd"] and not m["odd"].startswith("/"):     # quotes that never close
                    name = re.match(r"[^\s/>]+", m["odd"])[0].lower()
                    at = self._start(name, "", page, at)
                continue
            if m["end"]:
                self._end(name)
            else:
                at = self._start(name, m["attrs"], page, at)

    def _text(self, text: str) -> None:
        if self.stack[-1][2]:
            return
        text = html.unescape(text)
        node = self.nodes[-1]
        self.pieces.append((node, self.block, text))
        n = len(text) if not text.isspace() else 0
        self.own[node] += n
        self.commas[node] += text.count(",")
        if self.open.get("a"):
            self.linked[node] += n

    def _pop(self) -> None:
        name, node, _ = self.stack.pop()
        self.open[name].pop()
        if node >= 0:
            self.nodes.pop()
        if name not in INLINE:
            self.blocks.pop()
            self.block += 1

    def _close(self, names, scope=frozenset()) -> None:
        """Close the innermost open element of these names, unless one of ``scope`` stands before it."""
        place = max((self.open[n][-1] for n in names if self.open.get(n)), default=0)
        if place > max((self.open[n][-1] for n in scope if self.open.get(n)), default=0):
            while len(self.stack) > place:
                self._pop()

    def _start(self, name: str, attrs: str, page: str, at: int) -> int:
        if name in CLOSES_P:
            self._close(("p",), frozenset(("button", "table", "td")))
        if name in SAME_CLOSES:
            self._close(SAME_CLOSES[name], LIST_SCOPE)
        if name not in INLINE:
            self.block += 1
        if name in VOID:
            return at
        bad = self.stack[-1][2] or _is_boilerplate(name, attrs)
        if name in RAW:        # its content is text until its end tag
            m = re.compile(f"</{name}(?=[\\s/>])[^>]*>", re.I).search(page, at)
            return m.end() if m else len(page)
        if attrs.rstrip().endswith("/") and name in ("svg", "path"):
            return at
        suspect = 0.0 if bad else _suspect(name, attrs)
        node = -1
        if not bad and (suspect or name not in INLINE):
            node = len(self.tag)
            self.parent.append(self.nodes[-1])
            self.tag.append(name)
            self.suspect.append(suspect)
            self.nodes.append(node)
            for x in (self.own, self.linked, self.commas):
                x.append(0)
        self.open.setdefault(name, []).append(len(self.stack))
        if name not in INLINE:
            self.blocks.append(len(self.stack))
        self.stack.append((name, node, bad))
        return at

    def _end(self, name: str) -> None:
        if name == "br":
            self.block += 1
        elif self.open.get(name) and name != "root":
            # an inline element ends only inside its block
            if name in INLINE and self.open[name][-1] < self.blocks[-1]:
                return
            self._close((name,))


def _scores(tree: _Tree) -> tuple[list[float], list[int]]:
    """(score, unlinked text) of every element; suspect ones pass nothing on."""
    n = len(tree.tag)
    length, linked = list(tree.own), list(tree.linked)
    for i in range(n - 1, 0, -1):
        if not tree.suspect[i]:
            length[tree.parent[i]] += length[i]
            linked[tree.parent[i]] += linked[i]
    inside = [False] * n
    for i in range(1, n):
        inside[i] = bool(tree.suspect[i]) or inside[tree.parent[i]]
    score = [0.0] * n
    for i in range(n):
        if not tree.own[i] or tree.tag[i] in HEADINGS:
            continue
        points = tree.commas[i] + min(tree.own[i] / 100, 3.0) + (tree.own[i] >= 25)
        points *= (1 - tree.linked[i] / tree.own[i]) * (SUSPECT_POINTS if inside[i] else 1)
        at = i if tree.tag[i] in HOLDERS or tree.suspect[i] else tree.parent[i]
        level = 0
        while at >= 0 and level < 6:
            score[at] += points / (1 if level == 0 else 2 if level == 1 else 3 * level)
            if tree.suspect[at]:
                break
            at, level = tree.parent[at], level + 1
    unlinked = [a - b for a, b in zip(tree.own, tree.linked, strict=True)]
    for i in range(n - 1, 0, -1):
        unlinked[tree.parent[i]] += unlinked[i]
    return [(s + WEIGHT.get(tree.tag[i], 0)) * (1 - linked[i] / length[i]) if s > 0 and length[i] else 0.0 for i, s in enumerate(score)], unlinked


def main_text(page: str) -> str:
    """The text of the page's article."""
    tree = _Tree(page)
    score, unlinked = _scores(tree)
    n = len(tree.tag)
    best = max(range(n), key=score.__getitem__)
    if score[best] <= 0:       # nothing scores: an article if there is one, else the whole page
        best = next((i for i in range(n) if tree.tag[i] in ("article", "main")), 0)
    around, at = {best}, best  # the best container and all that holds it
    while at > 0:
        at = tree.parent[at]
        around.add(at)
    at = best
    while at > 0:              # the article around the best container
        if tree.tag[at] in ("article", "main"):
            best = at
            break
        at = tree.parent[at]
    roots = {best}
    if tree.tag[best] not in SAFE:
        bar = max(10.0, score[best] / 5)
        roots |= {i for i in range(n) if tree.parent[i] == tree.parent[best]
                  and (score[i] >= bar or tree.tag[i] == "p" and tree.own[i] >= 80 and tree.linked[i] < tree.own[i] / 4)}
    keep = [False] * n
    whole = unlinked[best]
    for i in range(n):
        keep[i] = i in roots or i > 0 and keep[tree.parent[i]]
        if tree.suspect[i] and i not in around and unlinked[i] <= tree.suspect[i] * whole:
            keep[i] = False
    out, last = [], None
    for node, block, text in tree.pieces:
        if keep[node]:
            if block != last:
                out.append(" ")
            out.append(text)
            last = block
    return " ".join("".join(out).split())


def _rows(batches):
    for batch in batches:
        texts = [main_text(p.as_py()) if p.is_valid and len(p.as_buffer()) else "" for p in batch.column("html")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars (code points) of every row of ``pages``."""
    return pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).alias("html")).mapInArrow(
        _rows, "page_id long, url string, text string, n_chars long")
