"""Main text of web pages by tag-path ratios.

A page's text nodes are grouped by their root-to-leaf tag path (tags with their
classes). Each path gets its blocks' lengths, punctuation and share of link text; two
ratios follow: logarithm of text per block, and of punctuation per block, both damped
by links. The ratios are smoothed over the paths below the same parent and its
parent, fused by their product, and paths at or above a share of the middle ratio are
content. Text in navigation, headers and footers of the page, asides, forms,
scripts, styles, adverts and reader comments is no candidate, nor is that of elements with a
whole class token or id that names a menu, sidebar or notice, unless their punctuated
text is much of the page's unlinked text; where an article
or main part holds no less unlinked text than there is punctuated outside, only text inside it is, and there every path with unlinked text is
content.

Blocks are the runs of text between block-level tags. Content blocks keep page
order.

Defined results. Null or empty page: empty text. A page without candidates:
empty text. Tags left open are closed by their parent's end; a paragraph, list
item, table cell or option ends the one before it. Repeated rows are pages of
their own; extra columns pass through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser
from math import log1p

import pyarrow as pa
from pyspark.sql import DataFrame

from cardfold.llm.common import slices

SLICE_BYTES = 8 << 20
#: Least share of the middle fused path ratio.
THRESHOLD = 0.1
SMOOTHING = 0.5

#: Fixed lists of the markup's vocabulary.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong "
    "sub sup time tt u var wbr br img".split()
)
UNHINTED = frozenset("html body article main p h1 h2 h3 h4 h5 h6".split())
NEVER = frozenset(
    "nav aside form script style template noscript head iframe object svg math canvas audio video select button input textarea "
    "dialog menu fieldset option datalist".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog alertdialog menu menubar status".split())
HINTS = re.compile(
    r"banner|menu|nav|navbar|navigation|breadcrumbs?|sidebar|side|footer|header|masthead|notices?|modal|social|share|sharing|related|"
    r"recommend\w*|widget|toolbar|pagination|pager|copyright|legal|hidden"
)
#: Adverts, consent and reader comments: their share of the text says nothing, comments are as long as articles.
FOREIGN = re.compile(
    r"ads?|advert\w*|adsense|sponsor\w*|promo\w*|cookies?|consent|popup|newsletter|subscribe|comment\w*|disqus|respond|replies|reply"
)
#: Parts of a class name that leave a hint a hint, and parts that turn it.
NEUTRAL = frozenset("site page global left right top bottom list box bar area block container wrapper wrap links posts thread inner".split())
TURNS = frozenset("no not non with without has is".split())
#: Least share of an element's punctuated text in the page's unlinked text that makes a hinted element content, without and with an article inside.
SHARES = (0.5, 0.25)
SAME_ENDS = {
    "p": frozenset("p".split()), "li": frozenset("li".split()), "dt": frozenset("dt dd".split()), "dd": frozenset("dt dd".split()),
    "tr": frozenset("tr td th".split()), "td": frozenset("td th".split()), "th": frozenset("td th".split()), "option": frozenset("option".split()),
}
SCOPES = frozenset("ul ol dl table article section main div body html td th blockquote aside nav footer header form".split())
ENDS_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav "
    "ol p pre section table ul".split()
)
_MARK = re.compile(r"[.,;:!?。，、！？；：…]")
_SPACE = re.compile(r"\s+")


def _hint(names: str) -> str:
    """'foreign' or 'hint' where a whole class token or id is one, else ''."""
    found = ""
    for token in names.split():
        parts = [x for x in re.split("[^a-z]+", token) if x]
        named = [x for x in parts if x not in NEUTRAL]
        if not named or not TURNS.isdisjoint(parts):
            continue
        if all(HINTS.fullmatch(x) or FOREIGN.fullmatch(x) for x in named):
            if any(map(FOREIGN.fullmatch, named)):
                return "foreign"
            found = "hint"
    return found


def _solid(texts) -> tuple[list[int], list[int]]:
    """Unlinked letters of each text, and the same where its block has a mark outside links."""
    marked = {block for block, _, link, _, data, _ in texts if not link and _MARK.search(data)}
    plain = [0 if link else len(data) - sum(map(len, _SPACE.findall(data))) for _, _, link, _, data, _ in texts]
    return plain, [n if t[0] in marked else 0 for t, n in zip(texts, plain)]


class _Page(HTMLParser):
    """Collects (block number, path, inside a link, marked part, text, hinted elements) of every candidate text."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple] = []  # tag, name, out, article, link, hinted elements (None or (number, outer ones))
        self.block, self.texts = 0, []
        self.hinted: list[bool] = []  # whether an article or main part is inside

    def _top(self):
        return self.stack[-1] if self.stack else ("", "", False, False, False, None)

    def _close_to(self, i: int) -> None:
        for tag, *_ in self.stack[i:]:
            if tag not in INLINE:
                self.block += 1
        del self.stack[i:]

    def handle_starttag(self, tag, attrs):
        if tag in ENDS_P:
            self._end_open(frozenset(["p"]))
        if tag in SAME_ENDS:
            self._end_open(SAME_ENDS[tag])
        if tag not in INLINE:
            self.block += 1
        if tag in VOID:
            if tag == "br":
                self.handle_data(" ")
            return
        own = {k: (v or "").lower() for k, v in attrs if k in ("class", "id", "role", "hidden", "itemprop")}
        _, _, out, article, link, hints = self._top()
        names = f"{own.get('class', '')} {own.get('id', '')}"
        if tag in NEVER or own.get("role", "") in ROLES or "hidden" in own:
            out = True
        elif tag in ("header", "footer"):
            out = True
        elif tag not in UNHINTED and (hint := _hint(names)):
            if hint == "foreign":
                out = True
            else:
                hints = (len(self.hinted), hints)
                self.hinted.append(False)
        if tag in ("article", "main") or own.get("role") == "main" or own.get("itemprop") == "articlebody":
            article, outer = True, hints
            while outer and not self.hinted[outer[0]]:
                self.hinted[outer[0]], outer = True, outer[1]
        first = own.get("class", "").split()
        self.stack.append((tag, f"{tag}.{first[0]}" if first else tag, out, article, link or tag == "a", hints))

    def _end_open(self, tags: frozenset) -> None:
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] in tags:
                return self._close_to(i)
            if self.stack[i][0] in SCOPES:
                return

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.stack and self.stack[-1][0] == tag and tag in ("svg", "iframe"):
            self._close_to(len(self.stack) - 1)

    def handle_endtag(self, tag):
        if tag in VOID:
            return
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                return self._close_to(i)
            if tag in INLINE and self.stack[i][0] in SCOPES:
                return  # a stray end of an inline tag closes no block

    def handle_data(self, data):
        _, _, out, article, link, hints = self._top()
        if not out and data:
            # Inline tags are part of the block, not of the path.
            path = tuple(name for tag, name, *_ in self.stack if tag not in INLINE)
            self.texts.append((self.block, path, link, article, data, hints))

    def candidates(self) -> list[tuple]:
        """The texts outside hinted elements, and those of hinted elements with much of the page's text."""
        if not self.hinted:
            return self.texts
        (plain, solid), held = _solid(self.texts), [0] * len(self.hinted)
        for (*_, hints), n in zip(self.texts, solid):
            if hints:
                held[hints[0]] += n
        outer = {}
        for *_, hints in self.texts:
            while hints and hints[0] not in outer:
                outer[hints[0]] = hints[1][0] if hints[1] else None
                hints = hints[1]
        total, own = sum(plain), [False] * len(self.hinted)
        for i in sorted(outer, reverse=True):  # an inner element has the higher number
            if outer[i] is not None:
                held[outer[i]] += held[i]
        for i in sorted(outer):
            enough = held[i] > 0 and held[i] >= SHARES[self.hinted[i]] * total
            own[i] = enough and (outer[i] is None or own[outer[i]])
        return [x for x in self.texts if not x[5] or own[x[5][0]]]


def _path_scores(texts) -> tuple[dict[tuple, float], dict[tuple, float]]:
    """Fused, smoothed ratio and unlinked share of every tag path."""
    length, linked, blocks = {}, {}, {}
    for block, path, link, _, data, _ in texts:
        n = len(data) - sum(map(len, _SPACE.findall(data)))
        length[path] = length.get(path, 0) + n
        linked[path] = linked.get(path, 0) + n * link
        own = blocks.setdefault(path, {}).setdefault(block, [0, 0])
        own[0] += n
        own[1] += len(_MARK.findall(data))
    plain = {p: 1 - linked[p] / n if n else 0.0 for p, n in length.items()}
    # Logarithms, so that one very long block does not set the scale.
    ratio = {p: (plain[p] * sum(log1p(n) for n, _ in b.values()), plain[p] * sum(1 + log1p(m) for _, m in b.values())) for p, b in blocks.items()}
    below: dict[tuple, list] = {}
    for path, sums in ratio.items():
        for up in {path[:-1], path[:-2]}:
            own = below.setdefault(up, [0.0, 0.0, 0])
            own[0], own[1], own[2] = own[0] + sums[0], own[1] + sums[1], own[2] + len(blocks[path])
    fused = {}
    for path, sums in ratio.items():
        near, far = below[path[:-1]], below[path[:-2]]
        text, mark = (
            (1 - SMOOTHING) * sums[k] / len(blocks[path]) + SMOOTHING / 2 * (near[k] / near[2] + plain[path] * far[k] / far[2]) for k in (0, 1)
        )
        fused[path] = text * mark if length[path] else 0.0
    return fused, plain


def _middle(scores: dict[tuple, float], texts) -> float:
    """The score that half of the text, by the logarithms of the texts' lengths, is at or above."""
    ranked = sorted(((scores[path], log1p(len(data.strip()))) for _, path, _, _, data, _ in texts), reverse=True)
    ranked = [(s, w) for s, w in ranked if s > 0]
    left = sum(w for _, w in ranked) / 2
    for score, weight in ranked:
        left -= weight
        if left <= 0:
            return score
    return 0.0


def main_text(html: str | None) -> str:
    """Content blocks of a page, joined by an empty line."""
    if not html:
        return ""
    page = _Page()
    page.feed(html)
    page.close()
    texts = page.candidates()
    letters, solid = _solid(texts)
    # Cards of other articles beside an unmarked body are not the main part.
    inside = sum(n for t, n in zip(texts, letters) if t[3])
    marked = any(t[3] for t in texts) and inside >= sum(n for t, n in zip(texts, solid) if not t[3])
    if marked:
        texts = [t for t in texts if t[3]]
    scores, plain = _path_scores(texts)
    least = THRESHOLD * _middle(scores, texts)
    blocks: dict[int, list[str]] = {}
    for block, path, _, _, data, _ in texts:
        if (marked and plain[path] > 0) or (scores[path] >= least and scores[path] > 0):
            blocks.setdefault(block, []).append(data)
    joined = (_SPACE.sub(" ", "".join(parts)).strip() for _, parts in sorted(blocks.items()))
    return "\n\n".join(b for b in joined if b)


def extract(pages: DataFrame, html_col: str = "html", text_col: str = "text", keep_html: bool = True) -> DataFrame:
    """``pages`` with the main text of each whole page."""
    kept = [f for f in pages.schema.fields if f.name != text_col and (keep_html or f.name != html_col)]
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, html_col, SLICE_BYTES):
                texts = [main_text(h) for h in part.column(html_col).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in names), pa.array(texts, pa.string())], [*names, text_col]
                )

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), f"`{text_col}` string"])
    return pages.mapInArrow(run, schema)
