"""HTML to elements: the only step that leaves the JVM.

``parse_pages`` reads each page once and returns, per page, the elements hit by
a set of named CSS selectors (in document order) and the page's text pieces.
Everything that follows is a Column expression over those two arrays, so no
page and no element is ever shuffled to be extracted:

* descendants of ``els[i]`` are ``els[i+1 .. i+span]``;
* the text of an element is ``texts[t0 .. t1-1]`` joined by one space;
* ``firsts`` of a scope element (such as a card) are the places of the first hit
  of each wanted selector inside it, so its fields need no search.

Each text piece is stored once however deep the markup nests, which keeps the
output linear in the page (lenient parsing lets unclosed tags nest without end).
"""

from __future__ import annotations

import re
import sys
from collections import Counter
from html import unescape
from html.entities import html5
from html.parser import HTMLParser
from urllib.parse import urljoin

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F, types as T

# Ship this module's code with the job instead of expecting it on the workers.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# --- fixed values: HTML tags that never have content ------------------------
VOID_TAGS = frozenset(
    "area base basefont bgsound br col command embed frame hr image img input "
    "isindex keygen link menuitem meta nextid param source spacer track wbr".split()
)
# --- fixed values: tags whose text is no text of the elements around them ----
QUIET_TAGS = frozenset(["script", "style", "template", "rt", "rp"])
# ---------------------------------------------------------------------------

ELEMENT_TYPE = T.StructType(
    [
        T.StructField("at", T.IntegerType()),
        T.StructField("span", T.IntegerType()),
        T.StructField("hits", T.LongType()),
        T.StructField("t0", T.IntegerType()),
        T.StructField("t1", T.IntegerType()),
        T.StructField("tag", T.StringType()),
        T.StructField("href", T.StringType()),
        T.StructField("href_abs", T.StringType()),
        T.StructField("data_url_abs", T.StringType()),
        T.StructField("rel", T.StringType()),
        T.StructField("cls", T.StringType()),
        T.StructField("firsts", T.ArrayType(T.IntegerType())),
    ]
)
_PARSED_FIELDS = [
    T.StructField("els", T.ArrayType(ELEMENT_TYPE)),
    T.StructField("texts", T.ArrayType(T.StringType())),
    T.StructField("parse_error", T.StringType()),
]
_CHUNK_ROWS = 64
_ARROW_ELEMENT = pa.struct(
    [(name, pa.int32()) for name in ("at", "span")]
    + [("hits", pa.int64())]
    + [(name, pa.int32()) for name in ("t0", "t1")]
    + [
        (name, pa.string())
        for name in ("tag", "href", "href_abs", "data_url_abs", "rel", "cls")
    ]
    + [("firsts", pa.list_(pa.int32()))]
)

_SIMPLE = re.compile(
    r"""(?P<tag>\*|[A-Za-z][\w-]*)
      | \#(?P<id>[\w-]+)
      | \.(?P<cls>[\w-]+)
      | \[\s*(?P<attr>[\w:-]+)\s*(?:(?P<op>[~^$*]?=)\s*(?P<quote>["']?)(?P<value>.*?)(?P=quote)\s*)?\]
      | (?P<join>\s*[>,]\s*|\s+)""",
    re.VERBOSE,
)
_ATTR_TESTS = {
    None: lambda have, want: True,
    "=": lambda have, want: have == want,
    "^=": lambda have, want: want != "" and have.startswith(want),
    "$=": lambda have, want: want != "" and have.endswith(want),
    "*=": lambda have, want: want != "" and want in have,
    "~=": lambda have, want: want in have.split(),
}


def compile_selectors(selectors: dict[str, str]) -> list[tuple]:
    """Selectors as steps ``(tag, tests, need, direct, hit)``.

    A step is one compound. ``need`` is the bit of the step that must hold on an
    ancestor (``direct``: on the parent), ``hit`` the bit of the selector that
    the step completes, or 0. Supported: tag, ``*``, #id, .class, [attr] with
    = ^= $= *= ~=, descendant and child combinators, comma groups.
    """
    if len(selectors) > 62:
        raise ValueError("at most 62 selectors per pass")
    steps: list[tuple] = []
    for index, (name, selector) in enumerate(selectors.items()):
        tag, tests, need, direct, used = None, [], 0, False, False
        position, text = 0, selector.strip()
        while position <= len(text):
            match = _SIMPLE.match(text, position)
            last = position == len(text)
            if not last and match is None:
                raise ValueError(f"unsupported selector for {name!r}: {selector!r}")
            join = "," if last else match["join"]
            if join is not None:
                if not used:
                    raise ValueError(f"empty compound in selector for {name!r}: {selector!r}")
                ends = join.strip() == ","
                steps.append((tag, tuple(tests), need, direct, 1 << index if ends else 0))
                need = 0 if ends else 1 << (len(steps) - 1)
                direct = join.strip() == ">"
                tag, tests, used = None, [], False
            elif match["tag"]:
                tag, used = None if match["tag"] == "*" else match["tag"].lower(), True
            else:
                used = True
                if match["id"]:
                    tests.append(("id", "=", match["id"]))
                elif match["cls"]:
                    tests.append(("class", "~=", match["cls"]))
                else:
                    tests.append((match["attr"].lower(), match["op"], match["value"]))
            if last:
                break
            position = match.end()
    return steps


def selector_bits(selectors: dict[str, str]) -> dict[str, int]:
    return {name: 1 << index for index, name in enumerate(selectors)}


class _PageReader(HTMLParser):
    """Collects selector hits and text pieces in one pass over a page.

    Lenient tree: void tags never stay open, an end tag closes everything up to
    its nearest open partner or is ignored, nothing is closed by implication.
    """

    def __init__(self, steps, base_url):
        super().__init__(convert_charrefs=False)
        self.base_url = base_url or ""
        self.by_tag: dict = {}
        for bit, step in enumerate(steps):
            self.by_tag.setdefault(step[0], []).append((1 << bit, *step[1:]))
        self.els: list[dict] = []
        self.texts: list[str] = []
        self.stack: list[tuple] = []  # (tag, states here, states here and above, element)
        self.open_tags = Counter()
        self.closed_void = Counter()
        self.hits_open = 0
        self.quiet = 0
        self.pieces: list[str] = []

    # -- text --------------------------------------------------------------
    def handle_data(self, data):
        self.pieces.append(data)

    def handle_charref(self, name):
        self.pieces.append(unescape(f"&#{name};"))

    def handle_entityref(self, name):
        self.pieces.append(html5.get(f"{name};", f"&{name}"))

    def flush(self, keep=True):
        if self.pieces:
            text = "".join(self.pieces).strip()
            self.pieces.clear()
            if keep and text and self.hits_open and not self.quiet:
                self.texts.append(text)

    def _skip(self, data):
        self.flush()

    handle_comment = handle_decl = handle_pi = _skip

    def unknown_decl(self, data):
        self.flush()
        if data[:6].upper() == "CDATA[":
            self.pieces.append(data[6:])
            self.flush()

    # -- elements ----------------------------------------------------------
    def handle_starttag(self, tag, attrs):
        self._open(tag, attrs)
        if tag in VOID_TAGS:
            self._close(tag)
            self.closed_void[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self._open(tag, attrs)
        self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if self.closed_void[tag]:
            self.closed_void[tag] -= 1
        else:
            self._close(tag)

    def _open(self, tag, attrs):
        self.flush()
        values = {name: value or "" for name, value in attrs}
        parent, above = self.stack[-1][1:3] if self.stack else (0, 0)
        here = hits = 0
        for group in (self.by_tag.get(tag, ()), self.by_tag.get(None, ())):
            for bit, tests, need, direct, hit in group:
                if need and not (need & (parent if direct else above)):
                    continue
                if all(
                    name in values and _ATTR_TESTS[op](values[name], want)
                    for name, op, want in tests
                ):
                    here |= bit
                    hits |= hit
        element = self._element(tag, values, hits) if hits else None
        self.stack.append((tag, here, above | here, element))
        self.open_tags[tag] += 1
        self.quiet += tag in QUIET_TAGS

    def _element(self, tag, values, hits):
        href = values.get("href")
        data_url = values.get("data-url")
        element = {
            "at": len(self.els),
            "span": 0,
            "hits": hits,
            "t0": len(self.texts),
            "t1": 0,
            "tag": tag,
            "href": href,
            "href_abs": self._resolve(href),
            "data_url_abs": self._resolve(data_url),
            "rel": values.get("rel"),
            "cls": values.get("class"),
            "firsts": None,
        }
        self.els.append(element)
        self.hits_open += 1
        return element

    def _resolve(self, reference):
        if reference is None:
            return None
        try:
            return urljoin(self.base_url, reference)
        except ValueError:  # malformed host, such as an open bracket
            return None

    def _close(self, tag):
        self.flush()
        while self.open_tags[tag]:
            if self._pop() == tag:
                break

    def _pop(self):
        tag, _, _, element = self.stack.pop()
        self.open_tags[tag] -= 1
        self.quiet -= tag in QUIET_TAGS
        if element is not None:
            element["span"] = len(self.els) - element["at"] - 1
            element["t1"] = len(self.texts)
            self.hits_open -= 1
        return tag

    def finish(self, scopes):
        self.close()
        self.flush()
        while self.stack:
            self._pop()
        # One backward pass: the next hit of each wanted selector after each place.
        following = {bit: len(self.els) for _, wanted in scopes for bit in wanted}
        for element in reversed(self.els) if scopes else ():
            at, hits = element["at"], element["hits"]
            for scope, wanted in scopes:
                if hits & scope:
                    end = at + element["span"]
                    element["firsts"] = (element["firsts"] or []) + [
                        following[bit] if following[bit] <= end else None for bit in wanted
                    ]
            for bit in following:
                if hits & bit:
                    following[bit] = at


def _read_page(steps, scopes, url, html):
    reader = _PageReader(steps, url)
    try:
        reader.feed(html)
        reader.finish(scopes)
    except AssertionError as exc:  # markup the standard parser rejects
        return [], [], str(exc) or "markup rejected"
    return reader.els, reader.texts, None


def parse_pages(
    pages: DataFrame,
    selectors: dict[str, str],
    url_col: str = "url",
    html_col: str = "html",
    keep: list[str] | None = None,
    scopes: dict[str, list[str]] | None = None,
) -> DataFrame:
    """One row per page: ``keep`` columns, ``els``, ``texts``, ``parse_error``.

    ``scopes`` names selectors whose hits carry ``firsts``, and the selectors
    wanted inside them. An element that hits several scopes has the firsts of
    all of them, in the order of ``scopes``.

    Only the kept columns, the URL and the HTML enter Python; the HTML does not
    come back. A null page gives null arrays.
    """
    keep = list(keep if keep is not None else [url_col])
    steps = compile_selectors(selectors)
    bits = selector_bits(selectors)
    scoped = [(bits[s], [bits[name] for name in names]) for s, names in (scopes or {}).items()]
    columns = list(dict.fromkeys([*keep, url_col, html_col]))
    source = pages.select(*columns)
    schema = T.StructType([source.schema[name] for name in keep] + _PARSED_FIELDS)

    def read_chunk(chunk):
        read = [
            (None, None, None) if html is None else _read_page(steps, scoped, url, html)
            for url, html in zip(chunk[url_col].to_pylist(), chunk[html_col].to_pylist())
        ]
        els, texts, errors = zip(*read)
        arrays = [chunk[name] for name in keep] + [
            pa.array(els, pa.list_(_ARROW_ELEMENT)),
            pa.array(texts, pa.list_(pa.string())),
            pa.array(errors, pa.string()),
        ]
        return pa.RecordBatch.from_arrays(arrays, [*keep, "els", "texts", "parse_error"])

    def run(batches):
        for batch in batches:
            # Small chunks bound the Python objects alive at a time.
            for start in range(0, batch.num_rows, _CHUNK_ROWS):
                yield read_chunk(batch.slice(start, _CHUNK_ROWS))

    return source.mapInArrow(run, schema)


# --- Column helpers over ``els`` and ``texts`` -------------------------------


def has(element: Column, bit: int) -> Column:
    return element["hits"].bitwiseAND(F.lit(bit)) != 0


def select_all(els: Column, bit: int) -> Column:
    """All hits in document order."""
    return F.filter(els, lambda e: has(e, bit))


def select_one(els: Column, bit: int) -> Column:
    """First hit in document order, or null."""
    return F.get(select_all(els, bit), F.lit(0))


def first_inside(els: Column, element: Column, k: int, scopes_before: Column | int = 0) -> Column:
    """First hit inside a scope element of its ``k``-th wanted selector, or null.

    ``scopes_before`` is the number of wanted selectors of earlier scopes that
    the element hits too.
    """
    return F.get(els, F.get(element["firsts"], F.lit(k) + scopes_before))


def text_of(element: Column, texts: Column) -> Column:
    """Raw joined text of an element, '' when it has none; null for no element."""
    return F.array_join(
        F.slice(texts, element["t0"] + 1, element["t1"] - element["t0"]), " "
    )


def href_of(element: Column) -> Column:
    """Resolved link of an element; null without a link or with an empty one."""
    return F.when(element["href"] != "", element["href_abs"])


def html_nodes(
    pages: DataFrame, selector: str = "*", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """Node table: one row per element matching ``selector``.

    ``pre`` is the element's place among the matches of its page and ``last``
    that of its last matching descendant, so d is inside a when
    ``a.pre < d.pre <= a.last`` on the same page.
    """
    parsed = parse_pages(pages, {"node": selector}, url_col, html_col)
    rows = parsed.select(
        F.col(url_col).alias("url"),
        F.inline(
            F.transform(
                F.col("els"),
                lambda e: F.struct(
                    e["at"].alias("pre"),
                    (e["at"] + e["span"]).alias("last"),
                    e["tag"].alias("tag"),
                    e["href"].alias("href"),
                    e["href_abs"].alias("href_abs"),
                    e["data_url_abs"].alias("data_url_abs"),
                    e["rel"].alias("rel"),
                    e["cls"].alias("cls"),
                    text_of(e, F.col("texts")).alias("text"),
                ),
            )
        ),
    )
    return rows
