"""Elements of nested page layouts, one page at a time inside Spark tasks."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Mapping
from html.parser import HTMLParser

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions import text

# The parser below travels with the job, so workers need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Elements that never have an end tag, and those whose content is
# not text of the page.
VOID_TAGS = frozenset(
    "area base br col embed hr img input link meta source track wbr".split()
)
HIDDEN_TAGS = frozenset(("script", "style"))
# Pages held as Python objects at one time.
PAGES_AT_ONCE = 64


class _Element:
    def __init__(self, tag: str, attrs: dict[str, str | None], parent: _Element | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[_Element | str] = []

    def walk(self) -> Iterator[_Element]:
        """Descendants in page order."""
        stack = [c for c in reversed(self.children) if isinstance(c, _Element)]
        while stack:
            element = stack.pop()
            yield element
            stack.extend(c for c in reversed(element.children) if isinstance(c, _Element))

    def find_all(self, tag: str, class_: str | None = None) -> Iterator[_Element]:
        for element in self.walk():
            classes = (element.attrs.get("class") or "").split()
            if element.tag == tag and (class_ is None or class_ in classes):
                yield element

    def text(self) -> str:
        parts: list[str] = []
        stack: list[_Element | str] = list(reversed(self.children))
        while stack:
            node = stack.pop()
            if isinstance(node, str):
                parts.append(node)
            elif node.tag not in HIDDEN_TAGS:
                stack.extend(reversed(node.children))
        return "".join(parts).strip()


class _PageParser(HTMLParser):
    """Builds the element tree; a stray end tag is ignored, an unclosed element
    ends with the first ancestor that is closed."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.current = _Element("", {}, None)

    def handle_starttag(self, tag, attrs):
        element = _Element(tag, dict(attrs), self.current)
        self.current.children.append(element)
        if tag not in VOID_TAGS:
            self.current = element

    def handle_startendtag(self, tag, attrs):
        self.current.children.append(_Element(tag, dict(attrs), self.current))

    def handle_endtag(self, tag):
        element = self.current
        while element is not None and element.tag != tag:
            element = element.parent
        if element is not None and element.parent is not None:
            self.current = element.parent

    def parse_html_declaration(self, i):
        """A declaration that the parser rejects is skipped to its end."""
        try:
            return super().parse_html_declaration(i)
        except AssertionError:
            end = self.rawdata.find(">", i)
            return end + 1 if end >= 0 else -1

    def handle_data(self, data):
        self.current.children.append(data)


def _parse(html: str | None) -> _Element:
    """The page's tree."""
    parser = _PageParser()
    parser.feed(html or "")
    parser.close()
    return parser.root


def select_cards(
    pages: DataFrame,
    card: tuple[str, str | None],
    fields: Mapping[str, tuple[str, str | None]],
    container_id: str | None = None,
    content: str = "html",
    link_ancestor: tuple[str, int] | None = None,
) -> DataFrame:
    """One row per ``card`` element (tag, class) of each page.

    Columns: the page's own, ``card_no`` from 0, the stripped text of the first
    match of each field (NULL when the card has none) and ``links``, the ``href``
    values of the card's ``a`` elements. ``container_id`` restricts the search to
    the element with that id. ``link_ancestor=(field, n)`` takes the links of the
    n-th ancestor of the field's element instead.

    Rows stream through Arrow batches, so a task holds one batch of pages, whose
    size ``spark.sql.execution.arrow.maxBytesPerBatch`` bounds.
    """
    others = [f for f in pages.schema if f.name != content]
    schema = T.StructType(
        others
        + [T.StructField("card_no", T.LongType())]
        + [T.StructField(name, T.StringType()) for name in fields]
        + [T.StructField("links", T.ArrayType(T.StringType()))]
    )
    names = [f.name for f in others]

    def cards_of(page: _Element) -> Iterator[dict]:
        scope = page
        if container_id is not None:
            scope = next(
                (e for e in page.walk() if e.attrs.get("id") == container_id), None
            )
        if scope is None:
            return
        for number, element in enumerate(scope.find_all(*card)):
            found = {
                name: next(element.find_all(*spec), None) for name, spec in fields.items()
            }
            linked = element
            if link_ancestor is not None:
                linked = found[link_ancestor[0]]
                for _ in range(link_ancestor[1]):
                    linked = linked.parent if linked is not None else None
            links = linked.find_all("a") if linked is not None else ()
            yield {
                "card_no": number,
                **{n: e.text() if e is not None else None for n, e in found.items()},
                "links": [a.attrs["href"] for a in links if "href" in a.attrs],
            }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = pa.schema(
                [
                    *[batch.schema.field(n) for n in names],
                    pa.field("card_no", pa.int64()),
                    *[pa.field(n, pa.string()) for n in fields],
                    pa.field("links", pa.list_(pa.string())),
                ]
            )
            for start in range(0, batch.num_rows, PAGES_AT_ONCE):
                rows = [
                    {**{n: row[n] for n in names}, **values}
                    for row in batch.slice(start, PAGES_AT_ONCE).to_pylist()
                    for values in cards_of(_parse(row[content]))
                ]
                yield pa.RecordBatch.from_pylist(rows, schema=out)

    return pages.mapInArrow(run, schema)


def keyword_card_links(cards: DataFrame, title: str, keyword: str) -> DataFrame:
    """The links of every card whose ``title`` has ``keyword`` in it."""
    wanted: Column = text.contains_ignore_case(F.col(title), keyword)
    others = [c for c in cards.columns if c != "links"]
    return cards.where(wanted).select(*others, F.explode("links").alias("link"))
