"""The elements of pages as a table, so that selections are joins.

Nodes are numbered in page order, and each knows the last number inside it: a node is
inside another one if its number lies between that one's number and its last, and an
ancestor is found by the parent's number.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions import text
from tidewater.operators import cards

# The walk below travels with the job, so workers need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

TEXT = "#text"
NODES = "node int, last int, parent int, level int, tag string, element_id string, classes array<string>, href string, text string"
_ARROW = pa.schema(
    [
        ("row", pa.int64()), ("node", pa.int32()), ("last", pa.int32()), ("parent", pa.int32()),
        ("level", pa.int32()), ("tag", pa.string()), ("element_id", pa.string()),
        ("classes", pa.list_(pa.string())), ("href", pa.string()), ("text", pa.string()),
    ]
)


def _nodes(html: str | None) -> list[dict]:
    """The nodes of a page in page order, from 0; texts are nodes of their own."""
    out: list[dict] = []
    # (node to be numbered, its parent's number, level), or the number of one that ends.
    stack: list = [(child, None, 0) for child in reversed(cards._parse(html).children)]
    while stack:
        item = stack.pop()
        if isinstance(item, int):
            out[item]["last"] = len(out) - 1
            continue
        thing, parent, level = item
        number = len(out)
        row = {"node": number, "last": number, "parent": parent, "level": level}
        if isinstance(thing, str):
            out.append(row | {"tag": TEXT, "text": thing})
            continue
        of = thing.attrs.get
        out.append(row | {"tag": thing.tag, "element_id": of("id"), "classes": (of("class") or "").split(), "href": of("href")})
        stack.append(number)
        hidden = thing.tag in cards.HIDDEN_TAGS
        stack.extend((c, number, level + 1) for c in reversed(thing.children) if not (hidden and isinstance(c, str)))
    return out


def element_nodes(pages: DataFrame, key: str, content: str = "html") -> DataFrame:
    """``key`` and NODES of every page: elements, and texts under the tag ``#text``.

    Tags are in lower case; ``parent`` is NULL for the outermost nodes. Scripts and
    styles have no text. A NULL page has no nodes; ``key`` should tell pages apart.
    """
    schema = T.StructType([pages.schema[key], *T.StructType.fromDDL(NODES).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, cards.PAGES_AT_ONCE):
                part = batch.slice(start, cards.PAGES_AT_ONCE)
                rows = [{"row": k, **node} for k, html in enumerate(part[content].to_pylist()) for node in _nodes(html)]
                made = pa.RecordBatch.from_pylist(rows, schema=_ARROW)
                yield pa.RecordBatch.from_arrays(
                    [part[key].take(made["row"]), *made.columns[1:]], [key, *_ARROW.names[1:]]
                )

    return pages.select(key, content).mapInArrow(run, schema)


def ancestors(nodes: DataFrame, of: DataFrame, key: str, n: int) -> DataFrame:
    """``of`` (key, node and others) with ``ancestor``, the n-th element above node.

    A join by number for each step; rows without so many ancestors go.
    """
    parents = nodes.select(F.col(key).alias("_key"), F.col("node").alias("_node"), F.col("parent").alias("_parent"))
    parents = parents.where("_parent IS NOT NULL")
    out = of.withColumn("ancestor", F.col("node"))
    for _ in range(n):
        same = (F.col(key) == F.col("_key")) & (F.col("ancestor") == F.col("_node"))
        out = out.join(parents, same).withColumn("ancestor", F.col("_parent")).drop("_key", "_node", "_parent")
    return out


def inside(outer: DataFrame, inner: DataFrame, key: str) -> DataFrame:
    """Pairs of an ``outer`` node (key, node, last and others) and the ``inner`` ones inside it,
    whose columns come with ``inner_`` before their names. Only nodes of one page meet."""
    renamed = inner.select(F.col(key).alias("_key"), *[F.col(c).alias(f"inner_{c}") for c in inner.columns if c != key])
    within = (F.col("inner_node") > F.col("node")) & (F.col("inner_node") <= F.col("last"))
    return outer.join(renamed, (F.col(key) == F.col("_key")) & within).drop("_key")


def element_texts(nodes: DataFrame, elements: DataFrame, key: str) -> DataFrame:
    """``elements`` (key, node, last) with ``title``, their stripped text; NULL without any."""
    pieces = inside(elements, nodes.where(F.col("tag") == TEXT).select(key, "node", "text"), key)
    whole = pieces.groupBy(key, "node").agg(F.sort_array(F.collect_list(F.struct("inner_node", "inner_text"))).alias("p"))
    said = whole.select(
        F.col(key).alias("_key"), F.col("node").alias("_node"),
        F.regexp_replace(F.array_join("p.inner_text", ""), r"^[\s\x{a0}]+|[\s\x{a0}]+\z", "").alias("title"),
    )
    same = (F.col(key) == F.col("_key")) & (F.col("node") == F.col("_node"))
    return elements.join(said, same, "left").drop("_key", "_node")


def keyword_cards(
    nodes: DataFrame, key: str, heading: str, keyword: str, up: int = 3, link: str = "a"
) -> DataFrame:
    """key, heading (its number), title and link: for every ``heading`` element whose text
    has ``keyword``, whatever the case, the ``href`` values inside its ``up``-th ancestor.

    Cards may lie in each other: a link belongs to all cards around it.
    """
    headings = nodes.where(F.col("tag") == heading).select(key, "node", "last")
    titled = element_texts(nodes, headings, key).where(text.contains_ignore_case(F.col("title"), keyword))
    card = ancestors(nodes, titled, key, up).select(key, F.col("node").alias("heading"), "title", F.col("ancestor").alias("_card"))
    spans = nodes.select(F.col(key).alias("_key"), "node", "last")
    card = card.join(spans, (F.col(key) == F.col("_key")) & (F.col("_card") == F.col("node"))).drop("_key")
    links = nodes.where((F.col("tag") == link) & F.col("href").isNotNull()).select(key, "node", "href")
    return inside(card, links, key).select(key, "heading", "title", F.col("inner_href").alias("link"))
