"""Main text of web pages by wrappers inferred from the pages of a host.

A page is a stream of text slots, each named by the block elements around it. The
streams of a host's pages are aligned one after another into a union-free expression
over slots: slots that some pages lack become optional, slots that recur become repeated
groups, and slots in conflicting order join one repeated group. The wrapper keeps what
its slots hold over all pages, and tells by it which are main text of a page: changing
slots of the aligned groups, and in an article what stands among them. Names weigh
between regions outside articles.
"""

from __future__ import annotations

import html
import json
import re
import zlib
from collections import defaultdict
from collections.abc import Collection, Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.common import BROADCAST_BYTES, slices, table, travels, written
from tidewater.llm.urls import host_of

travels(__name__)

# Fixed values of HTML: elements that make blocks, that never close, that close an
# open one of their kind, and whose content is no text.
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup html legend li main "
    "menu nav noscript ol optgroup option p pre search section select summary table tbody td textarea tfoot th "
    "thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
    "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "body": ("head",),
    "tbody": ("tr", "td", "th", "thead", "tbody"), "tfoot": ("tr", "td", "th", "tbody"),
}
# An implied end looks no further out than these.
SCOPES = frozenset("table ul ol dl menu select td th".split())
# Elements whose ids name their own text, as slugs do.
SLUGGED = frozenset("h1 h2 h3 h4 h5 h6 p".split())
# Elements and whole class, id and role names that are not the article's text.
NOT_TEXT_TAGS = frozenset(
    "aside button datalist dialog fieldset footer form head menu nav optgroup option search select textarea title".split()
)
NOT_TEXT_NAMES = frozenset(
    "ad ads advert adverts advertisement advertisements banner banners breadcrumb breadcrumbs comment "
    "comments complementary consent contentinfo cookie cookies copyright discussion disqus footer form "
    "gdpr login masthead menu menus modal nav navbar navigation newsletter notice notices pagination "
    "popup promo related replies reply respond search share sharing sidebar sidebars signup skip social "
    "sponsor sponsored subscribe toolbar topbar widget widgets".split()
)
# Parts of a name that say of what page or how laid out, beside the parts that say what for.
NAME_PLACES = frozenset(
    "area article bar block body box button buttons container content entry form global group inner item "
    "items link links list main outer page panel post section site thread title top wrap wrapper".split()
)
TEXT_TAGS = frozenset(("article", "main"))
TEXT_NAMES = frozenset("article articlebody content entry main post story".split())
# Header names count inside the article's element too, where the element does not.
HEADER = "header"
ROOTS = frozenset(("html", "body"))
# How much more text counts in an element named like an article than elsewhere. Changing
# text in an article or main element comes before all other, however much that is.
BOOST = (1, 4, 1)
OTHER = len(BOOST)
# Different pages with one and the same text that make a slot fixed; more in TEXT_TAGS.
FIXED_PAGES = 2
FIXED_TEXT_PAGES = 3
# Wrappers a task holds before it passes them on; tasks' shares of a host's wrappers.
HOSTS_AT_ONCE = 2_000
SHARES = 64

_TOKEN = re.compile(
    r"<!--(?:.*?-->|.*\Z)"
    r"|<(?P<raw>script|style|template|iframe|svg|object|noembed|noframes)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>(?:.*?</(?P=raw)\b[^>]*>|.*\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<!\[CDATA\[.*?\]\]>|<[!?/][^>]*>",
    re.S | re.I,
)
_NAMED = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?=[\s=]|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
_NAME_PARTS = re.compile(r"[a-z]+")
_NOT_NAME = re.compile(r"[^a-z_-]+")


def _name(tag: str, attrs: str) -> str:
    """An element's part of a slot's name: tag, names in it, ``!`` if it is hidden."""
    if not attrs or attrs.isspace():
        return tag
    names = sorted(
        {
            x
            for kind, a, b, c in _NAMED.findall(attrs)
            if tag not in SLUGGED or kind.lower() != "id"
            for word in (a or b or c).lower().split()
            if (x := _NOT_NAME.sub("", word))
        }
    )
    return ".".join([tag, *names]) + ("!" if _HIDDEN.search(attrs) else "")


def slots(page: str) -> list[tuple[str, str, bool]]:
    """The page's texts in order: name of the slot, text, and whether it is all links."""
    out: list[tuple[str, str, bool]] = []
    stack: list[tuple[str, str]] = []
    parts: list[str] = []
    links = plain = anchors = 0
    at = 0

    def flush() -> None:
        nonlocal links, plain
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                out.append((">".join(n for _, n in stack), text, not plain and links > 0))
            parts.clear()
        links = plain = 0

    def close(to: int) -> None:
        flush()
        del stack[to:]

    for token in _TOKEN.finditer(page):
        if token.start() > at:
            text = page[at : token.start()]
            parts.append(text)
            if not text.isspace():
                links, plain = (links + 1, plain) if anchors else (links, plain + 1)
        at = token.end()
        tag = token["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in BLOCKS:
            if token["end"]:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == tag:
                        close(k)
                        anchors = 0
                        break
                else:
                    flush()
                continue
            flush()
            anchors = 0
            # A block ends an open paragraph.
            if stack and stack[-1][0] == "p":
                stack.pop()
            if tag in CLOSES:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] in CLOSES[tag]:
                        del stack[k:]
                        if tag not in ("tr", "tbody", "tfoot"):
                            break
                    elif stack[k][0] in SCOPES:
                        break
            stack.append((tag, _name(tag, token["attrs"])))
        elif tag == "a":
            anchors = 0 if token["end"] else 1
        elif tag in ("br", "hr"):
            parts.append(" ")
            if tag == "hr":
                flush()
    if at < len(page):
        parts.append(page[at:])
        plain += 1
    flush()
    return out


class Wrapper:
    """A union-free expression: ``groups`` of slots in order, and what the slots hold.

    Of each slot: pages that have it, whether it recurs in one, the checksum of its text
    while that is always the same (else -1), characters, characters of links, and up to
    FIXED_TEXT_PAGES checksums of pages that have it, so that copies count once.
    """

    def __init__(self, pages: int = 0, groups: Sequence[Sequence[str]] = (), held: dict | None = None):
        self.pages = pages
        self.groups = [list(g) for g in groups]
        self.held: dict[str, list[int]] = held or {}
        self.met: set[tuple] = set()

    @classmethod
    def of_page(cls, found: Sequence[tuple[str, str, bool]]) -> Wrapper:
        first: dict[str, int] = {}
        last: dict[str, int] = {}
        held: dict[str, list] = {}
        page = 0
        for k, (name, text, is_link) in enumerate(found):
            first.setdefault(name, k)
            last[name] = k
            mark = zlib.crc32(text.encode("utf-8", "replace"))
            page = zlib.crc32(b"%d %d" % (k, mark), page)
            own = held.setdefault(name, [1, 0, mark, 0, 0, []])
            if first[name] != k:
                own[1] = 1
                own[2] = own[2] if own[2] == mark else -1
            own[3] += len(text)
            own[4] += len(text) if is_link else 0
        for own in held.values():
            own[5].append(page)
        groups: list[list[str]] = []
        reach = -1
        for name, k in first.items():
            if k > reach:
                groups.append([name])
            else:  # between two of the same slot: a repeated group
                groups[-1].append(name)
            reach = max(reach, last[name])
        return cls(1, groups, held)

    def merge(self, other: Wrapper) -> None:
        """Aligns ``other`` with this: what one of them lacks is optional from now on."""
        key = tuple(map(tuple, other.groups))
        if key not in self.met:
            if other.groups != self.groups:
                self.groups = _aligned(self.groups, other.groups)
            if len(self.met) < 1000:
                self.met.add(key)
        self.pages += other.pages
        for name, (n, more, mark, chars, links, seen) in other.held.items():
            own = self.held.get(name)
            if own is None:
                self.held[name] = [n, more, mark, chars, links, list(seen)]
            else:
                own[0] += n
                own[1] |= more
                own[2] = own[2] if own[2] == mark else -1
                own[3] += chars
                own[4] += links
                if len(own[5]) < FIXED_TEXT_PAGES:
                    own[5] = sorted({*own[5], *seen})[:FIXED_TEXT_PAGES]

    def expression(self) -> str:
        """For readers: ``( )+`` repeated and ``( )?`` optional groups, slots by name."""

        def slot(name: str) -> str:
            return name if self.held[name][0] == self.pages else f"({name})?"

        return " ".join(
            f"({' '.join(map(slot, g))})+" if len(g) > 1 or self.held[g[0]][1] else slot(g[0]) for g in self.groups
        )

    def text_slots(self) -> list[list]:
        """Name, rank, whether it is no fixed text, region and weight of all slots that may be text.

        Ranks are places in BOOST, or OTHER. A slot of a group votes for the element that
        holds all the group's changing texts, so that headings, lists and paragraphs that
        take turns stay together; by itself for its own element.
        """
        out = []
        # Elements of articles that hold changing text themselves.
        beside = {
            name.rpartition(">")[0]
            for name, (_, _, mark, chars, links, seen) in self.held.items()
            if 2 * links < chars and (mark == -1 or len(seen) < FIXED_TEXT_PAGES) and _rank(name, False) == 0
        }
        for group in self.groups:
            rows = []
            for name in group:
                pages, _, mark, chars, links, seen = self.held[name]
                is_links = 2 * links >= chars
                rank = _rank(name, is_links)
                if rank is not None:
                    changes = mark == -1 or len(seen) < (FIXED_PAGES if rank else FIXED_TEXT_PAGES)
                    weight = chars / pages if changes and not is_links else 0
                    rows.append([name, rank, changes, name.rpartition(">")[0], weight])
            # In an article a text that never changes is its own, like a byline or a heading
            # that all have, where it stands among changing ones; in an element that holds
            # no other it is a notice.
            among = {r[3] for r in rows if r[4] and r[1] == 0} | beside
            for row in rows:
                if row[1] == 0 and not row[2] and row[3] in among:
                    row[2] = True
            region = _common([r[3] for r in rows if r[4] and r[1] < OTHER])
            for row in rows:
                if region and row[4] and row[1] < OTHER:
                    row[3] = region
            out += rows
        return out

    def main_slots(self, page: Collection[str] | None = None) -> list[str]:
        """The slots of main text of a page that has the slots ``page``, else all of the host's."""
        return sorted(chosen(self.text_slots(), self.held if page is None else page))

    def to_json(self) -> str:
        return json.dumps([self.pages, self.groups, self.held])

    @classmethod
    def from_json(cls, text: str) -> Wrapper:
        return cls(*json.loads(text))


def _parts(name: str) -> list[tuple[str, set[str]]]:
    out = []
    for part in name.split(">"):
        tag, *names = part.rstrip("!").split(".")
        out.append((tag, set(names)))
    return out


def _in_text(name: str, depth: int) -> bool:
    return any(
        tag in TEXT_TAGS if depth == 0 else tag not in ROOTS and not TEXT_NAMES.isdisjoint(_words(names))
        for tag, names in _parts(name)
    )


def _words(names: Collection[str]) -> set[str]:
    return {x for n in names for x in _NAME_PARTS.findall(n)}


def _purposes(names: Collection[str]) -> set[str]:
    """Names whose every part says another purpose, or only where something is: a
    ``comment-list`` is one of comments, a ``no-sidebar`` no sidebar."""
    out = set(names)
    for name in names:
        parts = set(_NAME_PARTS.findall(name)) - NAME_PLACES
        if parts and parts <= NOT_TEXT_NAMES:
            out |= parts
    return out


def _rank(name: str, is_links: bool) -> int | None:
    """A slot's place in BOOST, OTHER if names tell another purpose; None if it is never text."""
    if any(part.endswith("!") or tag in NOT_TEXT_TAGS for part, (tag, _) in zip(name.split(">"), _parts(name), strict=True)):
        return None
    if _other_purpose(name, is_links):
        return OTHER
    return next((depth for depth in (0, 1) if _in_text(name, depth)), 2)


def _common(regions: Sequence[str]) -> str:
    """The innermost element around all ``regions``; empty if that is no more than the body."""
    parts: list[str] = []
    for same in zip(*(r.split(">") for r in regions), strict=False):
        if len(set(same)) > 1:
            break
        parts.append(same[0])
    return ">".join(parts) if parts and parts[-1].split(".")[0] not in ROOTS else ""


def chosen(rows: Sequence[Sequence], page: Collection[str]) -> list[str]:
    """The slots of main text among those of a page, by its host's ``text_slots``.

    Changing slots in ``article`` and ``main`` elements come first; without any, those in
    elements named so and each other region compare by their changing text, times BOOST,
    and of regions that weigh the same the first by rank and the last by name is taken. A
    page that has none keeps the fixed slots of its named elements, and one without any
    but OTHER slots those.
    """
    here = [r for r in rows if r[0] in page]
    free = [r for r in here if r[1] < OTHER]
    changing = [r for r in free if r[2]]
    if not changing:
        changing = [r for r in free if r[1] < OTHER - 1]
    if not free:
        changing = [r for r in here if r[2]]
    weights: dict[tuple, float] = defaultdict(float)
    for _, rank, _, region, weight in changing:
        own = min(rank, OTHER - 1)
        weights[(own, region if own == OTHER - 1 else "")] += weight * BOOST[own]
    if any(w for (rank, _), w in weights.items() if rank == 0):
        return [r[0] for r in changing if r[1] == 0]
    # Without any weight there are links alone, or fixed texts.
    named = [k for k in weights if k[0] < OTHER - 1]
    if not any(weights.values()) and not named:
        return []
    rank, region = max(weights, key=lambda k: (weights[k], -k[0], k[1]))
    if rank < OTHER - 1:
        return [r[0] for r in changing if r[1] == rank]
    return [r[0] for r in changing if r[1] >= rank and (r[3] == region or r[0] == region or r[0].startswith(f"{region}>"))]


def _other_purpose(name: str, is_links: bool) -> bool:
    """Whether names of elements around a slot tell another purpose; parts of names, of links only.

    Names of the whole page and of the article's element itself tell how they look, not
    what they are.
    """
    inside = False
    for tag, names in _parts(name):
        if tag not in ROOTS and tag not in TEXT_TAGS:
            told = names | _words(names) if is_links else _purposes(names)
            if told & NOT_TEXT_NAMES or (not inside and (tag == HEADER or HEADER in told)):
                return True
        inside = inside or tag in TEXT_TAGS
    return False


def _aligned(a: list[list[str]], b: list[list[str]]) -> list[list[str]]:
    """One sequence of groups that has both orders; slots in conflict share a group."""
    after: dict[str, list[str]] = {}
    for groups in (a, b):
        for k, group in enumerate(groups):
            for i, name in enumerate(group):
                nexts = after.setdefault(name, [])
                if len(group) > 1:
                    nexts.append(group[(i + 1) % len(group)])
                if k + 1 < len(groups):
                    nexts.append(groups[k + 1][0])
    # Strongly connected parts, in reverse topological order.
    number: dict[str, int] = {}
    low: dict[str, int] = {}
    held: list[str] = []
    on: set[str] = set()
    out: list[list[str]] = []
    for root in reversed(list(after)):
        work = [(root, iter(after[root]))] if root not in number else []
        if work:
            number[root] = low[root] = len(number)
            held.append(root)
            on.add(root)
        while work:
            name, nexts = work[-1]
            for following in nexts:
                if following not in number:
                    number[following] = low[following] = len(number)
                    held.append(following)
                    on.add(following)
                    work.append((following, iter(after[following])))
                    break
                if following in on:
                    low[name] = min(low[name], number[following])
            else:
                work.pop()
                if work:
                    low[work[-1][0]] = min(low[work[-1][0]], low[name])
                if low[name] == number[name]:
                    part = set()
                    while name not in part:
                        part.add(held.pop())
                    on -= part
                    out.append([x for x in after if x in part])
    return out[::-1]


def wrappers(pages: DataFrame) -> DataFrame:
    """host, wrapper and main (its text slots), both as JSON, from ``pages`` (host, html).

    Each task aligns its own pages; a host's partial wrappers are then aligned in two
    steps, so that no task gets more than a share of a host's.
    """

    def infer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, Wrapper] = {}
        share = TaskContext.get().partitionId() % SHARES

        def out() -> pa.RecordBatch:
            made = [list(found), [share] * len(found), [w.to_json() for w in found.values()]]
            return pa.RecordBatch.from_arrays(
                [pa.array(made[0], pa.string()), pa.array(made[1], pa.int32()), pa.array(made[2], pa.string())],
                ["host", "share", "wrapper"],
            )

        for batch in slices(batches, "html"):
            for host, page in zip(batch["host"].to_pylist(), batch["html"].to_pylist(), strict=True):
                own = found.get(host)
                if own is None:
                    if len(found) >= HOSTS_AT_ONCE:
                        yield out()
                        found.clear()
                    own = found[host] = Wrapper()
                own.merge(Wrapper.of_page(slots(page)))
        yield out()

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, own = None, None
        done: list[tuple] = []

        def out() -> pa.RecordBatch:
            columns = list(zip(*done, strict=True)) or [[]] * 4
            done.clear()
            kinds = (pa.string(), pa.int32(), pa.string(), pa.string())
            return pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(columns, kinds, strict=True)], ["host", "share", "wrapper", "main"]
            )

        def close() -> None:
            if own is not None:
                done.append((*key, own.to_json(), json.dumps(own.text_slots())))

        for batch in batches:
            columns = [batch[c].to_pylist() for c in ("host", "share", "wrapper")]
            for host, share, made in zip(*columns, strict=True):
                if key != (host, share):
                    close()
                    key, own = (host, share), Wrapper()
                own.merge(Wrapper.from_json(made))
            yield out()
        close()
        yield out()

    parts = pages.mapInArrow(infer, "host string, share int, wrapper string")
    schema = "host string, share int, wrapper string, main string"
    shared = parts.repartition("host", "share").sortWithinPartitions("host", "share").mapInArrow(align, schema)
    whole = shared.select("host", F.lit(0).alias("share"), "wrapper").repartition("host").sortWithinPartitions("host")
    return whole.mapInArrow(align, schema).drop("share")


def main_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every row of ``pages`` (page_id, url, html).

    Text blocks in page order, one a line, each with its white space as single spaces and
    character references decoded. A null html and a page without main text give an
    empty text; a url without a host shares the wrapper of the empty host. Broken markup
    is read as far as it goes.
    """
    wanted = pages.select(
        "page_id", "url", host_of(F.col("url")).alias("host"), F.coalesce("html", F.lit("")).alias("html")
    )
    found = written(wrappers(wanted.select("host", "html")), "html-wrappers").select("host", "main")
    size = found.agg(F.sum(F.length("main") + F.length("host") + 64)).first()[0] or 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: dict[str, list] = {}
        sets: dict[tuple, frozenset] = {}
        for batch in slices(batches, "html"):
            texts = []
            for page, main in zip(batch["html"].to_pylist(), batch["main"].to_pylist(), strict=True):
                found = slots(page)
                key = (main, frozenset(name for name, _, _ in found))
                wanted = sets.get(key)
                if wanted is None:
                    if len(sets) > 10_000 or len(rows) > HOSTS_AT_ONCE:
                        sets.clear()
                        rows.clear()
                    if main not in rows:
                        rows[main] = json.loads(main or "[]")
                    wanted = sets[key] = frozenset(chosen(rows[main], key[1]))
                texts.append("\n".join(t for name, t, _ in found if name in wanted))
            yield pa.RecordBatch.from_arrays(
                [batch["page_id"], batch["url"], pa.array(texts, pa.string())], ["page_id", "url", "text"]
            )

    joined = wanted.join(F.broadcast(found) if size <= BROADCAST_BYTES else found, "host", "left")
    schema = pages.select("page_id", "url").schema.add("text", "string")
    out = joined.select("page_id", "url", "html", "main").mapInArrow(run, schema)
    return out.withColumn("n_chars", F.length("text").cast("long"))


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_texts(table(spark, sf_dir, "pages"))
