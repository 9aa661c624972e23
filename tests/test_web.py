import itertools
import subprocess
import sys
import unicodedata
from urllib.parse import urljoin

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tidewater.functions import html, urls
from tidewater.operators import cards
from tidewater.operators import elements
from tidewater.operators.cards import keyword_card_links, select_cards
from tidewater.operators.links import keyword_page_links, page_links

BASES = [
    "http://h.org", "http://h.org/", "https://h.org/a/b?x=1#f", "https://h.org/a/b/",
    "http://h.org//a//b/c", "HTTP://H.org/a", "http://u:p@h.org:80/a;p/b;q?x#y", "ftp://h.org/a/b",
    "/a/b", "a/b", "", "mailto:a@b.c", "http://h.org/a/./b/../c", " http://h.org/x ", "file:///a/b",
    "http://[::1]/a", "http://h.org?x=1", "//h.org/a/b", "svn+ssh://h/a/b",
]
LINKS = [
    "", "/", "//", "///x", "x", "x/", "x/y", "/x", "/x/y/", "//g", "//g/x/../y", "?q", "?", "#f", "#",
    ";p", "x;p", "x;p?q#f", "/x;p/y;q", ".", "./", "..", "../", "../x", "../../x", "../../../x",
    "/./x", "/../x", "/x/.", "/x/..", "/x//y", "x//y", "//g//x", "./x/./y", "x/../y", "g.", ".g", "g..",
    "..g", "http://o.org/x/../y", "http:x", "http:", "https://o.org", "mailto:x@y.z", "javascript:void(0)",
    "HTTPS://O.org/A?b#c", "x y", " x", "x\ty", "x?a/../b", "x#a/../b", "1:2", "a:b", "a.b:c/d",
    "/The", "/the,", "/et.", "/für", "/a?b=c&d", "x?y#z?w", "?y#z", "/%2e%2e/x", "..;p", "x/..;p", "/x\n",
    "//g?y", "//g#s", "http://[::1]/x", "//[v1.a]/x", "data:,x", "ftp:x", "/a;b", "/;", ";", "x?", "x#",
]
INVALID = ["http://[::1", "http://::1]/x", "//[x]/y", "//[1.2.3.4]/y", "http://ℂ／x/y", "//a＃b"]


def expected_join(base, link):
    try:
        return urljoin(base, link)
    except ValueError:
        return None


def test_resolve_links_equals_urljoin(spark):
    pairs = list(itertools.product(BASES, LINKS + INVALID))
    df = spark.createDataFrame(pairs, "base string, link string").repartition(4)
    got = {(r.base, r.link): r.full for r in urls.resolve_links(df, "base", "link", "full").collect()}
    wrong = [
        (b, l, got.get((b, l)), expected_join(b, l))
        for b, l in pairs
        if got.get((b, l)) != expected_join(b, l)
    ]
    assert wrong == []


def test_unsafe_host_characters_follow_their_rule():
    """All of them lie in the basic plane's compatibility blocks."""
    found = [
        c for c in map(chr, [*range(0x80, 0xD800), *range(0xE000, 0x10000)])
        if set(unicodedata.normalize("NFKC", c)) & set("/?#@:")
    ]
    assert "".join(found) == urls.UNSAFE_HOST_CHARS


def test_page_links_are_sets_per_page(spark):
    pages = spark.createDataFrame(
        [
            ("http://h.org/a/", '<a href="x"><a href="x"><a href="./x"><a href=\'no\'><a href="/y">'),
            ("http://h.org/b", "nothing"),
            ("http://h.org/c", '<a HREF="no"><link href="//g/z"><a href="http://[bad">'),
            ("http://h.org/d", 'href="br\noken" href="p q"'),
            ("http://h.org/e", None),
        ],
        "url string, html string",
    )
    assert sorted(map(tuple, page_links(pages).collect())) == [
        ("http://h.org/a/", "http://h.org/a/x"),
        ("http://h.org/a/", "http://h.org/y"),
        ("http://h.org/c", "http://g/z"),
        ("http://h.org/d", "http://h.org/p q"),
    ]


JOBS = """
<html><body><div class="card-content"><h2 class="title">Outside</h2></div>
<div id="ResultsContainer" class="columns">
  <div class="card"><div class="card-content"><div class="media">
    <h2 class="title is-5"> Chief <b>Python</b> Keeper </h2>
    <h3 class="subtitle company">Larkspur &amp; Moth</h3></div>
    <div class="content"><p class="location">Nethercombe<br></p></div>
    <footer><a href="https://l.org/1">Learn</a><a>no</a><a href="/apply/1?a=1&amp;b=2">Apply</a></footer></div></div>
  <div class="card"><div class="card-content"><div class="media">
    <h2 class="title is-5">Bell founder</h2><script>var h = "<h2>x</h2>";</script></div>
    <p class="location">Saltmarsh</p><a href="/apply/2">Apply</a></div></div>
  <div class="card"><div class="card-content"><div><div><h2 class="title">python</h2></div></div>
    <p>unclosed<a href="/apply/3">Apply</a></div></div>
</div>
<div class="card-content"><h2 class="title">After</h2></div></body></html>
"""
FIELDS = {"title": ("h2", "title"), "company": ("h3", "company"), "location": ("p", "location")}


@pytest.fixture(scope="module")
def jobs(spark):
    return spark.createDataFrame([(1, JOBS), (2, "<p>no cards"), (3, None)], "page_id int, html string")


def test_cards(jobs):
    got = select_cards(jobs, ("div", "card-content"), FIELDS, container_id="ResultsContainer")
    assert [tuple(r) for r in got.orderBy("page_id", "card_no").collect()] == [
        (1, 0, "Chief Python Keeper", "Larkspur & Moth", "Nethercombe",
         ["https://l.org/1", "/apply/1?a=1&b=2"]),
        (1, 1, "Bell founder", None, "Saltmarsh", ["/apply/2"]),
        (1, 2, "python", None, None, ["/apply/3"]),
    ]
    assert select_cards(jobs, ("div", "card-content"), FIELDS).count() == 5


def test_broken_pages_do_not_fail_the_job(spark):
    broken = ["<div><p>a</p></div><![foo[ <div><p>b", "<div><p>c<!", "<div <p>d</p>", "</div></p>", "<", "\x00"]
    pages = spark.createDataFrame(list(enumerate(broken)), "page_id int, html string")
    got = select_cards(pages, ("p", None), {}).select("page_id").distinct().collect()
    assert {r[0] for r in got} >= {0, 1}


def test_parser_runs_where_the_package_is_missing(tmp_path):
    code = (
        "import pickle, sys; parse = pickle.load(sys.stdin.buffer); "
        "print(next(parse('<div><p> x&amp;y<p>z').find_all('p')).text())"
    )
    done = subprocess.run(
        [sys.executable, "-c", code], input=cloudpickle.dumps(cards._parse),
        cwd=tmp_path, capture_output=True, check=True,
    )
    assert done.stdout.decode().strip() == "x&yz"


def test_many_pages_pass_in_slices(spark):
    pages = spark.range(500, numPartitions=2).select(
        F.col("id").alias("page_id"),
        F.when(F.col("id") % 2 == 0, F.concat(F.lit("<p>x<p>"), F.col("id").cast("string"))).alias("html"),
    )
    got = select_cards(pages, ("p", None), {}).groupBy("page_id").count().collect()
    assert {r["page_id"]: r["count"] for r in got} == {i: 2 for i in range(0, 500, 2)}


def test_links_of_keyword_cards(jobs):
    cards = select_cards(jobs, ("div", "card-content"), FIELDS, container_id="ResultsContainer")
    got = keyword_card_links(cards.select("title", "links"), "title", "PYTHON")
    assert sorted(map(tuple, got.collect())) == [
        ("Chief Python Keeper", "/apply/1?a=1&b=2"),
        ("Chief Python Keeper", "https://l.org/1"),
        ("python", "/apply/3"),
    ]


def test_links_of_an_ancestor(jobs):
    headings = select_cards(
        jobs, ("div", "media"), {"title": ("h2", None)}, link_ancestor=("title", 3)
    )
    got = {r["title"]: r["links"] for r in headings.collect()}
    assert got["Bell founder"] == ["/apply/2"]


def test_element_texts(spark):
    page = (
        '<h1 class="a">One &amp;amp; &lt;b&gt;</h1><h1>two<br><i>x</i> </h1><H1>no</H1>'
        '<div class="x ad y">A</div><div class="ads">B</div><div data-c="1" class="ad">C</div><h10>n</h10>'
    )
    df = spark.createDataFrame([(page,), (None,)], "html string")
    row = df.select(
        html.element_texts(F.col("html"), "h1").alias("h1"),
        html.element_texts(F.col("html"), "div", "ad").alias("ad"),
    ).first()
    assert row["h1"] == ["One &amp; <b>", "twox", "no"]
    assert row["ad"] == ["A", "C"]


ODD_PAGES = [
    "<H1 Class='x'>Caps &eacute;&Eacute; &#233;&#xE9; &hellip;&amp;lt; &nosuch; &#0; &</H1>",
    "<!-- <h1>gone</h1> --><script>'<h1>gone</h1>'</script><h1 title='a > b'>kept</h1>",
    "<h1 class=ad>bare</h1><h1 class='big ad'>single</h1><h1 class=\"ad\" id=x>double</h1><h1 data-class='ad'>no</h1><h1 class=Ad>no</h1>",
    "<h1>a<!-- x > y -->b</h1><style>h1{}</style><h1>c &lt;i&gt; &#128512;</h1>",
]


@pytest.mark.parametrize("class_", [None, "ad"])
def test_native_texts_agree_with_the_parser_on_odd_pages(spark, class_):
    pages = spark.createDataFrame(list(enumerate(ODD_PAGES)), "page_id int, html string")
    native = {r.page_id: r.t for r in pages.select("page_id", html.element_texts(F.col("html"), "h1", class_).alias("t")).collect()}
    cards = select_cards(pages, ("h1", class_), {})
    wanted = {k: [] for k in native}
    nodes = elements.element_nodes(pages, "page_id")
    heads = nodes.where("tag = 'h1'")
    if class_:
        heads = heads.where(F.array_contains("classes", class_))
    for r in elements.element_texts(nodes, heads.select("page_id", "node", "last"), "page_id").orderBy("node").collect():
        wanted[r.page_id].append(r.title)
    assert cards.count() == sum(map(len, wanted.values()))
    # The parser replaces the reference to no character; the expression leaves it.
    assert {k: [t.replace("&#0;", "\ufffd") for t in ts] for k, ts in native.items()} == wanted



def test_elements_and_keyword_cards(spark):
    page = (
        "<div id=all><div class='card a'><div><p><h2>Old <b>Bell</b> founder</h2></p><a href=/1>x</a></div><a href=/2>y</a>"
        "<section><div class='card b'><div><p><h2>bell boy</h2></p></div><a href=/3>z</a></div></section></div>"
        "<a href=/4>w</a><h2>BELL</h2><script>var h2 = '<h2>bell</h2>'</script></div>"
    )
    pages = spark.createDataFrame([(1, page), (2, None), (3, "<h2>bell</h2>"), (4, "")], "page_id int, html string")
    nodes = elements.element_nodes(pages, "page_id").cache()
    root = cards._parse(page)
    order = [root, *root.walk()]
    rows = [r for r in nodes.orderBy("node").collect() if r.page_id == 1 and r.tag != "#text"]
    assert [r.tag for r in rows] == [e.tag for e in order[1:]]
    for r, e in zip(rows, order[1:]):
        below = [x.tag for x in rows if r.node < x.node <= r.last]
        assert below == [x.tag for x in e.walk()]
        parent = [x.tag for x in rows if x.node == r.parent]
        assert parent == ([e.parent.tag] if e.parent is not root else [])
    got = elements.keyword_cards(nodes, "page_id", "h2", "bell").collect()
    by_title = {}
    for r in got:
        by_title.setdefault(r.title, set()).add(r.link)
    assert by_title == {"Old Bell founder": {"/1", "/2", "/3"}, "bell boy": {"/3"}}
    assert set(nodes.where("page_id in (2, 4)").collect()) == set()


def test_native_texts_agree_with_the_parser_on_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", "html")
    native = pages.select(
        "page_id", F.get(html.element_texts(F.col("html"), "h1"), F.lit(0)).alias("title")
    )
    parsed = select_cards(pages, ("article", None), {"title": ("h1", None)})
    assert sorted(map(tuple, native.collect())) == sorted(
        map(tuple, parsed.select("page_id", "title").collect())
    )


def test_keyword_page_links(spark):
    pages = spark.createDataFrame(
        [(1, '<h1>Big <i>PyThon</i></h1><a href="/1"><a href="/2">'), (2, '<h1>x</h1><a href="/3">'),
         (3, 'python<a href="/4">')],
        "page_id int, html string",
    )
    got = keyword_page_links(pages, "python").collect()
    assert sorted(map(tuple, got)) == [(1, "/1"), (1, "/2")]
