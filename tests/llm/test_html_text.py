import random

from tidewater.llm import html_text

SCHEMA = "page_id long, url string, html string"


def texts_of(spark, bodies, host="h.test"):
    pages = spark.createDataFrame([(k, f"http://{host}/{k}", b) for k, b in enumerate(bodies)], SCHEMA)
    return [r.text for r in html_text.main_texts(pages).orderBy("page_id").collect()]


def words(pick, n):
    return " ".join(f"w{pick.randrange(10_000)}" for _ in range(n))


def test_a_heading_and_a_byline_that_all_articles_have_stay(spark):
    pick = random.Random(1)
    own = [[words(pick, 30) for _ in range(3)] for _ in range(6)]
    bodies = [
        f"<nav><a href='/'>Home</a></nav><article><h1>{a}</h1><p class='byline'>By A. Writer</p><p>{b}</p>"
        f"<h2>Summary</h2><p>{c}</p><div class='x'><p>Read our terms before you go on.</p></div></article><footer>Us</footer>"
        for a, b, c in own
    ]
    assert texts_of(spark, bodies) == [f"{a}\nBy A. Writer\n{b}\nSummary\n{c}" for a, b, c in own]


def test_formulas_and_noscript_text_of_an_article_stay(spark):
    pick = random.Random(2)
    own = [words(pick, 20) for _ in range(3)]
    bodies = [f"<article><p>{t} <math><mi>x{k}</mi><mo>+</mo><mn>{k}</mn></math> holds</p><noscript><p>Figure {k}</p></noscript><script>var a</script></article>" for k, t in enumerate(own)]
    assert texts_of(spark, bodies) == [f"{t} x{k}+{k} holds\nFigure {k}" for k, t in enumerate(own)]


def test_comment_lists_and_sign_ups_in_an_article_go(spark):
    pick = random.Random(3)
    for name in ("comment-list", "newsletter-signup", "post-comments", "site_footer", "related-links"):
        own = [(words(pick, 20), words(pick, 60)) for _ in range(3)]
        bodies = [f"<article><p>{a}</p><div class='{name}'><p>{b}</p></div></article>" for a, b in own]
        assert texts_of(spark, bodies) == [a for a, _ in own], name
    for name in ("no-sidebar", "has-comments", "post-content", "share-prices", "searching"):
        own = [(words(pick, 20), words(pick, 60)) for _ in range(3)]
        bodies = [f"<article><p>{a}</p><div class='{name}'><p>{b}</p></div></article>" for a, b in own]
        assert texts_of(spark, bodies) == [f"{a}\n{b}" for a, b in own], name


def test_a_long_listing_beside_main_is_not_the_text(spark):
    pick = random.Random(4)
    own = [words(pick, 10) for _ in range(4)]
    bodies = [f"<main><p>{t}</p></main><div class='all'>{''.join(f'<p>{words(pick, 40)}</p>' for _ in range(40))}</div>" for t in own]
    assert texts_of(spark, bodies) == own


def test_pages_of_two_templates_on_one_host(spark):
    pick = random.Random(5)
    own = [words(pick, 40) for _ in range(6)]
    bodies = [f"<article><p>{t}</p></article>" if k % 2 else f"<div id='top'><p>Same</p></div><div class='story'><p>{t}</p></div>" for k, t in enumerate(own)]
    assert texts_of(spark, bodies) == own


def test_the_wrapper_holds_every_page(spark):
    """The expression of a host, against the pages it came from: every page's slots are in
    its order of groups, and only slots that a page lacks are optional."""
    pick = random.Random(6)
    kinds = ["h1", "p", "ul", "blockquote", "h2", "pre"]
    pages = []
    for _ in range(40):
        inner = "".join(f"<{t}>{words(pick, 3)}</{t}>" for t in pick.sample(kinds, pick.randint(1, 6)))
        pages.append(f"<article><h1>{words(pick, 2)}</h1>{inner}<p>{words(pick, 4)}</p></article>")
    whole = html_text.Wrapper()
    for page in pages:
        whole.merge(html_text.Wrapper.of_page(html_text.slots(page)))
    place = {name: k for k, group in enumerate(whole.groups) for name in group}
    repeated = {k for k, group in enumerate(whole.groups) if len(group) > 1 or whole.held[group[0]][1]}
    for page in pages:
        names = [name for name, _, _ in html_text.slots(page)]
        order = [place[n] for n in names]
        assert all(a < b or (a == b and a in repeated) for a, b in zip(order, order[1:]))
    for name, held in whole.held.items():
        assert held[0] == sum(name in [n for n, _, _ in html_text.slots(p)] for p in pages)
