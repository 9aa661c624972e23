import collections
import random

import numpy as np

from tidewater.llm import urls

FOLDER = "/root/testdata/sf0.001"


def brute_rank(n, links, seeds, against):
    """Sums of all steps, to the end, over a dense matrix."""
    w = np.zeros((n, n))
    for (a, b), k in links.items():
        w[(b, a) if against else (a, b)] += k
    all_of = w.sum(axis=1, keepdims=True)
    w = np.divide(w, all_of, out=np.zeros_like(w), where=all_of > 0)
    return np.linalg.solve(np.eye(n) - urls.DAMPING * w.T, seeds)


def test_spread_equals_solving_for_all_steps(spark):
    pick = random.Random(5)
    n = 30
    links = collections.Counter((pick.randrange(n), pick.randrange(n)) for _ in range(90))
    links.update({(k, (k + 1) % 5): 3 for k in range(5)})  # a dense ring
    links = {k: v for k, v in links.items() if k[0] != k[1]}
    trust, distrust = (np.array([pick.choice([0, 0, 0, 1, 0.5]) for _ in range(n)], float) for _ in range(2))
    edges = spark.createDataFrame([(f"h{a}", f"h{b}", k) for (a, b), k in links.items()], "src string, dst string, n long")
    seeds = spark.createDataFrame([(f"h{k}", float(trust[k]), float(distrust[k])) for k in range(n)], "host string, trust double, distrust double")
    got = {r.host: (r.trust, r.distrust) for r in urls.spread(edges, seeds).collect()}
    wanted = np.stack([brute_rank(n, links, trust, False), brute_rank(n, links, distrust, True)], axis=1)
    found = np.array([got.get(f"h{k}", (0.0, 0.0)) for k in range(n)])
    assert np.abs(found - wanted).max() <= urls.TOLERANCE


def test_a_chain_is_followed_as_far_as_the_tolerance(spark):
    edges = spark.createDataFrame([(f"h{k}", f"h{k + 1}", 1) for k in range(15)], "src string, dst string, n long")
    seeds = spark.createDataFrame([("h15", 0.0, 1.0), ("h0", None, -1.0)], "host string, trust double, distrust double")
    got = {r.host: r.distrust for r in urls.spread(edges, seeds).collect()}
    assert all(abs(got[f"h{15 - k}"] - urls.DAMPING**k) < 1e-9 for k in range(16))


def test_a_rule_for_a_part_does_not_block_the_host(spark):
    rows = [(1, "http://example.com/de/1", ""), (2, "http://example.com/en/1", ""), (3, "http://a.net/", "")]
    rows += [(4, "http://friend.test/", '<a href="//a.net/">x</a>'), (5, "http://cousin.test/", '<a href="//example.com/">x</a>')]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.verdict for r in urls.url_verdicts(pages).collect()}
    assert got == {1: "block", 2: "allow", 3: "block", 4: "block", 5: "allow"}


def test_op7_over_its_table(spark):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet").collect()
    got = {r.page_id: r for r in urls.op7_urls(spark, FOLDER).collect()}
    assert len(got) == len(pages)
    for page in pages:
        rest = (page.url or "").partition("://")[2] if "://" in (page.url or "") else ""
        cut = min([k for k in map(rest.find, "/?#") if k >= 0], default=len(rest))
        host, path = rest[:cut].lower(), rest[cut:].split("?")[0].split("#")[0]
        fits = [(h + p, v) for v, h, p in urls.RULES if path.startswith(p) and (host == h or host.endswith("." + h))]
        rule, verdict = max(fits, key=lambda x: len(x[0])) if fits else (None, "allow")
        assert (got[page.page_id].host, got[page.page_id].path, got[page.page_id].rule) == (host, path, rule)
        assert got[page.page_id].verdict == verdict  # no page links to another host
