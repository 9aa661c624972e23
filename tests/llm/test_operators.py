import collections
import hashlib
import math
import random
import re
import struct
import zlib

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tidewater.llm import (
    chat, decontaminate, html_text, language, lm_score, near_dedup, pieces, quality, token_files, urls,
)
from tidewater.llm.common import tokenizer_path
from tidewater.llm.lattice import Lattice, Vocabulary

SPACE = r"[^\x20\x09-\x0D]+"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def remainder(doc_id, n):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % n


def test_lattice_sums_all_segmentations():
    vocabulary = Vocabulary(tokenizer_path("piece_bpe_32k.model"))
    own = ["the", "éa", "漢字", "a" * 70, ""]

    def brute(word):
        word, total = "▁" + word, [0.0]
        for j in range(1, len(word) + 1):
            terms = []
            for i in range(max(0, j - 16), j):
                row = vocabulary.rows.get(word[i:j])
                if row is not None:
                    terms.append(total[i] + math.log(vocabulary.prior[row]))
                elif j - i == 1:
                    parts = [vocabulary.prior[vocabulary.byte_rows[b]] for b in word[i:j].encode()]
                    terms.append(total[i] + sum(map(math.log, parts)))
            total.append(float(np.logaddexp.reduce(terms)))
        return total[-1]

    wanted = [brute(w) for w in own]
    for linear in (False, True):
        found = Lattice(vocabulary, vocabulary.prior, linear).score(own)[:, 0]
        assert np.allclose(found, wanted, rtol=1e-9)
    counts = Lattice(vocabulary, vocabulary.prior).expected(["ab"], np.ones((1, 1)))[:, 0]
    length = {row: len(piece) for piece, row in vocabulary.rows.items()}
    assert math.isclose(sum(counts[r] * length.get(r, 0) for r in np.flatnonzero(counts)), 3, rel_tol=1e-9)


def test_lm_scores(docs, rows, no_docs):
    got = collections.Counter(
        (r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in lm_score.lm_scores(docs).collect()
    )
    split = [(r[0], remainder(r[0], 10) == 0, re.findall(SPACE, lower(r[1])) + [None]) for r in rows]
    counts = collections.Counter(w for _, held, ws in split if not held for w in ws)
    n, v = sum(counts.values()), len(counts)
    base = lambda ws: round(sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws), 6)
    assert got == collections.Counter((i, h, len(ws), sum(w in counts for w in ws), n, base(ws)) for i, h, ws in split)
    found = lm_score.lm_scores(docs).collect()
    assert all(math.isfinite(r.score) and r.score < 0 for r in found)
    assert lm_score.lm_scores(no_docs).collect() == []


def test_rare_words_join_like_frequent_ones(docs, monkeypatch):
    whole = {r.doc_id: r.score for r in lm_score.lm_scores(docs).collect() if r.doc_id not in (None, 100)}
    monkeypatch.setattr(lm_score, "FREQUENT_WORDS", 3)
    for r in lm_score.lm_scores(docs).collect():
        if r.doc_id in whole:
            assert math.isclose(r.score, whole[r.doc_id], rel_tol=1e-9)


def test_languages(docs, rows, no_docs):
    found = language.languages(docs).collect()
    assert len(found) == len(rows)
    by = {r.doc_id: r for r in found}
    for i, text, lang, *_ in rows:
        if i is not None and i < 60:
            assert by[i].lang_pred == lang and by[i].held_out == (remainder(i, 4) == 2)
    assert [by[i].lang_pred for i in (104, 105, 106)] == ["und"] * 3
    assert all(0 <= r.score <= 1 for r in found)
    assert language.languages(no_docs).collect() == []
    kept = language.known_language(docs)
    assert kept.columns == docs.columns and {104, 105, 106}.isdisjoint(r.doc_id for r in kept.collect())


def test_pieces_equal_the_library(docs, rows, no_docs):
    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    wanted = collections.Counter()
    for i, text, *_ in rows:
        ids = library.encode(text or "")
        wanted[i, tuple(ids), library.decode(ids)] += 1
    out = pieces.decode(pieces.encode(docs.select("doc_id", "text", "ids")))
    assert collections.Counter((r.doc_id, tuple(r.ids), r.decoded) for r in out.collect()) == wanted
    assert pieces.encode(no_docs).collect() == []
    encoder = pieces.MergeEncoder(tokenizer_path("piece_bpe_32k.model"))
    for ids in ([35, 400, 0, 7], [198, 131], [1, 261, 2], [231, 160]):
        assert encoder.decode(ids) == library.decode(ids)
    assert encoder._merged_long("▁thingamajig") == encoder.merged("▁thingamajig")


def test_token_files(spark, docs, rows, no_docs, tmp_path):
    path = tokenizer_path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    token_files.write_token_files(docs, str(tmp_path / "a"), path)
    out = token_files.with_crc32(token_files.read_token_files(spark, str(tmp_path / "a"))).collect()
    out.sort(key=lambda r: r.start)
    start = 0
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()))
    for row, r in zip(order, out, strict=True):
        ids = tokenizer.encode(row[1] or "", add_special_tokens=False).ids + [1]
        assert tuple(r) == (row[0], start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))
        start += len(ids)
    token_files.write_token_files(no_docs, str(tmp_path / "b"), path)
    assert token_files.read_token_files(spark, str(tmp_path / "b")).collect() == []


def test_word_encoder_at_punctuation():
    path = tokenizer_path("word_bpe_49k.json")
    own, whole = token_files.WordEncoder(path), Tokenizer.from_file(path)
    text = "It's Don't. 'tis... a”., e\u0301. 12.5, <|endoftext|> <|ENDOFTEXT|> ½. ²! x'S!"
    for part in (text, text.replace("<|", "")):
        ids = np.frombuffer(own.encode([part.encode()])[0], np.int32).tolist()
        assert ids == whole.encode(part, add_special_tokens=False).ids


def test_quality(spark, docs, rows, no_docs):
    labels = spark.createDataFrame([(i, int(i % 5 > 0)) for i in range(60)] + [(None, 1), (1, None)], "doc_id long, quality int")
    found = quality.verdicts(docs, labels).collect()
    assert len(found) == len(rows)
    by = {r.doc_id: r for r in found}
    for i, text, *_ in rows:
        if i is None:
            continue
        text = text or ""
        ws = re.findall(SPACE, text)
        windows = collections.defaultdict(list)
        for k in range(len(ws) - 7):
            windows[tuple(ws[k : k + 8])].append(k)
        repeated = len({p for at in windows.values() if len(at) > 1 for k in at for p in range(k, k + 8)})
        seen, dup = set(), 0
        for line in text.split("\n"):
            if re.search(SPACE, line):
                dup += line in seen
                seen.add(line)
        want = (len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text)), dup, repeated)
        assert (by[i].n_words, by[i].word_chars, by[i].n_symbols, by[i].n_dup_lines, by[i].n_repeat_words) == want
        assert by[i].base_failed == (len(ws) < 20 or 100 * repeated > 30 * len(ws))
        assert not (by[i].kept and by[i].base_failed)
    assert quality.verdicts(no_docs, labels).collect() == []
    assert quality.good_documents(docs, labels.limit(0)).count() == sum(not r.base_failed for r in found)


def test_forest_finds_rows_outside_the_good_ones():
    good = np.random.default_rng(1).normal(0.1, 0.01, (300, 8)).clip(0)
    good[:, 0] = 0.0
    random = np.random.default_rng(2)
    high = np.full(8, 1.0)
    trees = [quality._tree(good[random.choice(300, 128)], np.zeros(8), high, random) for _ in range(50)]
    bad = good[:20].copy()
    bad[:, 0] = 0.8
    forest = quality.Forest(trees, 128)
    assert forest.scores(bad).min() > np.quantile(forest.scores(good), 0.99)


def test_near_duplicates(docs, rows, no_docs):
    found = near_dedup.near_duplicates(docs).collect()
    assert len(found) == len(rows)
    bags = [near_dedup.shingles((r[1] or "").encode()) for r in rows]
    label = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            linked = (rows[a][1] or "") == (rows[b][1] or "") or (
                len(bags[a][0]) and len(bags[b][0]) and near_dedup.overlap(bags[a], bags[b]) >= 0.8
            )
            if linked and label[a] != label[b]:
                old, new = max(label[a], label[b]), min(label[a], label[b])
                label = [new if x == old else x for x in label]
    groups = collections.defaultdict(list)
    for k, x in enumerate(label):
        groups[x].append(rows[k][0])
    wanted = collections.Counter()
    for ids in groups.values():
        least = min((i for i in ids if i is not None), default=None)
        wanted.update((i, least, len(ids)) for i in ids)
    assert collections.Counter(map(tuple, found)) == wanted
    kept = near_dedup.one_of_each(docs)
    assert kept.columns == docs.columns and kept.count() == len(groups)
    assert near_dedup.near_duplicates(no_docs).collect() == []


def test_near_copies_of_a_few_texts(spark):
    """Most copies are near their original but not near each other, and many are near neither."""
    pick = random.Random(3)
    fresh = (f"n{k}" for k in range(10**6))

    def edited(text, n):
        out = text.split()
        for _ in range(n):
            at = pick.randrange(len(out))
            out[at : at + pick.choice([0, 1, 1, 1, 2])] = [next(fresh)] * pick.choice([0, 1, 1, 1, 3])
        return " ".join(out)

    first = " ".join(f"w{pick.randrange(90)}" for _ in range(140))
    second, third = edited(first, 4), edited(first, 8)
    texts = [edited(pick.choice([first, first, second, third]), pick.randrange(1, 9)) for _ in range(220)]
    texts += [edited(pick.choice(texts), 1) for _ in range(60)] + [first, second]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bags = [near_dedup.shingles(t.encode()) for t in texts]
    label = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if label[a] != label[b] and near_dedup.overlap(bags[a], bags[b]) >= 0.8:
                old, new = max(label[a], label[b]), min(label[a], label[b])
                label = [new if x == old else x for x in label]
    assert 20 < len(set(label)) < 200
    found = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(docs).collect()}
    assert [found[i] for i in range(len(texts))] == label


def test_differences_of_linked_texts_meet_in_the_prefix():
    pick = np.random.default_rng(4)
    met = 0
    for _ in range(3000):
        n = int(pick.integers(20, 60))
        leader = set(range(n))
        x = {k for k in leader if pick.random() > 0.15} | set(range(100, 100 + int(pick.integers(0, 12))))
        y = {k for k in x if pick.random() > 0.06} | set(range(200, 200 + int(pick.integers(0, 4))))
        x, y = (x, y) if pick.random() < 0.5 else (y, x)
        if len(x & y) / len(x | y) >= 0.8 > len(x & leader) / len(x | leader):
            met += 1
            shared = (x ^ leader) & (y ^ leader)
            assert len(shared) >= near_dedup.shared_needed(len(y ^ leader), n, len(y)) >= 1
    assert met > 100


def test_signatures_estimate_weighted_similarity():
    a = {i: w for i, w in enumerate([1, 1, 2, 3, 9, 40] * 20)}
    b = {i: max(1, w - (i % 3)) for i, w in a.items() if i % 10}
    errors = []
    for seed in range(40):
        def sign(x, seed=seed):
            keys = near_dedup._mix(np.array(sorted(x), np.uint64) + np.uint64(1 + 10**6 * seed))
            return near_dedup.signature(keys, np.array([x[i] for i in sorted(x)]))
        errors.append((sign(a) == sign(b)).mean())
    true = sum(min(a[i], b.get(i, 0)) for i in a) / sum(max(a[i], b.get(i, 0)) for i in a)
    assert abs(np.mean(errors) - true) < 0.03


def test_leaks(spark, docs, no_docs):
    first = docs.where("doc_id = 100").first().text.split()
    changed = first[20:70]
    changed[1] = "other"
    items = [(1, " ".join(first[30:60])), (2, "absent words of no document here"), (3, None), (4, "12 !! 34"),
             (5, " ".join(changed).upper()), (6, "")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.document_leaks(docs, benchmark).collect()
    by = collections.defaultdict(set)
    for r in found:
        by[r.item_id].add(r.doc_id)
    assert by[1] == {100, 101, 102, 103, None} and by[4] == {106} and by[5] == {100, 101, 102, 103, None}
    assert set(by) == {1, 4, 5}
    assert all(r.start == 30 and r.similarity == 1.0 for r in found if r.item_id == 1)
    kept = decontaminate.without_leaks(docs, benchmark)
    assert kept.columns == docs.columns
    assert {100, 101, 102, 103, 106, None}.isdisjoint(r.doc_id for r in kept.collect())
    assert decontaminate.document_leaks(no_docs, benchmark).collect() == []
    assert decontaminate.document_leaks(docs, benchmark.limit(0)).collect() == []


def test_chat_round_trip(spark):
    said = "</s>[INST] ok [/INST]"
    texts = [said, "a\\b \\</s> [INST]\\", None, "", "<\\/s>", "[/INST]" * 3, "plain\n"]
    rows = [(1, k, "assistant" if k % 2 else "us[/INST]er", t) for k, t in enumerate(texts)]
    rows += [(2, 0, None, "x"), (None, 0, "assistant", "y")]
    turns = chat.canonical_turns(spark.createDataFrame([(*r, 9) for r in rows], "conv_id long, turn int, role string, text string, id int"))
    back = chat.parsed(chat.formatted(turns))
    assert sorted((str(r.conv_id), r.turn, r.role, r.text) for r in back.collect()) == sorted(
        (str(c), t, r or "", x or "") for c, t, r, x in rows
    )
    for r in chat.formatted(turns).collect():
        assert r.formatted.count("</s>") == 1 and r.formatted.count("[/INST]") == 1
    digest = {r.conv_id: r for r in chat.conversation_digests(back).collect()}
    loss = "".join(t or "" for k, t in enumerate(texts) if k % 2)
    assert digest[1].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert (digest[1].n_turns, digest[1].loss_chars, set(digest)) == (len(texts), len(loss), {1, 2, None})


def test_layouts_by_fingerprint(spark):
    records = ['{"prompt": "p", "response": "r", "more": 1}', '{"messages": [{"role": "user", "content": "hi"}]}',
               '{"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": null}]}',
               '{"instruction": "do", "input": "this", "output": "done"}', "no json", None]
    df = spark.createDataFrame(list(enumerate(records)), "conv_id int, raw string")
    got = sorted((r.conv_id, r.turn, r.role, r.text) for r in chat.canonical_json(df, "raw").collect())
    assert got == [(0, 0, "user", "p"), (0, 1, "assistant", "r"), (1, 0, "user", "hi"), (2, 0, "user", "q"), (2, 1, "assistant", ""),
                   (3, 0, "user", "do\nthis"), (3, 1, "assistant", "done"), (4, -1, "unmapped", "no json"), (5, -1, "unmapped", "")]
    typed = spark.createDataFrame([(7, [("human", "a")])], "id int, conversations array<struct<from:string,value:string>>")
    assert [tuple(r) for r in chat.canonical_turns(typed, "id").collect()] == [(7, 0, "user", "a")]
    with pytest.raises(ValueError):
        chat.canonical_turns(df)


def test_url_verdicts_and_links(spark):
    link = '<a href="http://{}/x">t</a>'
    rows = [
        (1, "http://A.b.NET/x?q", ""), (2, "http://example.net/en/1", None), (3, "no url", ""), (4, None, ""),
        (5, "https://farm.test/a", link.format("a.b.net")), (6, "https://fine.test", link.format("other.test")),
        (7, "http://x.example.com/de/?", ""), (8, "http://notnet/de/", ""), (8, "http://notnet/de/", ""),
    ]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, rule string")
    got = collections.Counter((r.page_id, r.host, r.path, r.rule, r.verdict) for r in urls.url_verdicts(pages).collect())
    assert got == collections.Counter([
        (1, "a.b.net", "/x", "net/", "block"), (2, "example.net", "/en/1", "example.net/en/", "allow"), (3, "", "", None, "allow"),
        (4, "", "", None, "allow"), (5, "farm.test", "/a", None, "block"), (6, "fine.test", "", None, "allow"),
        (7, "x.example.com", "/de/", "example.com/de/", "block"), (8, "notnet", "/de/", None, "allow"), (8, "notnet", "/de/", None, "allow"),
    ])
    assert urls.url_verdicts(pages.limit(0)).collect() == []


def test_html_main_text(spark):
    page = ("<title>t</title><nav><a href=x>menu</a></nav><div class='cookie-notice'>c</div><article><h1>T{0}</h1><p>One &amp;\n two<p><b>x{0}"
            "<br>y</b></p><script>var a='</p>';</script><!-- <p>no</p> --><div class=comments><p>nice</p></div></article><footer>f</footer>")
    plain = "<body><div id=top><p>Site</p></div><div id=body><p>Long text number {0} of the page</p><p>and {0} more</p></div></body>"
    rows = [(k, "http://a.test/", page.format(k)) for k in range(4)] + [(10 + k, "http://b.test/", plain.format(k)) for k in range(4)]
    rows += [(20, None, None), (21, "http://c.test", ""), (22, "http://c.test", "<p>broken <b")]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, text string")
    got = {r.page_id: (r.text, r.n_chars) for r in html_text.main_texts(pages).collect()}
    assert got[2][0] == "T2\nOne & two\nx2 y" and got[12][0] == "Long text number 2 of the page\nand 2 more"
    assert got[20] == ("", 0) and got[21] == ("", 0) and all(n == len(t) for t, n in got.values())
    assert html_text.main_texts(pages.limit(0)).collect() == []


def test_wrapper_alignment():
    a = html_text.Wrapper.of_page([("h", "x", False), ("p", "1", False), ("p", "2", False), ("f", "same", False)])
    b = html_text.Wrapper.of_page([("h", "y", False), ("q", "1", False), ("p", "3", False), ("f", "same", False)])
    a.merge(b)
    assert a.expression() == "h (q)? (p)+ f" and a.held["f"][2] != -1 and a.held["h"][2] == -1
    a.merge(html_text.Wrapper.of_page([("f", "same", False), ("h", "z", False)]))
    assert a.groups == [["h", "p", "f", "q"]] or len(a.groups) == 1


def test_html_templates_of_one_host(spark):
    """A page without the host's article falls back to its own changing slots; fixed notices go."""
    new = "<nav><a href=x>menu</a></nav><article><h1>T{0}</h1><p>First {0} of new</p><p>Second {0}</p><div><p>Subscribe now</p></div></article>"
    old = ("<div id=top><p>Site</p></div><div id=text><h2>Old {0}</h2><p>Old text number {0} of the page</p><ul><li>item {0} here</ul>"
           "<p>and {0} more</p></div><div id=low><p>All rights {0}</p></div>")
    rows = [(k, "http://a.test/", new.format(k)) for k in range(4)] + [(10 + k, "http://a.test/", old.format(k)) for k in range(4)]
    # Copies are no evidence that a text is fixed.
    rows += [(20 + k, "http://b.test/", "<article><h1>T</h1><p>one</p></article>") for k in range(4)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_text.main_texts(pages).collect()}
    for k in range(4):
        assert got[k] == f"T{k}\nFirst {k} of new\nSecond {k}"
        assert got[10 + k] == f"Old {k}\nOld text number {k} of the page\nitem {k} here\nand {k} more"
        assert got[20 + k] == "T\none"


def test_html_names_that_only_look_like_other_purposes(spark):
    page = ("<body class='no-sidebar single post'><div class='nav-primary'><a href=x>home</a> <a href=y>more</a></div>"
            "<main class='site-main has-sidebar sidebar'><article class='post comments-open' id=post-{0}>"
            "<h2 id='related-work'>Work {0}</h2><p id=search>Text {0}</p><h3 id='search'>Market {0}</h3>"
            "<div class='related box'><p>see {0}</p></div></article></main></body>")
    widget = "<body><div class='widget'><p>All there is on {0}</p></div></body>"
    rows = [(k, "http://a.test/", page.format(k)) for k in range(3)] + [(10 + k, "http://b.test/", widget.format(k)) for k in range(3)]
    got = {r.page_id: r.text for r in html_text.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for k in range(3):
        assert got[k] == f"Work {k}\nText {k}\nMarket {k}"
        assert got[10 + k] == f"All there is on {k}"


def test_pieces_are_kept_for_later_tasks(spark, docs):
    """A worker process makes its encoder once, and finds the words of earlier tasks in it."""
    path = pieces.tokenizer_path("piece_bpe_32k.model")
    texts = docs.select("doc_id", "text").coalesce(1)
    first = pieces.encode(texts, keep_words=True).collect()

    def words(batches):
        import pyarrow as pa
        import pyspark

        yield from ()
        encoder = pyspark.__dict__.get("_kept_by_tidewater", {}).get(f"merge encoder of {path}")
        yield pa.RecordBatch.from_pydict({"n": [len(encoder.words.new) if encoder else 0]})

    found = spark.range(64).repartition(64).mapInArrow(words, "n long").collect()
    assert max(r.n for r in found) > 100
    assert sorted(map(str, pieces.encode(texts, keep_words=True).collect())) == sorted(map(str, first))
