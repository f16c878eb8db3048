from __future__ import annotations

import math
import random
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tideline.llm import ann, html_main

VECTORS = "vec_id long, embedding array<float>, score string, rank int"


def vectors(spark, points, extra=()):
    rows = [(i, [float(np.float32(x)) for x in p], "s", 0) for i, p in points]
    return spark.createDataFrame(rows + list(extra), VECTORS)


def brute(points, top):
    clean = [(i, np.array(p, dtype=np.float32).astype(float)) for i, p in points]
    matrix = np.array([v for _, v in clean])
    for n, (i, v) in enumerate(clean):
        if i % 20 == 0:
            scores = (matrix * v).sum(axis=1)
            order = sorted((-s, j, m) for m, (s, (j, _)) in enumerate(zip(scores, clean)) if m != n)
            yield i, [(j, -s) for s, j, _ in order[:top]]


def search(spark, docs, **options):
    rows = ann.nearest(docs, F.col("vec_id") % 20 == 0, **options).collect()
    found = {}
    for r in sorted(rows, key=lambda r: r["rank"]):
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return found


def clusters(n, dims=16, seed=3):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(12, dims))
    return [(i, centres[i % 12] * (1 + i % 3) + draw.normal(size=dims) * 0.6) for i in range(n)]


def test_recall_and_exact_scores(spark):
    points = clusters(3000)
    found = search(spark, vectors(spark, points), top=20)
    hits = []
    lookup = {i: np.array(p, dtype=np.float32).astype(float) for i, p in points}
    for query, want in brute(points, 20):
        got = found[query]
        assert [r for r, _, _ in got] == list(range(1, 21))
        assert all(s == (lookup[i] * lookup[query]).sum() and i != query for _, i, s in got)
        assert [(-s, i) for _, i, s in got] == sorted((-s, i) for _, i, s in got)
        hits.append(len({i for i, _ in want} & {i for _, i, _ in got}) / 20)
    assert np.mean(hits) >= 0.9


def test_all_candidates_when_few_and_what_takes_no_part(spark):
    points = [(i, [i + 1.0, 1.0, 0.5]) for i in range(7)]
    bad = [(100, None, "s", 0), (120, [0.0, 0.0, 0.0], "s", 0), (140, [1.0, None, 2.0], "s", 0), (160, [math.nan, 1.0, 1.0], "s", 0),
           (180, [math.inf, 1.0, 1.0], "s", 0), (200, [1.0], "s", 0), (None, [1.0, 2.0, 3.0], "s", 0), (220, [], "s", 0)]
    found = search(spark, vectors(spark, points, bad))
    want = dict(brute(points, 20))
    assert {q: [(i, s) for _, i, s in rows] for q, rows in found.items()} == want
    assert search(spark, vectors(spark, [], bad[:4])) == {}
    assert search(spark, vectors(spark, [])) == {}


def test_ties_go_to_the_smaller_id_and_copies_count(spark):
    points = [(i, [1.0, 2.0]) for i in range(400)] + [(40, [1.0, 2.0])]
    found = ann.nearest(vectors(spark, points), F.col("vec_id") == 40, top=5).collect()
    # Two query rows share the id; each has the other as a candidate.
    assert Counter((r["query_id"], r["rank"], r["vec_id"]) for r in found) == Counter({(40, k + 1, k): 2 for k in range(5)})


def test_probes_go_by_the_distance_to_the_edges():
    tables = ann.Tables(4, 1, 3, 2.0, 5, 1)
    point = np.random.default_rng(2).normal(size=(1, 4))
    cell, rest = tables.cells(point, 0)
    cost = [sum((1 - r) ** 2 if m == 1 else r ** 2 if m == -1 else 0 for m, r in zip(move, rest[0])) for move in tables.moves]
    best = {int((cell[0] + tables.moves[k]) @ tables.code) for k in np.argsort(cost)[:5]}
    tables.buckets = [(np.array(sorted(best)), np.arange(5))]
    assert tables.candidates(point, 5).all()


PAGE = """<!DOCTYPE html><html><head><title>Not this</title><style>p{}</style><script>var x = "<p>no</p>";</script></head><body>
<header>Top</header><nav><ul><li><a href="/">Home</a></li></ul></nav><!-- note <p>no</p> --><div class="ad">Buy</div>
<article><h1>Head &amp; line</h1><p><b>First&nbsp;part,<br>second   part of the text, which is long enough.
<p>Café &#233; &lt;tag&gt; a < b</p><form><input value="no">no</form><div class="post-comments">reader says</div></article>
<aside>Side</aside><footer>&copy; End"""


def text_of(source):
    page = html_main.Page(source)
    return page.text({page.best()})


def test_article_without_what_surrounds_it():
    assert text_of(PAGE) == ("Head & line\n\nFirst part, second part of the text, which is long enough.\n\nCafé é <tag> a < b")


def test_broken_markup_and_odd_pages():
    assert text_of("") == "" and text_of("plain & simple") == "plain & simple"
    assert text_of("<html><head><title>x</title><body><p>no closing head, still text here to be read") == "no closing head, still text here to be read"
    assert text_of("<nav><ul><li>menu<article><p>inside an open menu, the article's own text</article>") == "inside an open menu, the article's own text"
    assert text_of("<div><p>one</div></div></p><p>two") == "one\n\ntwo"
    assert text_of("<p title='a>b'>quoted") == "quoted"
    assert text_of("<p>" + "x " * 300000).count("x") == 300000


def test_hosts_agree_on_paths(spark):
    body = "A sentence of the article, with commas, that is long enough to count. "
    page = "<body><div class='main-{0}'><p>{1}</p></div><div class='list'><p>{2}</p></div></body>"
    rows = [(i, f"http://a.example/{i}", page.format(i, body * 3, "teaser"), "old", 1) for i in range(8)]
    # Alone, the list of this page would win.
    rows.append((8, "https://A.example:80/odd", page.format(8, "Short.", body * 5), "old", 1))
    rows += [(9, None, None, None, None), (10, "not a url", "", "x", 2), (11, "http://b.example/", page.format(1, "Short.", body * 5), "x", 3)]
    rows += [rows[0]]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    got = html_main.main_text(pages)
    assert got.columns == ["page_id", "url", "html", "text", "n_chars"]
    got = got.collect()
    assert len(got) == len(rows)
    texts = {r["page_id"]: r["text"] for r in got}
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert texts[8] == "Short." and texts[0] == (body * 3).strip()
    assert texts[11] == (body * 5).strip() and texts[9] == "" == texts[10]
    assert html_main.main_text(pages.limit(0)).collect() == []


def test_vectors_of_another_length_only_lose_themselves(spark):
    draw = np.random.default_rng(8)
    rows = [(i, [float(x) for x in draw.normal(size=3)]) for i in range(60)] + [(60, [1.0, 2.0, 3.0, 4.0])]
    got = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0).collect()
    assert len(got) == 60 and {r["query_id"] for r in got} == {0, 20, 40}


SENTENCE = "A sentence of the article, with commas, that is long enough to count here."


@pytest.mark.parametrize("source,want", [
    (f'<div class="layout has-sidebar"><article><p>{SENTENCE}</p></article></div>', SENTENCE),
    (f'<article class="post comment-status-open"><p>{SENTENCE}</p></article>', SENTENCE),
    (f'<div id="content" class="with-nav"><p>{SENTENCE}</p></div>', SENTENCE),
    (f'<div class="ad">Buy<article><p>{SENTENCE}</p></article>', SENTENCE),
    (f'<article><div class="post-header"><h1>Head</h1></div><p>{SENTENCE}</p></article>', f"Head\n\n{SENTENCE}"),
    (f'<body><div class="content"><div class="intro"><p>{SENTENCE}</p></div><div class="body"><p>{SENTENCE}</p><p>{SENTENCE}</p></div></div>',
     "\n\n".join([SENTENCE] * 3)),
    (f'<body><div class="content"><h1>Head</h1><div><div class="body"><p>{SENTENCE}</p></div></div></div>', f"Head\n\n{SENTENCE}"),
    (f'<body><div class="nav-wrap"><p>{SENTENCE}</p></div><div class="comments"><p>{SENTENCE * 2}</p></div></body>', SENTENCE),
    (f'<article><p>{SENTENCE}</p><div id="comments"><article><p>{SENTENCE * 9}</p></article></div></article>', SENTENCE),
    (f'<div class="related"><article><p>{SENTENCE * 5}</p></article></div><article><p>{SENTENCE}</p></article>', SENTENCE),
    ("<ul><li>a<li>b<ul><li>c</ul>d<li>e</ul>", "a\n\nb\n\nc\n\nd\n\ne"),
])
def test_articles_in_usual_layouts(source, want):
    assert text_of(source) == want


@pytest.mark.parametrize("source", [
    "<a " * 66_000, "<li>x" * 50_000, "<td>x" * 50_000, "<div>x" * 50_000, "<a \"'>x" * 50_000 + '"', "<!--" * 50_000, "<script>" * 50_000,
    "<article>" * 30_000 + "x", "<div>" * 30_000 + "<li></li>" * 30_000, "<div>" * 20_000 + "<article>" + "<section>x</div>" * 20_000,
    "<div>" * 20_000 + "<nav><article></article></nav>" * 20_000], ids=lambda s: s[:14])
def test_long_broken_pages_take_time_by_their_length(source):
    def seconds(text):
        begun = time.process_time()
        text_of(text)
        return time.process_time() - begun

    assert seconds(source) < 6


def test_implied_ends_do_not_nest():
    assert len(set(map(html_main.Page("<table>" + "<tr><td>x" * 300).path, range(601)))) == 4
    page = html_main.Page("<div>" * 300 + SENTENCE)
    assert page.path(page.best()).count("/") == html_main.PATH_STEPS - 1


def test_generated_pages_lose_nothing_and_gain_nothing(spark):
    draw = random.Random(6)
    around = ["<nav><a href='/'>Home</a> menu</nav>", "<div class='ad'>Buy this, now, today, or never again in your life.</div>",
              "<aside><p>Aside, with commas, and a long enough sentence.</p></aside>", "<footer>End</footer>", "<script>if (a < b) {}</script>",
              "<div class='cookie-notice'><p>We use cookies, as all do, on all of our pages.</p></div>", "<form><input>Mail</form>",
              "<section id='comments'><article><p>A reader says, at length, that this is wrong.</p></article></section>"]
    shapes = ["<div class='layout has-sidebar'><article>{0}{1}</article></div>", "<main>{0}{1}</main>",
              "<div class='story-{2}'><div class='intro'>{0}</div><div class='rest'>{1}</div></div>", "<div class='post with-nav'>{0}{1}</div>"]

    def blocks(count):
        made = [(draw.choice(["<p>{}</p>", "<p>{}", "<blockquote>{}</blockquote>", "<ul><li>{}</ul>"]), f"{SENTENCE} Number {draw.random()} &amp; <b>more</b>.")
                for _ in range(count)]
        return "".join(shape.format(text) for shape, text in made), [t.replace("&amp;", "&").replace("<b>", "").replace("</b>", "") for _, t in made]

    rows, want = [], {}
    for number in range(200):
        host = number % 8
        first, second = blocks(draw.randint(2, 4)), blocks(draw.randint(2, 4))
        before, after = (draw.sample(around, draw.randint(0, 4)) for _ in range(2))
        # Two templates on each host.
        body = shapes[(host + number // 8 % 2) % 4].format(first[0], second[0], number)
        rows.append((number, f"http://h{host}.example/{number}", f"<html><body>{''.join(before)}{body}{''.join(after)}</body></html>"))
        want[number] = "\n\n".join(first[1] + second[1])
    # The path that the host agrees on is there, but empty.
    rows.append((200, "http://h1.example/odd", f"<html><body><main></main><section class='x'><p>{SENTENCE}</p></section></body></html>"))
    want[200] = SENTENCE
    got = html_main.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r["page_id"]: r["text"] for r in got} == want
