"""Exact search and main-text extraction against plain versions."""

import collections
import html
import json
import math
import os
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattlake.llm import components, html_text, topk

SF = "/root/testdata/sf0.01"


def best(rows, k):
    usable = [
        (i, v) for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    result = collections.Counter()
    for at, (q, v) in enumerate(usable):
        if q % 20 == 0:
            scored = sorted(
                (-sum(int(a) * int(b) for a, b in zip(v, w, strict=False)), i)
                for n, (i, w) in enumerate(usable) if n != at
            )
            result.update((q, n, i, -s) for n, (s, i) in enumerate(scored[:k], 1))
    return result


@pytest.mark.parametrize(("block", "query_block"), [(16384, 1024), (50, 3)])
def test_top_k_is_exact(spark, block, query_block):
    pick = np.random.default_rng(3)
    rows = [(i, np.round(pick.normal(0, 20, 24)).tolist()) for i in range(300)]
    rows += [(300 + i, rows[i][1]) for i in range(30)]  # ties
    rows += [(40, rows[7][1]), (40, rows[8][1]), (60, rows[60][1]), (60, rows[60][1]), (9, rows[9][1])]  # repeated
    rows += [
        (400, None), (420, [1.0, None]), (440, [math.nan] * 24), (460, [math.inf] * 24), (None, [1.0] * 24),
        (480, []), (500, [5.0]), (520, [0.0] * 24), (540, [2.0**40] * 24),
    ]
    vectors = spark.createDataFrame(rows, "vec_id long, vector array<double>").withColumn("score", F.lit(1))
    got = topk.top_k(vectors, F.col("vec_id") % 20 == 0, k=7, block=block, query_block=query_block)
    assert collections.Counter(tuple(r) for r in got.collect()) == best(rows, 7)


def test_few_candidates_and_none(spark):
    schema = "vec_id long, vector array<double>"
    three = spark.createDataFrame([(0, [1.0]), (20, [2.0]), (21, [2.0])], schema)
    got = {tuple(r) for r in topk.top_k(three, F.col("vec_id") % 20 == 0).collect()}
    assert got == {(0, 1, 20, 2), (0, 2, 21, 2), (20, 1, 21, 4), (20, 2, 0, 2)}
    assert topk.top_k(three.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert topk.top_k(three.filter("vec_id = 0"), F.col("vec_id") % 20 == 0).count() == 0


def test_rows_that_share_a_query_id_are_candidates(spark):
    rows = [(0, [1.0]), (0, [2.0]), (1, [1.0])]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, vector array<double>"), F.col("vec_id") % 20 == 0)
    assert collections.Counter(tuple(r) for r in got.collect()) == best(rows, 20) and got.count() == 4


def test_integers_beyond_doubles():
    q, x = np.array([2.0**31, 1.0]), np.array([[2.0**31, 1.0], [2.0**40, 0.0]])
    assert topk.exact_scores(q, x[:1]).tolist() == [2**62 + 1]
    with pytest.raises(OverflowError):
        topk.exact_scores(q, x)


def test_what_cannot_be_scored_is_an_error(spark):
    for value in (1e200, 2.0**40):
        rows = [(i, [value, float(i)]) for i in range(30)]
        with pytest.raises(Exception, match="OverflowError"):
            topk.top_k(spark.createDataFrame(rows, "vec_id long, vector array<double>"), F.col("vec_id") % 20 == 0).collect()


def test_bounds_are_bounds():
    pick = np.random.default_rng(5)
    q, x = pick.normal(0, 9, (20, 30)), pick.normal(1, 9, (50, 30))
    for n in (1, 4, 16, 30):
        bound = topk.segment_statistics(q, n) @ topk.segment_statistics(x, n).T
        assert (bound >= q @ x.T - 1e-9).all()


def test_components_of_a_graph(spark):
    pick = np.random.default_rng(6)
    edges = [(int(a), int(b)) for a, b in pick.integers(0, 400, (250, 2))]
    edges += [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2001 + i) for i in range(50)] + [(7, 7)]
    label = {x: x for e in edges for x in e}
    for _ in range(500):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    got = components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    alone = {x for x in label if all(x not in e or e == (x, x) for e in edges)}
    assert {r["node"]: r["component"] for r in got} == {x: c for x, c in label.items() if x not in alone}
    assert len(got) == len(label) - len(alone)
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a="<p>no</p>";</script></head>
<body><header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></ul></nav>
<div class="cookie-notice">We use cookies</div><div class="ad">Buy</div><!-- x --><article class="post"><h1>{title}</h1>
<p>First&nbsp;&amp; <b>bold<br>line</b> &#233;<p>Second
   paragraph<aside>side</aside><form><p>Mail</p><input></form><ul><li>one<li>two</ul>
<div class="advert">Ad</div><section id="comments"><p>Nice!</p></section></article><aside>related</aside>
<footer>&copy; me</footer></body></html>"""


def extracted(spark, rows, **options):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    return {r["page_id"]: r["text"] for r in html_text.extract_text(pages, **options).collect()}


def test_the_article_alone_remains(spark):
    got = extracted(spark, [(1, "http://a.example/1", PAGE.format(title="Head &lt;1&gt;"))])
    assert got[1] == "Head <1>\nFirst & bold line é\nSecond paragraph\none\ntwo"


def test_what_a_site_repeats_goes(spark):
    def page(i):
        return (
            f"<body><div><span>Our site</span><p>Call us</p></div><div><p>Text {i} of this page</p>"
            f"<p>More {i}</p></div><p>All rights reserved</p></body>"
        )

    rows = [(i, f"https://User@B.example:80/p/{i}?q", page(i)) for i in range(20)]
    rows += [(100, "http://other.example/", page(0))]
    got = extracted(spark, rows)
    assert all(got[i] == f"Text {i} of this page\nMore {i}" for i in range(20))
    assert got[100] == "Our site\nCall us\nText 0 of this page\nMore 0\nAll rights reserved"


def test_copies_of_an_article_are_not_template(spark):
    rows = [(i, f"http://a.example/{i}", PAGE.format(title="Same")) for i in range(15)]
    rows += [(50 + i, f"http://a.example/{50 + i}", f"<body><p>Same page {i // 20}</p></body>") for i in range(15)]
    got = extracted(spark, rows)
    assert {got[i] for i in range(15)} == {"Same\nFirst & bold line é\nSecond paragraph\none\ntwo"}
    assert {got[50 + i] for i in range(15)} == {"Same page 0"}


BOX = "<div><p>Share</p><ul><li>Mail<li>Print</ul></div>"


@pytest.mark.parametrize("tag", ["article", "main"])
def test_boxes_that_a_host_repeats_inside_articles_go(spark, tag):
    def page(i):
        return f"<body><{tag}><h1>Title {i}</h1><p>Text {i}<b>bold</b></p><h2>Steps</h2><p>Yes.</p>{BOX}</{tag}></body>"

    rows = [(i, f"http://a.example/{i}", page(i)) for i in range(12)] + [(50, "http://b.example/", page(50))]
    got = extracted(spark, rows)
    assert all(got[i] == f"Title {i}\nText {i}bold\nSteps\nYes." for i in range(12))
    assert got[50].endswith("Steps\nYes.\nShare\nMail\nPrint")


def test_near_copies_of_an_article_keep_what_they_share(spark):
    same = "".join(f"<p>{' '.join(f'w{k}x{n}' for n in range(12))}</p>" for k in range(3))
    # one title and one changed paragraph each; then each with a title of its own
    rows = [(i, f"http://a.example/{i}", f"<article><h1>One</h1><p>{'changed ' * 40}{i}</p>{same}</article>") for i in range(9)]
    rows += [(50 + i, f"http://b.example/{i}", f"<article><h1>No {i}</h1>{same}</article>") for i in range(9)]
    got = extracted(spark, rows)
    assert all(t.count("x11") == 3 for t in got.values()) and len(got) == 18


WRAPPERS = [
    "<form>{}</form>", '<div class="site has-sidebar">{}</div>', '<div class="header-fixed">{}</div>',
    '<div id="nav-wrapper"><form>{}</form></div>', '<main><h1>Site</h1><div class="has-sidebar">{}</div></main>',
]


@pytest.mark.parametrize("article", ["<article><p>The text of the page</p></article>", "<main><p>The text of the page</p></main>"])
def test_an_article_in_a_wrapper_stays(spark, article):
    rows = [(i, f"http://h{i}.example/", f"<body><nav>n</nav>{w.format(article)}</body>") for i, w in enumerate(WRAPPERS)]
    if article.startswith("<main"):
        rows.pop()
    assert set(extracted(spark, rows).values()) == {"The text of the page"}


def test_named_boxes_of_other_articles_still_go(spark):
    other = "<article><p>Another article, and longer than the one of the page is</p></article>"
    rows = [
        (i, f"http://h{i}.example/", f"<body><{tag}><p>Own text</p>{inner}</{tag}>{outer}</body>")
        for i, (tag, inner, outer) in enumerate([
            ("article", "", f'<div id="comments">{other}</div>'), ("article", f'<div class="related">{other}</div>', ""),
            ("main", "", f'<div class="related-posts">{other}</div>'), ("article", "", f"<aside>{other}</aside>"),
            ("article", "", f"<div hidden>{other}</div>"),
        ])
    ]
    assert set(extracted(spark, rows).values()) == {"Own text"}


@pytest.mark.parametrize("tag", ["article", "div"])
def test_a_box_on_many_pages_of_a_large_host_goes(spark, tag):
    long = f"<p>{' '.join(f'w{n}' for n in range(30))}</p>"

    def page(i):
        # a box on 6 % of the pages, a story with near copies on 6 %, and words alike by chance
        inner = BOX if i < 120 else f"{long}<p>Changed {i}</p>" if i < 240 else ""
        return f"<body><{tag}><h2>{'Story' if 120 <= i < 240 else f'Title {i}'}</h2><p>Own <b>{i % 17}</b> text {i}</p>{inner}</{tag}></body>"

    got = extracted(spark, [(i, f"http://a.example/{i}", page(i)) for i in range(2000)])
    assert all(got[i] == f"Title {i}\nOwn {i % 17} text {i}" for i in [*range(120), *range(240, 2000)])
    assert all("w0 w1" in got[i] and got[i].endswith(f"Changed {i}") for i in range(120, 240))


def test_odd_pages(spark):
    deep = "<div>" * 5000 + "deep" + "</div>" * 5000
    rows = [
        (1, None, None), (2, "", ""), (3, "no url", "just text"), (4, "http://x", "<p>open <b>never"),
        (5, "http://x", "</p></div>stray<"), (6, "http://x", deep), (7, "http://x", "<script>x<p>"),
        (8, "http://x", "<p>a<!-- open <p>b"), (9, "http://x", '<p title="a>b">c</p>'), (9, "http://x", '<p title="a>b">c</p>'),
        (10, "http://x", "a &lt;p&gt; &bogus; &#x41;"),
    ]
    got = extracted(spark, rows)
    assert got == {
        1: "", 2: "", 3: "just text", 4: "open never", 5: "stray<", 6: "deep", 7: "", 8: "a", 9: "c",
        10: "a <p> &bogus; A",
    }
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    clash = html_text.extract_text(pages.withColumns({"text": F.lit("t"), "host": F.lit("h"), "page": F.lit(1)}))
    assert set(clash.columns) == {"page_id", "url", "html", "text", "n_chars", "host", "page"}
    assert {r["host"] for r in clash.collect()} == {"h"} and clash.count() == len(rows)
    assert html_text.extract_text(pages.limit(0)).count() == 0


FORMS = {
    '<article><section id="search-results-explained"><p>a</p></section></article>': "a",
    '<article><p class="notice-board-history">a</p><p class="share-price">b</p><p class="h2 social-studies">c</p></article>': "a\nb\nc",
    "<article><!--> <p>a</p><!-- x --><!---><p>b</p><!-- <p>c</p> --!></article>": "a\nb",
    "<article></article><main><p>m</p></main><p>o</p>": "m",
    "<article><nav>n</nav></article><main></main><p>o</p>": "o",
    '<article><p>a</p><article class="comment"><p>c</p></article></article>': "a",
    '<article><p>a</p></article><article class="post comment-3"><p>c</p></article>': "a",
    '<article class="post comments-open has-comments"><p>a</p></article>': "a",
    "<article hidden><p>h</p></article><article><p>a</p></article>": "a",
    '<article><p>a</p><div style="color:red; DISPLAY : none">h</div><p style="color:red">b</p></article>': "a\nb",
    '<article><p title="hidden class=ad">a</p><p data-id="comments">b</p><p alt=\'id="ad"\'>c</p></article>': "a\nb\nc",
    '<article><p>a</p><p CLASS=ad id=x>b</p><p class="x" class="ad">c</p></article>': "a\nc",
    "<article><header><h1>H</h1></header><h2>T</h2><p>a</p></article>": "T\na",
    f'<article><p class="{"ad-" * 9000}">a</p></article>': "a",
} | {
    f'<article><p>a</p><div class="{name}"><p>x</p></div></article>': "a"
    for name in (
        "reviews", "discussion", "reader-feedback", "adsbygoogle", "adbox", "ad", "x ad-top", "cookieNotice",
        "related-posts", "site-footer", "widget_12", "social share", "comment-list", "main-nav", "ad1", "user-comments",
    )
}


def test_forms_of_pages(spark):
    rows = [(i, f"http://h{i}.example/", f"<body>{page}</body>") for i, page in enumerate(FORMS)]
    got = extracted(spark, rows)
    assert {page: got[i] for i, page in enumerate(FORMS)} == FORMS


def plain_blocks(root, template=frozenset()):
    """Blocks of a page, by walking its tree with the template known."""
    articles = html_text._articles(root)
    digests = html_text.article_hashes(articles) if articles else html_text.subtree_hashes(root)
    blocks, line = [], []

    def flush():
        text = " ".join(html.unescape("".join(line)).split())
        blocks.extend([text] if text else [])
        line.clear()

    def walk(one):
        if isinstance(one, str):
            line.append(one)
            return
        if one.name in html_text.BLOCK:
            flush()
        if one.name == "br":
            line.append(" ")
        elif not html_text.is_boilerplate(one) and digests.get(id(one)) not in template:
            for child in one.children:
                walk(child)
            if one.name in html_text.BLOCK:
                flush()

    for top in articles or [root]:
        walk(top)
    flush()
    return blocks


def plain_extraction(rows, share=0.2, least=5, many=100, least_share=0.001):
    """The whole operator over (id, host, html) rows in plain dictionaries."""
    parsed = {i: html_text.parse(page) for i, _, page in rows}
    inside, outside, piece = html_text._INSIDE, html_text._OUTSIDE, html_text._PIECE
    result = {}
    for host in {h for _, h, _ in rows}:
        own = {i: page for i, h, page in rows if h == host}
        articles = {i: html_text._articles(parsed[i]) for i in own}
        digests = {
            i: [set(html_text.subtree_hashes(parsed[i]).values()), set(html_text.article_hashes(articles[i]).values())]
            for i in own
        }
        text = {i: tuple(plain_blocks(parsed[i])) for i in own}
        totals = {True: len({text[i] for i in own if articles[i]}), False: len(set(own.values()))}

        def judged(seen, totals=totals):
            often, frequent = set(), set()
            for digest, keys in seen.items():
                total, n, kind = totals[digest[:1] == inside], len(keys), digest[:1]
                if n >= least and n >= share * total:
                    often.add(digest)
                elif n >= least and kind != piece and n >= max(many, least_share * total):
                    frequent.add(digest)
            return often, frequent

        seen = collections.defaultdict(set)
        for i, (around, within) in digests.items():
            for digest in around:
                seen[digest].add(own[i])
            for digest in within:
                seen[digest].add(text[i])
        often, frequent = judged(seen)
        sure = {d for d in often if d[:1] != inside}
        unsure = (often | frequent) - sure
        again = collections.defaultdict(set)
        for i, (around, within) in digests.items():
            if articles[i]:
                for digest in around & unsure:
                    again[digest].add(own[i])
            rest = plain_blocks(parsed[i], sure | unsure)
            before = plain_blocks(parsed[i], sure)
            if rest and sum(map(len, rest)) >= html_text.OWN_SHARE * sum(map(len, before)):
                for digest in (within if articles[i] else around) & unsure:
                    again[digest].add(("begins", rest[0]))
        template = sure.union(*judged(again))
        assert all(d[:1] in (inside, outside, piece) for d in template)
        result |= {i: "\n".join(plain_blocks(parsed[i], template)) for i in own}
    return result


@pytest.mark.parametrize("frame", ["<article>{}</article>", "<main>{}</main>", "{}"])
def test_outlines_keep_what_a_walk_of_the_tree_keeps(frame):
    """Random trees, blocks in inline elements included, under every kind of random template."""
    import random

    pick = random.Random(len(frame))

    def piece(depth):
        if depth == 0 or pick.random() < 0.3:
            return pick.choice(["a", " b c ", "&amp;", "&lt;d ", "<br>", "<img>", " ", "\n e"])
        tag = pick.choice(["p", "div", "b", "span", "ul", "li", "section", "nav", "td", "blockquote"])
        return f"<{tag}>{''.join(piece(depth - 1) for _ in range(pick.randrange(4)))}</{tag}>"

    changed = 0
    for _ in range(1500):
        root = html_text.parse(frame.format("".join(piece(5) for _ in range(4))))
        articles = html_text._articles(root)
        found = html_text.article_hashes(articles) if articles else html_text.subtree_hashes(root)
        known = sorted(set(found.values()))
        places = {node: known.index(d) for node, d in found.items()}
        parts = json.loads(json.dumps(html_text.outline(articles or [root], places)))
        whole = html_text.remaining(parts)
        assert whole == plain_blocks(root)
        for share in (0.1, 0.5):
            gone = {i for i in range(len(known)) if pick.random() < share}
            rest = html_text.remaining(parts, gone)
            assert rest == plain_blocks(root, {known[i] for i in gone})
            changed += rest != whole
    assert changed > 300


def test_extraction_equals_a_plain_version(spark):
    import random

    pick = random.Random(8)
    boxes = [f"<div><p>Box {k}</p><ul><li>one<li>two</ul></div>" for k in range(6)]
    rows = []
    for i in range(400):
        host = pick.choice(["a.example", "a.example", "b.example", f"c{i % 40}.example"])
        tag = pick.choice(["article", "main", "div", "section"])
        paragraphs = "".join(f"<p>{' '.join(pick.choices('abcdefgh', k=pick.randrange(1, 14)))}</p>" for _ in range(3))
        inner = "".join(b for k, b in enumerate(boxes) if pick.random() < 0.5 / (k + 1))
        outer = "".join(b for k, b in enumerate(boxes) if pick.random() < 0.4 / (k + 1))
        rows.append((i, host, f"<body><p>Site of {host}</p>{outer}<{tag}><h1>{i % 150}</h1>{paragraphs}{inner}</{tag}></body>"))
    rows += [(1000 + i, host, page) for i, (_, host, page) in enumerate(rows[:60])]
    expected = plain_extraction(rows, many=30)
    got = extracted(spark, [(i, f"http://{host}/{i}", page) for i, host, page in rows], many_pages=30)
    assert got == expected
    bare = {i: "\n".join(plain_blocks(html_text.parse(page))) for i, _, page in rows}
    assert sum(got[i] != bare[i] for i in got) > 100


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_pages_of_the_tables(spark):
    """Every article of the tables, by a regular expression for their few forms."""
    got = html_text.extract_text(spark.read.parquet(f"{SF}/pages.parquet")).collect()
    for r in got:
        article = re.search(r"<article>(.*?)</article>", r["html"], re.DOTALL)[1]
        parts = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>", "", article.replace("<br>", " ")))
        blocks = [" ".join(html.unescape(p).split()) for p in parts]
        assert r["text"] == "\n".join(b for b in blocks if b)
        assert r["n_chars"] == len(r["text"])
    assert len(got) == 250 and collections.Counter(r["page_id"] for r in got).most_common(1)[0][1] == 1
