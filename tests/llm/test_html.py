"""Page extraction: the article of the given pages, and layouts of many kinds."""

import html as entities
import random
import re

from quarry.llm import html
from quarry.llm import queries as q

SF = "/root/testdata/sf0.01"
SCHEMA = "page_id long, url string, html string, text string, host string, place string"


def plain_article(page):
    """Text of the article element of a given page, by pattern."""
    inner = re.search(r"<article>(.*?)(?:</article>|\Z)", page or "", re.S)
    if not inner:
        return ""
    bare = re.sub(r"</?(?:b|i|em|a)\b[^>]*>", "", inner[1])
    return " ".join(entities.unescape(re.sub(r"<[^>]*>", " ", bare)).split())


def test_query_gives_the_articles(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = q.op1_extract_html(spark, SF).collect()
    assert len(got) == len(pages)
    for r in got:
        assert r.url == pages[r.page_id].url and r.n_chars == len(r.text)
        assert r.text == plain_article(pages[r.page_id].html)


def words(rnd, n):
    return " ".join(rnd.choice("alpha beta gamma delta rho sigma tau phi".split()) + str(rnd.randrange(999)) for _ in range(n))


def layouts(rnd, k):
    """(page, main text) in a layout of each host."""
    title, paras = words(rnd, 5), [words(rnd, rnd.randint(15, 60)) for _ in range(rnd.randint(2, 6))]
    body = "".join(f"<p>{p}</p>" for p in paras)
    plain = " ".join([title, *paras])
    menu = "<ul><li><a href='/a'>Home</a><li><a href='/b'>News</a><li><a href='/c'>More</a></ul>"
    talk = f"<section id='comments'><h3>Comments</h3><article class='comment'><p>{words(rnd, 30)}</p></article></section>"
    yield "semantic.example", (
        f"<html><body><header>Site</header><nav>{menu}</nav><main><article><header><h1>{title}</h1></header>{body}"
        f"<aside>{words(rnd, 20)}</aside></article>{talk}</main><footer>c</footer></body></html>"), plain
    yield "named.example", (
        f"<body><div id=masthead>Site</div><div class='cookie-notice'>We use cookies {words(rnd, 9)}</div>"
        f"<div class='wrap'><div class='sidebar'>{words(rnd, 30)}</div><div class='post-content' id='post-{k}'><h1>{title}</h1>{body}"
        f"<div class='share-buttons'>Share</div><form><input value=x><label>Mail</label></form></div>"
        f"<div class='comment-list'><p>{words(rnd, 25)}</p></div></div><div id='footer'>{words(rnd, 12)}</div></body>"), plain
    yield "bare.example", (
        f"<BODY><DIV>Daily paper</DIV><DIV>{menu}</DIV><DIV><DIV><H1>{title}</H1>{body}<P>Read more in our paper</P></DIV></DIV>"
        f"<DIV>All rights reserved</DIV></BODY>"), plain
    yield "table.example", (
        f"<table width=100%><tr><td class=nav>{menu}<td class=story><h1>{title}</h1>{body}</table><p class=copyright>2020"), plain


def test_layouts(spark):
    rnd, rows, want = random.Random(7), [], {}
    for k in range(24):
        for host, page, plain in layouts(rnd, k):
            rows.append((len(rows), f"http://{host}/p/{k}?q#x", page, "clash", "clash", "clash"))
            want[rows[-1][0]] = plain
    got = {r.page_id: r.text for r in html.extract(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()}
    assert got == want


def test_broken_and_empty_pages(spark):
    cases = [
        (None, ""), ("", ""), ("just text &amp; more", "just text & more"), ("<p>a<p>b<b>c</p>d", "a bc d"),
        ("<script>var a = '<p>no</p>';</script><p>yes</p>", "yes"), ("<p>x &lt;b&gt; &#233;&#x4e2d; &nbsp; y", "x <b> é中 y"),
        ("<!-- <p>no</p> --><div>one<br>two<hr>three</div>", "one two three"), ("<p title='a>b'>in</p>", "in"),
        ("<p>cut <a href='x", "cut"), ("<p>1 < 2 and 3 > 2</p>", "1 < 2 and 3 > 2"), ("<style>p{}", ""),
        ("<div>" * 3000 + "deep" + "</div>" * 3000, "deep"), ("<p>" + "long " * 30000 + "</p>", ("long " * 30000).strip()),
        ("<nav>only a menu</nav>", ""), ("<p>a</p>\n\n<p hidden>no</p><p>b\tc</p>", "a b c"),
    ]
    rows = [(i, url, page, "", "", "") for i, (page, _) in enumerate(cases) for url in (None, f"https://h{i}.example/x")]
    got = html.extract(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.text == cases[r.page_id][1], r.page_id
    assert html.extract(spark.createDataFrame([], SCHEMA)).collect() == []


def test_alignment_makes_optional_and_repeated_items():
    def wrapper(*pages):
        made = [html.page_wrapper(html.read_page(p)) for p in pages]
        out = made[0]
        for m in made[1:]:
            out = html.align(out, m)
        return out

    w = wrapper("<div><h1>same</h1><p>a</p><p>b</p></div>", "<div><h1>same</h1><h2>x</h2><p>c</p></div>")
    div = w[html.CHILDREN][0]
    items = {c[html.KEY]: c for c in div[html.CHILDREN]}
    assert [c[html.KEY] for c in div[html.CHILDREN]] == ["h1", "h2", "p"]
    assert len(items["h1"][html.TEXTS]) == 1 and not items["p"][html.TEXTS]
    assert items["p"][html.REPEATED] and items["h2"][html.SEEN] == 1 and div[html.GROUP] == 0
    turned = wrapper("<div><h2>x</h2><p>a</p></div>", "<div><p>a</p><h2>x</h2></div>")[html.CHILDREN][0]
    assert turned[html.GROUP] == 1


def test_generated_names_keep_wrappers_small():
    rnd = random.Random(1)
    out = None
    for _ in range(40):
        page = "<div>" + "".join(f"<p class='c{rnd.choice('abcdef')}{rnd.choice('xyzuvw')}{chr(97 + rnd.randrange(26))}'>t</p>" for _ in range(9)) + "</div>"
        w = html.page_wrapper(html.read_page(page))
        out = w if out is None else html.align(out, w)
        assert len(out[html.CHILDREN][0][html.CHILDREN]) <= html.ITEMS + 9


def test_shared_text_by_one_rule_at_every_host_size(spark):
    rnd, rows, want = random.Random(9), [], {}
    for n in (5, 19, 21):
        for k in range(n):
            first, second = words(rnd, 20), words(rnd, 25)
            for kind, (start, end) in {
                "article": ("<article><p>Standing first line</p>", "<p>Standing last line</p></article>"),
                "bare": ("<div><div>", "<p>Read more in our paper</p></div></div>"),
            }.items():
                page = f"<body>{start}<p>{first}</p><h2>Ingredients</h2><p>{second}</p>{end}</body>"
                rows.append((len(rows), f"http://{kind}{n}.example/{k}", page, "", "", ""))
                text = f"{first} Ingredients {second}"
                want[rows[-1][0]] = f"Standing first line {text} Standing last line" if kind == "article" else text
    got = {r.page_id: r.text for r in html.extract(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()}
    assert got == want


def test_article_beside_many_named_siblings(spark):
    rnd, rows, want = random.Random(10), [], {}
    for k in range(60):
        text = words(rnd, 60)
        name = "".join(rnd.choice("abcdefgh") for _ in range(6))
        side = "".join(f"<div class='{name}{c}'><p>{words(rnd, 6)}</p></div>" for c in "xyz")
        for host, inner in (("article", f"<article><p>{text}</p></article>"), ("named", f"<div class='text'><p>{text}</p></div>")):
            # the named element holds nearly all of the text
            page = f"<body><div class=wrap>{side if host == 'article' else side[:side.index('</div>') + 6]}{inner}</div></body>"
            rows.append((len(rows), f"http://{host}.example/{k}", page, "", "", ""))
            want[rows[-1][0]] = text
    for host, inner in (("article", "<article><p>{}</p></article>"), ("named", "<div class='text'><p>{}</p></div>")):
        side = "".join(f"<div class='{''.join(rnd.choice('abcdefgh') for _ in range(6))}'><p>x</p></div>" for _ in range(70))
        text = words(rnd, 60)  # a page with more than 64 names of its own
        rows.append((len(rows), f"http://{host}.example/many", f"<body><div class=wrap>{side}{inner.format(text)}</div></body>", "", "", ""))
        want[rows[-1][0]] = text
    got = {r.page_id: r.text for r in html.extract(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()}
    assert got == want
