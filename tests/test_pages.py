import hashlib
import random
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from reelpress.functions import html as H
from reelpress.operators import pages as P

LONG = "long text " * 11  # 110 characters before stripping
PAGES = {
    "plain": f"<title>T</title><h1> A <b>b</b> &amp; c</h1><article>{LONG}</article>",
    "empty heading": f"<title>T &copy; x</title><h1> </h1><article>{'x' * 100}</article>",
    "nothing": "<p>hello</p>",
    "script": f"<h1>S</h1><article>{'y' * 60}<script>var t='</p></article>';</script>{'z' * 60}</article>",
    "exactly": f"<article>{'x' * 101}</article>",
}


@pytest.fixture
def pages(spark):
    rows = [(k, f"http://h/{k}", v) for k, v in PAGES.items()]
    return spark.createDataFrame(rows, "name string, url string, html string")


EXPECTED = {
    "plain": ("A b & c", LONG.strip()),
    "empty heading": ("T © x", H.NO_CONTENT),
    "nothing": (H.NO_TITLE, H.NO_CONTENT),
    "script": ("S", "y" * 60 + "z" * 60),
    "exactly": (H.NO_TITLE, "x" * 101),
}


def test_native_and_parsed_agree(pages):
    for df in (P.read_pages(pages), P.parse_pages(pages)):
        assert {r.name: (r.title, r.content) for r in df.collect()} == EXPECTED


def test_class_selectors(spark):
    html = f"""<html><div class="x story-title"><h1></h1></div><h1></h1>
      <div class="big-title-box"><h1>Boxed</h1></div>
      <div class="my content"><p>{LONG}<div>inner<style>p{{}}</style></div></div>
      <article>short</article><div class="main-body">{LONG}</div></html>"""
    row = P.parse_pages(spark.createDataFrame([(html,)], "html string")).first()
    # the first heading of the page and of the first matching place are empty
    assert row.title == H.NO_TITLE
    assert row.content.startswith("long text") and row.content.endswith("inner")


def test_later_title_places(spark):
    html = "<h1> </h1><div class='headline'><h1>no</h1></div><div class='entry-title'><h1>Yes</h1></div>"
    assert P.parse_pages(spark.createDataFrame([(html,)], "html string")).first().title == "Yes"


LINKS = """<a href="#frag">x</a><a href="">x</a><a href="/2024/x">x</a>
  <a class="q" href="https://h.example/STORY/y">x</a><h2><a href="https://h.example/STORY/z">x</a></h2>
  <div class="story-card"><a href="story/r">x</a></div><a href="/a/article/b">x</a>
  <a href="/2024/x">x</a><a href="/other">x</a><a href="/story/s?a=1&amp;b=2">x</a>"""


def test_links(spark):
    pages = spark.createDataFrame([(1, LINKS)], "page_id int, html string")
    base = "https://base.example/"
    native = [r.link for r in P.extract_links(pages, base).orderBy("position").collect()]
    assert native == [
        "https://base.example/2024/x", "https://base.example/story/s?a=1&b=2",
        "https://base.example/a/article/b", "https://base.example/story/r",
        "https://h.example/STORY/z",
    ]
    parsed = P.parse_pages(pages)
    full = P.extract_links(parsed, base, links=F.col("links")).orderBy("position").collect()
    assert [r.link for r in full] == native


def test_article_records(spark):
    parsed = spark.createDataFrame(
        [("u1", "On ACME", "c" * 2001), ("u2", "none", "about tcs"), ("u3", "no", "no")],
        "url string, title string, content string",
    )
    now = F.lit("2024-02-01 06:30:00").cast("timestamp")
    got = {
        (r.url, r.keyword): r
        for r in P.extract_articles(parsed, ["acme", "TCS"], F.lit("s"), now).collect()
    }
    assert set(got) == {("u1", "acme"), ("u2", "TCS")}
    one = got[("u1", "acme")]
    assert len(one.content) == 2003 and len(one.full_content) == 2001
    assert one.s3_raw_content_path == f"article_content/acme/{one.content_hash}_20240201_063000.json"


def test_posts(spark):
    feed = spark.sql(
        "SELECT array(named_struct('title', 'On TCS', 'excerpt', '', 'url', 'u1'),"
        " named_struct('title', 'x', 'excerpt', 'tcs too', 'url', CAST(NULL AS STRING)),"
        " named_struct('title', 'x', 'excerpt', CAST(NULL AS STRING), 'url', 'u3')) AS posts"
    )
    got = P.posts_matching(feed, ["TCS"]).collect()
    assert [(r.position, r.url) for r in got] == [(0, "u1"), (1, "")]


NESTED = {
    "articles": f"<h1>N</h1><article>{LONG}<article>inner</article>after</article><article>next</article>",
    "class": f"<title>C</title><div class='x entry-content y'>{LONG}<div>in</div>out</div><p>no</p>",
    "part of class": f"<div class=\"main-body\"><section>{LONG}</section></div>",
    "short first": f"<div class='content'>short</div><article>{LONG}</article>",
    "bare class": f"<DIV CLASS=story-body>{LONG}</DIV>rest",
    "title in class": f"<h1> </h1><div class='headline'><p>x</p></div><div class='headline'><h1>Yes</h1></div>{LONG}",
    "comment": f"<!-- <article>{LONG}</article> --><article>{LONG}<!-- </article> --> end</article>",
    "no end": f"<article>{LONG}",
    "other tags": f"<articles>no</articles><article>{LONG}</article>",
}
NESTED_LINKS = """<a href='/2024/single'>x</a><a title="q" href=/2024/bare>x</a><A HREF="/2024/double">x</A>
  <div class="story-card"><div><a href='/story/in-card'>x</a></div><a href="/article/card-2">x</a></div>
  <h3><a href="http://h.example/article/heading">x</a></h3><a data-href="/2024/not-this">x</a>
  <!-- <a href="/2024/hidden">x</a> --><h2>t<a href="/other/in-heading">x</a></h2>"""


def test_native_equals_general_on_nested_pages(spark):
    rows = [(k, v) for k, v in NESTED.items()]
    df = spark.createDataFrame(rows, "name string, html string")
    native = {r.name: (r.title, r.content) for r in P.read_pages(df).collect()}
    general = {r.name: (r.title, r.content) for r in P.parse_pages(df).collect()}
    assert native == general
    assert native["articles"] == ("N", f"{LONG}innerafter") and native["title in class"][0] == "Yes"


def test_native_links_in_all_quotes(spark):
    df = spark.createDataFrame([(1, NESTED_LINKS), (2, None)], "page_id int, html string")
    native = P.extract_links(df, "http://h.example").select("position", "link").collect()
    parsed = P.parse_pages(df)
    general = P.extract_links(parsed, "http://h.example", links=F.col("links"))
    assert sorted(native) == sorted(general.select("position", "link").collect())
    assert {r.link.rsplit("/", 1)[-1] for r in native} == {
        "single", "bare", "double", "in-card", "card-2", "heading",
    }


def test_keywords_of_a_stock_table(spark):
    stocks = spark.createDataFrame(
        [("A", ["acme", "shared"]), ("B", ["shared", ""]), ("C", None)], "name string, keywords array<string>"
    )
    df = spark.createDataFrame([(1, "ACME here", None), (2, "x", "Shared"), (3, "no", "no")], "n int, a string, b string")
    got = P.explode_stock_keywords(df, ["a", "b"], stocks).collect()
    assert sorted((r.n, r.stock_name, r.keyword) for r in got) == [
        (1, "A", "acme"), (2, "A", "shared"), (2, "B", "shared"),
    ]


def test_keyword_table_by_brute_force(spark):
    """Short and long keywords, repeated rows, equal texts, case, surrogate pairs and clashing names."""
    rng = random.Random(4)
    letters = "aab bcÉé😀"
    text = lambda n: "".join(rng.choices(letters, k=n))
    rows = [(i % 40, text(rng.randrange(60)), rng.choice([None, "", text(9)])) for i in range(60)]
    rows += rows[:3]
    words = [text(rng.randrange(7)) for _ in range(200)] + [None, "", "B", "É"]
    df = spark.createDataFrame(rows, "n int, a string, _gram string")
    table = spark.createDataFrame([(w,) for w in words], "keyword string")
    got = P.match_keywords(df, ["a", "_gram"], table, rarity_share=0.5)
    assert got.columns == [*df.columns, "keyword"]
    want = [
        (*r, w) for r in rows for w in {w for w in words if w}
        if any(w.lower() in (x or "").lower() for x in r[1:])
    ]
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, want))
    assert P.match_keywords(df, ["a"], table.where("false")).count() == 0


def test_long_text_grams_are_linear(spark):
    long = spark.range(1).select(F.repeat(F.lit("abcé "), 400_000).alias("t"))
    assert long.select(F.size(P.grams(F.col("t")))).first()[0] == 15


class Elements(HTMLParser):
    """All elements of a page: name, class, target, elements around it and text, for comparison."""

    def __init__(self, page):
        super().__init__()
        self.all, self.open = [], []
        self.feed(page)
        self.close()

    def handle_starttag(self, tag, attrs):
        given = dict(attrs)
        one = (tag, given.get("class", ""), given.get("href", ""), list(self.open), [])
        self.all.append(one)
        if tag not in H.VOID:
            self.open.append(one)

    def handle_endtag(self, tag):
        places = [n for n, one in enumerate(self.open) if one[0] == tag]
        if places:
            del self.open[places[-1] :]

    def handle_data(self, data):
        for one in self.open:
            one[4].append(data)


def by_parser(page):
    found = Elements(page).all

    def at(one, place):
        if place.startswith("<"):
            return one[0] == place.strip("<>")
        return place[1:] in one[1] if place[0] == "*" else place in one[1].split()

    def texts(test):
        return ["".join(one[4]).strip() for one in found if test(one)][:1]

    titles = [
        t for above, tag in H.TITLE_PLACES
        for t in texts(lambda e: e[0] == tag and (not above or any(at(o, above) for o in e[3])))
        if t and t != H.NO_TITLE
    ]
    bodies = [
        t for place in H.CONTENT_PLACES for t in texts(lambda e: at(e, place)) if len(t) > H.MIN_BODY
    ]
    anchors = [e for e in found if e[0] == "a"]
    links = [e[2] for mark in H.ARTICLE_MARKS for e in anchors if mark in e[2]]
    links += [e[2] for p in H.LINK_PLACES for e in anchors if any(at(o, p) for o in e[3])]
    return (titles or [H.NO_TITLE])[0], (bodies or [H.NO_CONTENT])[0], links


def test_outline_equals_a_parser_on_random_pages(spark):
    """Unclosed, stray and crossed tags, void ones, all quotes, pages of several blocks."""
    rng = random.Random(11)
    classes = ["content", "x story-title", "big-title", "story-card", "main-body y", "entry-content", "headline"]
    tags = ["h1", "div", "p", "article", "h2", "section", "title", "b"]

    def piece():
        kind, tag = rng.random(), rng.choice(tags)
        if kind < 0.35:
            quote = rng.choice("'\"")
            return f"<{tag} id=k class={quote}{rng.choice(classes)}{quote}>" if rng.random() < 0.4 else f"<{tag}>"
        if kind < 0.6:
            return f"</{tag}>"
        if kind < 0.7:
            return f"<a href={rng.choice(['/story/1', '/2024/q', '/no'])} title='a > b'>t</a>"
        return rng.choice(["<br>", "plain words here ", "3 < 4 ", "long " * 9, "<img src=x>", "<!-- <h1> -->"])

    pages = ["".join(piece() for _ in range(rng.choice([5, 40, 900]))) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(pages)), "n int, html string")
    got = {r.n: (r.title, r.content, r.links) for r in P.parse_pages(df).collect()}
    assert got == {n: by_parser(page) for n, page in enumerate(pages)}


def test_grams_of_no_keyword_are_not_shuffled(spark):
    """What meets keywords by gram, and what goes to the texts, is dealt once each."""
    import re

    rows = [(i, f"only {i} of these words {i * 7919} is looked for " + "xyz" * (i % 3)) for i in range(40)] * 2
    pages = spark.createDataFrame(rows, "id int, body string").withColumn("url", F.lit(None).cast("string"))
    words = spark.createDataFrame([("looked",), ("17",), ("Zx",), ("zX",), ("",), (None,), ("nowhere",)], "keyword string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        got = P.match_keywords(pages, ["url", "body"], words).select("id", "keyword")
        found = sorted(map(tuple, got.collect()))
        final = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert found == sorted((i, k) for i, x in rows for k in ("looked", "17", "Zx", "zX", "nowhere") if k.lower() in x)
    assert "getbit" in final
    assert not re.search(r"Exchange hashpartitioning\(_texts#\w+, _word#", final), final


def test_keywords_of_all_lengths_against_plain_search(spark):
    marks = ["a", "é", "😀", " ", "b"]
    rng = random.Random(5)
    draw = lambda most: "".join(rng.choice(marks) for _ in range(rng.randint(0, most)))
    texts = [(n, draw(30), draw(9)) for n in range(60)]
    words = sorted({draw(9) for _ in range(200)} | {"?", "?a", "aaaaaaa", "\n"})
    pages = spark.createDataFrame(texts, "id int, a string, b string")
    table = spark.createDataFrame([(w,) for w in words], "keyword string")
    got = P.match_keywords(pages, ["a", "b"], table, once={"size": F.length("a")}).collect()
    want = {(n, w) for n, a, b in texts for w in words if w and (w in a or w in b)}
    assert {(r.id, r.keyword) for r in got} == want and len(got) == len(want)
    assert {(r.id, r.size) for r in got} == {(n, len(a)) for n, a, _ in texts if n in {r.id for r in got}}


def test_pages_are_hashed_before_they_are_repeated(spark):
    parsed = spark.createDataFrame([("u", "one", "two three"), ("v", "six", "ten")], "url string, title string, content string")
    stocks = spark.createDataFrame([("s", ["two", "three", "one"])], "name string, keywords array<string>")
    df = P.stock_articles(parsed, stocks, F.lit("x"), F.lit("2024-02-01").cast("timestamp")).select("keyword", "content_hash")
    digest = hashlib.md5(b"onetwo three").hexdigest()
    assert {(r.keyword, r.content_hash) for r in df.collect()} == {(w, digest) for w in ("one", "two", "three")}
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join Inner") < plan.index("md5(") and plan.count("md5(") == 1, plan
