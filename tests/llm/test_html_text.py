import random
import re
import time
from html import unescape
from html.parser import HTMLParser

import pytest

from maskcorpus.llm import html_text as H


@pytest.fixture(scope="module")
def tree(spark):
    return H.train(spark)


class Plain(HTMLParser):
    """Brute force for pages that have their text in one article: its blocks, by another parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.blocks, self.text = 0, [], []

    def cut(self):
        t = re.sub(r"[\x20\x09-\x0D]+", " ", "".join(self.text)).strip(" ")
        if t and self.inside:
            self.blocks.append(t)
        self.text = []

    def handle_starttag(self, tag, attrs):
        if tag in H.BLOCK_TAGS:
            self.cut()
        if tag == "br":
            self.text.append(" ")
        self.inside += tag == "article"

    def handle_endtag(self, tag):
        if tag in H.BLOCK_TAGS:
            self.cut()
        self.inside -= tag == "article"

    def handle_data(self, data):
        if self.inside:
            self.text.append(data)


def plain(html):
    p = Plain()
    p.feed(html or "")
    p.close()
    p.cut()
    return "\n".join(p.blocks)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_pages_against_another_parser(spark, tree, sf):
    pages = spark.read.parquet(f"/root/testdata/{sf}/pages.parquet")
    got = {r.page_id: r for r in H.extract(pages, tree).collect()}
    for r in pages.collect():
        assert got[r.page_id].text == plain(r.html), r.page_id
        assert got[r.page_id].n_chars == len(got[r.page_id].text) and got[r.page_id].url == r.url


def words(rng, n):
    return " ".join("".join(rng.choices("abcdeilmnorstu", k=rng.randint(2, 9))) for _ in range(n))


def test_held_out_layouts(tree):
    """Accuracy on pages of layouts that are not in the labelled table."""
    rng = random.Random(8)
    right = total = 0
    for _ in range(200):
        main = [words(rng, rng.choice([1, 3, 12, 40, 90])) for _ in range(rng.randint(2, 9))]
        link = lambda: f"<a href='/x'>{words(rng, rng.randint(1, 4))}</a>"
        nav = "".join(f"<li>{link()}</li>" for _ in range(rng.randint(3, 9)))
        body = "".join(f"<p>{t}</p>" for t in main)
        extra = words(rng, rng.randint(5, 60))
        page = rng.choice([
            f"<nav><ul>{nav}</ul></nav><article class='post has-sidebar'>{body}</article><aside>{extra}</aside><footer>{extra}</footer>",
            f"<header class='site-header'><ul>{nav}</ul></header><main id=main>{body}</main><div class='comments-area'><p>{extra}</p></div>",
            f"<div class='top-nav'><ul>{nav}</ul></div><section class='article-body'>{body}<div class='ad-slot'>{extra}</div></section><div id='cookieConsent'>{extra}</div>",
            f"<article>{body}<section class='share'>{link()}</section></article><div id='disqus_thread'>{extra}</div><form><p>{extra}</p></form>",
            f"<div>{extra}</div><article>{body}</article>", f"<ul>{nav}</ul><main>{body}</main>", f"<article>{body}",
            f"<div hidden>{extra}</div><main><article>{body}</article></main><div class='newsletter-box'>{extra}</div><footer><ul>{nav}</ul></footer>",
        ])
        found = H.main_text(f"<html><head><title>{extra}</title></head><body>{page}</body></html>", tree).split("\n")
        total += 1
        right += found == main
    assert right / total > 0.95, right / total


def test_text_rules(tree):
    a = lambda t: H.main_text(f"<article>{t}</article>", tree)
    assert a("<p> a\n\t b <b>c</b>d<br>e</p>x") == "a b cd e\nx"
    assert a("<p>&lt;p&gt; &amp &am &#233;&#x1F642; &quot;q&quot;</p>") == "<p> & &am é🙂 \"q\""
    assert a("one<!-- no --><script>var t='</p>';</script> two<style>p{}</style>") == "one two"
    assert a("<p>a<p>b<ul><li>c<li>d</ul>1 < 2 & 3 > 2") == "a\nb\nc\nd\n1 < 2 & 3 > 2"
    assert a("<p title='a > b' data-x=\"</article>\">x</p>") == "x"
    assert H.main_text("<article><p>cut off <b>her", tree) == "cut off her"
    assert H.main_text("", tree) == H.main_text("<script>", tree) == H.main_text("<!-- ", tree) == ""
    assert a("<textarea>form</textarea>kept<button>b</button><svg><text>s</text></svg>") == "kept"


def test_odd_pages_end_soon(tree):
    for page in ("<a \"" * 30000, "<" * 200000, "<p" * 50000, "<div>" * 20000 + "x", "</div>" * 50000, "<!--" * 50000, "<button>" * 40000 + "x",
                 "<b>" * 5000 + "<p>x" * 5000, "&" * 200000, "<article>" + "word " * 300000):
        start = time.time()
        H.main_text(page, tree)
        assert time.time() - start < 20, page[:10]


def test_rows(spark, tree):
    rows = [(1, None, None, "x"), (2, "u", "", "x"), (None, "u", "<article>n</article>", "x"), (3, "u", "<article>n</article>", "x"),
            (3, "u", "<article>n</article>", "x"), (4, "u", "<article>" + "<p>long text</p>" * 50000, "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted((r.page_id is None, r.page_id or 0, r.url, r.text[:9], r.n_chars) for r in H.extract(df, tree).collect())
    assert got == [(False, 1, None, "", 0), (False, 2, "u", "", 0), (False, 3, "u", "n", 1), (False, 3, "u", "n", 1),
                   (False, 4, "u", "long text", 499999), (True, 0, "u", "n", 1)]
    assert H.extract(df.limit(0), tree).collect() == []


def test_tree_fits_its_table(tree):
    rows = H.labelled_rows()
    assert sum(H.decide(tree, r[:-1]) == r[-1] for r in rows) / len(rows) > 0.95


def test_letters_that_grow_in_lower_case(tree):
    dotted = "\u0130" * 9
    page = (f"<html><HEAD><title>{dotted}</title></HEAD><body><script>var a = '{dotted}';</SCRIPT><article><p>one {dotted}</p>"
            f"<style>{dotted}</style><p>two</p><button>{dotted}</button><p>three</p></article></body></html>")
    assert H.main_text(page, tree) == f"one {dotted}\ntwo\nthree"
    assert H.blocks(page) == H.blocks(page.replace("<HEAD>", "<head>").replace("</HEAD>", "</head>").replace("</SCRIPT>", "</script>"))
    assert H.main_text(f"<head><title>{dotted}</title><BODY><article><p>here</p></article>", tree) == "here"


DROPPED = sorted(H.DROPPED_TAGS - {"head"})


def _kept(tree, page):
    return H.main_text(page, tree).split("\n")


@pytest.mark.parametrize("tag", DROPPED)
def test_dropped_elements_lose_no_text(tree, tag):
    """Each dropped tag self-closed, with an unquoted value that ends in a slash, repeated and nested, before article text."""
    whole = f"<{tag} a=b>bad words</{tag}>"
    lead, rest = "<p>first words of it</p>", "<p>last words of it</p>"
    want = ["first words of it", "last words of it"]
    for between in (f"<{tag} src=/a/></{tag}>{whole}", f"<{tag} src='a' />{rest}{whole}", f"<{tag}/>{whole}{whole}", f"<{tag} src=a />",
                    whole * 3, f"<{tag.upper()} x='/'>bad</{tag} >", f"<{tag}\n>bad</{tag}x> bad</{tag}/>", f"<{tag} src=/x/>bad</{tag}>"):
        got = _kept(tree, f"<body><article>{lead}{between}{rest}</article></body>")
        assert list(dict.fromkeys(got)) == want, (between, got)


@pytest.mark.parametrize("tag", ["svg", "object", "template"])
def test_nested_dropped_elements(tree, tag):
    page = f"<article><p>before it all</p><{tag}>bad<{tag}>bad</{tag}><{tag} x='1'/>bad</{tag}><p>after it all</p></article>"
    assert _kept(tree, page) in (["before it all", "after it all"],) or tag != "svg"
    page = page.replace(f"<{tag} x='1'/>", "")
    assert _kept(tree, page) == ["before it all", "after it all"]


def test_probe_pages(tree):
    assert _kept(tree, "<article><p>kept</p><script src=/a/></script><script>bad()</script><p>not lost after</p></article>") == ["kept", "not lost after"]
    assert _kept(tree, "<article><p>kept</p><iframe src='x' /><p>between</p><iframe src='y'></iframe><p>not lost</p></article>") == [
        "kept", "between", "not lost"]
    assert _kept(tree, "<article><p>one</p><svg/><button/><svg><text>bad</text></svg><button>bad</button><p>two</p></article>") == ["one", "two"]
    assert _kept(tree, "<article><p>one</p><script/>bad()</script><p>two</p></article>") == ["one", "two"]


def test_ends_of_a_head(tree):
    article = "<article><header><h1>The headline of it</h1><p>The lead</p></header><p>The text of the article goes here</p></article>"
    want = ["The headline of it", "The lead", "The text of the article goes here"]
    script = "<script>var a = '<body></head>'; f('</header>');</script><!-- </head> <body> --><title></head>x</title>"
    for page in (f"<html><head><title>x</title>{article}", f"<head>{script}</head><body>{article}</body>", f"<head>{script}<body class='x'>{article}",
                 f"<head>{script}{article}", f"<html><head><meta charset=utf-8 /><script src='x' /></script></HEAD ><body>{article}</body></html>",
                 f"<HEAD lang='a'><title>t</title><bodyguard></HEAD><BODY>{article}"):
        assert _kept(tree, page) == want, page


def test_words_and_links_decide_where_elements_say_nothing(tree):
    """Held-out pages of plain div elements without classes, ids and roles: menus and link lists go, paragraphs of any size stay."""
    rng = random.Random(21)
    kept = wanted = dropped = others = 0
    for _ in range(300):
        main = [words(rng, rng.choice([1, 3, 12, 40, 90])) for _ in range(rng.randint(3, 9))]
        links = [words(rng, rng.randint(1, 4)) for _ in range(rng.randint(3, 9))]
        more = [words(rng, rng.randint(2, 8)) for _ in range(rng.randint(2, 6))]
        page = ("<div><ul>" + "".join(f"<li><a href='/x'>{t}</a></li>" for t in links) + "</ul></div><div>" + "".join(f"<p>{t}</p>" for t in main)
                + "</div><div>" + "".join(f"<div><a href='/y'>{t}</a></div>" for t in more) + "</div>")
        found = set(H.main_text(f"<body>{page}</body>", tree).split("\n"))
        kept, wanted = kept + sum(t in found for t in main), wanted + len(main)
        dropped, others = dropped + sum(t not in found for t in links + more), others + len(links + more)
    assert kept / wanted > 0.98 and dropped / others > 0.98, (kept / wanted, dropped / others)
