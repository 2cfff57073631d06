import html
import re

import pytest

from tabula.llm import wrapper as W

PAGES = "page_id bigint, url string, html string"


def text_of(page):
    return W.extracted(page, None, [])


def got(spark, rows):
    docs = spark.createDataFrame(rows, PAGES).repartition(3)
    return {r.page_id: r.text for r in W.main_text(docs).collect()}


def test_article_without_the_rest():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><article>";</script></head>
<body class="page"><header><h1>Site</h1></header><nav><ul><li><a href="/a">A</a></ul></nav>
<div class="cookie-notice">We use cookies</div><!-- ad <p>no</p> --><div class="ad">Buy</div>
<article><header><span>By someone</span><h1>Head &amp; line</h1></header><p>One <b>bold<i>er</i></b>
  text.<br>Next&nbsp;line &lt;tag&gt; caf&eacute; &#x41;&#66;<p>Two<aside>aside</aside><form><input value="x"><button>Go</button></form>
<ul><li>item 1<li>item 2</ul><table><tr><td>c1<td>c2</table><section id="comments"><p>reader says</p></section>
<footer>about</footer></article><aside>side</aside><footer>&copy; x</footer></body></html>"""
    assert text_of(page) == ("Head & line One bolder text. Next line <tag> café AB Two item 1 item 2 c1 c2")


def test_names_of_a_page_or_article_do_not_hide_it():
    assert text_of('<html class="no-js skip"><body class="no-sidebar"><article><p>Story</p></article></body></html>') == "Story"
    assert text_of('<article class="post tag-social category-search"><p>Story</p></article>') == "Story"
    assert text_of('<div class="layout has-sidebar"><main id="reader"><p>Story</p></main><p>more</p></div>') == "Story"
    # beside a story that is not marked, marked articles are what their names say
    assert text_of('<article>Story</article><div class="comments"><article>reply</article></div>') == "Story"
    assert text_of('<div class="has-sidebar"><article>Story</article>'
                   '<div class="comments"><article>reply</article></div></div>') == "Story"


def test_plain_and_broken_pages():
    assert text_of("") == "" and text_of("just  text\n here") == "just text here"
    assert text_of("<p>a<p>b</div></p><b>c") == "a b c"
    assert text_of("<div>x < y && z</div>") == "x < y && z"
    assert text_of("<script>never closed <p>x") == ""
    assert text_of("a<!-- never closed <p>x") == "a"
    assert text_of("<div " + "<div>" * 5000 + "deep") == "deep"
    assert text_of("<p>x</p>" * 20_000) == " ".join("x" * 20_000)
    assert text_of("".join(f"<h2>{k}</h2><p>t{k}</p>" for k in range(500))).startswith("0 t0 1 t1")
    assert text_of('<p title="a > b" data-x=\'<p>\'>in</p>') == "in"
    assert text_of("<div>words before a <a>link</a></div><div><a>only a link</a></div>") == "words before a link"


def test_constant_nodes_of_a_host_are_template(spark):
    page = "<div><div class='x'>Welcome to the site</div><div class='y'><p>Story {0}</p><p>more of {0}</p></div><div class='z'>Imprint</div></div>"
    rows = [(k, f"https://h.example.org/{k}", page.format(k)) for k in range(12)]
    rows += [(100 + k, f"https://two.example.org/{k}", page.format(k)) for k in range(2)]
    out = got(spark, rows)
    assert all(out[k] == f"Story {k} more of {k}" for k in range(12))
    # two pages are no evidence
    assert out[100] == "Welcome to the site Story 0 more of 0 Imprint"


def test_constant_siblings_of_varying_ones_are_template(spark):
    page = "<p>Story {0}</p><p>Subscribe to our letter</p><p>More of {0}</p>"
    menu = "<ul><li>Home</li><li>Today {0}</li><li>Contact</li></ul><div>{1}</div>"
    rows = [(k, f"https://s.example.org/{k}", page.format(k)) for k in range(30)]
    # the constant sibling's place and the number of siblings may vary
    rows += [(100 + k, f"https://t.example.org/{k}", "".join(f"<p>{k} {i}</p>" for i in range(k % 4))
              + "<p>Subscribe to our letter</p>" + f"<p>end {k}</p>") for k in range(30)]
    rows += [(200 + k, f"https://m.example.org/{k}", menu.format(k, f"text {k}")) for k in range(30)]
    rows += [(300 + k, f"https://a.example.org/{k}", f"<article>{page.format(k)}</article>") for k in range(30)]
    out = got(spark, rows)
    for k in range(30):
        assert out[k] == out[300 + k] == f"Story {k} More of {k}"
        assert out[100 + k] == " ".join([f"{k} {i}" for i in range(k % 4)] + [f"end {k}"])
        assert out[200 + k] == f"Today {k} text {k}"


def test_a_host_with_most_pages_is_split(spark):
    page = "<div>Welcome</div><p>Story {0}</p>"
    rows = [(k, f"https://{'big' if k % 10 else f'small{k}'}.example.org/{k}", page.format(k)) for k in range(400)]
    pages = W.with_host(spark.createDataFrame(rows, PAGES), "page_id", "url", "html")
    hot = W.hot_keys(pages, ["host"], parts=8)
    salts = {(r.host, r.salt): r["count"] for r in W.dealt(pages, hot).groupBy("host", "salt").count().collect()}
    big = [n for (host, _), n in salts.items() if host == "big.example.org"]
    assert len(big) == 8 and max(big) < 100 and all(s == 0 for h, s in salts if h != "big.example.org")
    hosts = W.salted(pages.select("host").distinct(), hot)
    assert {(r.host, r.salt) for r in hosts.collect()} == set(salts)


def test_copies_are_no_evidence(spark):
    page = "<div><p class='a'>Same text</p></div>"
    rows = [(k, "http://c.example.org/x", page) for k in range(30)]
    assert set(got(spark, rows).values()) == {"Same text"}


def test_repeated_text_in_an_article_stays(spark):
    page = "<body><nav>m</nav><article><h1>T{0}</h1><p>{1}</p></article></body>"
    rows = [(k, "http://r.example.org/x", page.format(k, "The same passage." if k % 3 else f"Other {k}."))
            for k in range(40)]
    out = got(spark, rows)
    assert all(out[k] == f"T{k} " + ("The same passage." if k % 3 else f"Other {k}.") for k in range(40))


def test_edge_cases(spark):
    rows = [(1, None, None), (2, "", ""), (None, "not a url", "<p>x</p>"), (3, "http://a.org/", None),
            (3, "http://a.org/", None), (4, "http://a.org/", "<p>" + "long " * 100_000)]
    docs = spark.createDataFrame(rows, PAGES + "").selectExpr("*", "'c' as host", "'c' as salt", "1 as text")
    found = sorted(((r.page_id, r.url, len(r.text), r.n_chars) for r in W.main_text(docs).collect()), key=repr)
    assert found == sorted([(1, None, 0, 0), (2, "", 0, 0), (None, "not a url", 1, 1), (3, "http://a.org/", 0, 0),
                            (3, "http://a.org/", 0, 0), (4, "http://a.org/", 499_999, 499_999)], key=repr)
    assert W.main_text(docs.limit(0)).collect() == []


def brute_match(a, b):
    if a[0] != b[0]:
        return 0

    def best(xs, ys):
        if not xs or not ys:
            return 0
        return max(best(xs[1:], ys), best(xs, ys[1:]), brute_match(xs[0], ys[0]) + best(xs[1:], ys[1:]))
    return 1 + best(a[3], b[3])


@pytest.mark.parametrize("seed", range(20))
def test_tree_matching_is_maximal(seed):
    import random
    rng = random.Random(seed)

    def tree(depth):
        return [rng.choice("ab"), 0, 0, [tree(depth - 1) for _ in range(rng.randint(0, 3))] if depth else []]
    a, b = tree(3), tree(3)
    assert W.match(a, b) == brute_match(a, b)
    pairs = list(W.aligned(a, b))
    assert len(pairs) == W.match(a, b)
    assert all(x[0] == y[0] for _, _, x, y in pairs)


def test_pages_of_the_table(spark):
    """An independent reading of the test pages: what stands in <article>, tags taken out."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    found = {r.page_id: r.text for r in W.main_text(pages).collect()}
    for r in pages.collect():
        article = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        article = re.sub(r"</?(?:p|h1|br)>", " ", re.sub(r"</?(?:b|a|i|em|span)(?: [^>]*)?>", "", article))
        assert found[r.page_id] == " ".join(html.unescape(article).split()), r.page_id
