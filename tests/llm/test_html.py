"""Known pages, held-out layouts, broken markup."""

import html as decoder
import random
import re

import pytest

from tickwise.llm import html as H
from tickwise.llm.common import table

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def pages(spark):
    return table(spark, SF, "pages")


@pytest.fixture(scope="module")
def field(pages):
    return H.train(pages, 150)


def article(html):
    inner = re.search(r"<article>(.*)</article>", html, re.S)[1]
    inner = re.sub(r"</?(?:br|p|h1)>", " ", inner)
    return " ".join(decoder.unescape(re.sub(r"<[^>]*>", "", inner)).split())


def test_pages(pages, field):
    rows = {r.page_id: r for r in pages.collect()}
    got = H.extract(pages, field).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.url, r.n_chars) == (rows[r.page_id].url, len(r.text))
        assert r.text == article(rows[r.page_id].html)


def test_held_out_layouts(pages, field):
    r = random.Random(77)
    right = total = 0
    for row in pages.orderBy("page_id").limit(120).collect():
        blocks = H.leaf_blocks(row.html)
        own = H.own_labels(blocks)
        page, labels = H.layout([b for b, y in zip(blocks, own) if y],
                                [b for b, y in zip(blocks, own) if not y], r)
        found = field.decode(H.features(page))
        right += sum(a == b for a, b in zip(found, labels))
        total += len(labels)
    assert right / total > 0.98


def test_pages_of_other_kinds(field):
    one = ('<body><div id="menu"><a href="/">Home</a> <a>News</a></div><div class="content">'
           '<h1>Title</h1><p>First paragraph of the story, quite long.</p><p>Second <b>bold</b>text'
           ' &amp; more&nbsp;x.</p><div class="comments"><p>I like this story.</p></div></div>'
           '<div class="sidebar">Related posts</div><footer>Copyright 2020</footer></body>')
    assert H.main_text(one, field) == ("Title First paragraph of the story, quite long. "
                                       "Second boldtext & more x.")
    two = ('<header><h1>My Site</h1></header><div class="cookie-notice">We use cookies. '
           '<button>OK</button></div><main><article><h2>Foo</h2><p>Para one is here now.'
           '<aside>see also</aside><form>Email <input></form><p>Para two.</article>'
           '<section id="comments"><p>Reader says things here.</section></main>')
    assert H.main_text(two, field) == "Foo Para one is here now. Para two."


def test_pages_that_mark_no_article(pages):
    """Trained and used on pages whose containers are told by class only."""
    rows = [r.html.replace("<article>", '<div class="story">').replace("</article>", "</div>")
            for r in pages.orderBy("page_id").limit(120).collect()]
    field = H.Field().fit(H.labelled(rows[:80]))
    right = [H.main_text(x, field) == article(x.replace('<div class="story">', "<article>")
                                              .replace("</div><footer", "</article><footer"))
             for x in rows[80:]]
    assert sum(right) > 0.8 * len(right)


def test_blocks():
    texts = lambda h: [t for t, _, _ in H.leaf_blocks(h)]
    assert texts("<p>a  b\n c<p>d<br>e") == ["a b c", "d e"]
    assert texts("x<b>y</b>z &lt;&eacute;&#233;&am &amp") == ["xyz <éé&am &"]
    assert texts("<script>var a='<p>no</p>'</script><style>p{}</style><p>yes</p>") == ["yes"]
    assert texts("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>") == ["a", "b", "c", "d"]
    assert texts("<table><tr><td>a<td>b<tr><td>c</table>") == ["a", "b", "c"]
    assert texts("<title>t</title><textarea>u</textarea><select><option>v</select>w") == ["w"]
    for odd in ("", "<", "<!", "<![CDATA[x", "<!-- never closed", "</p></p>", "<p <b>x", "\x00",
                "<a href='x>y", "&#x110000;"):
        H.leaf_blocks(odd)
    assert texts("<div>" * 3000 + "deep" + "</div>" * 3000) == ["deep"]


def test_viterbi_is_the_best_labelling():
    import itertools

    import numpy as np

    r = np.random.default_rng(1)
    f = H.Field()
    f.state[:] = r.normal(size=f.state.shape)
    f.step[:] = r.normal(size=(2, 2)) * 2
    f.first[:] = r.normal(size=2)
    for n in (1, 2, 7):
        page = [r.integers(0, H.FEATURES, 3).tolist() for _ in range(n)]
        s = f.scores(page)

        def score(y):
            return f.first[y[0]] + sum(s[i, a] for i, a in enumerate(y)) + sum(
                f.step[a, b] for a, b in zip(y, y[1:]))

        every = list(itertools.product((0, 1), repeat=n))
        assert tuple(f.decode(page)) == max(every, key=score)
        node, _ = f._marginals(s)
        p = np.exp([score(y) for y in every])
        for i in range(n):
            assert abs(node[i, 1] - p[[y[i] == 1 for y in every]].sum() / p.sum()) < 1e-9


def test_odd_rows(spark, field):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<p>"), (3, "u", "<p>"), (None, "u", "plain"),
            (4, "u", "<article><p>" + "word " * 100000 + "</article>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr(
        "*", "'x' AS text", "1 AS n_chars")
    got = H.extract(df, field).collect()
    assert len(got) == 6 and [r.text for r in got if r.page_id in (1, 2, 3)] == [""] * 4
    assert [r.n_chars for r in got if r.page_id == 4] == [499999]
    assert H.extract(df.limit(0)).count() == 0
    assert H.extract(df.where("page_id < 3")).count() == 2       # nothing to train on


def test_few_usable_pages_are_all_used(spark, pages):
    some = pages.orderBy("page_id").limit(40).select("page_id", "html")
    bare = spark.range(10_000, 13_960).selectExpr("id", "cast(null as string)")
    whole, alone = H.train(some.union(bare), 60), H.train(some, 60)
    assert alone.state.any() and (whole.state == alone.state).all()


@pytest.mark.parametrize("odd", ["<![foo[", "<![ endif]>", "<![1", "<![if !IE]>", "<![endif]-->",
                                 "<!DOCTYPE", "<!x [", "<!["])
def test_declarations_cut_nothing(odd):
    def texts(html):
        return [b[0] for b in H.leaf_blocks(html)]

    story = "<article><p>First of all.</p>%s<p>And then.</p></article>"
    assert texts(odd + ">" + story % "")[-2:] == ["First of all.", "And then."]
    assert texts(story % (odd + ">"))[0] == "First of all."
    assert texts(story % (odd + ">"))[-1] == "And then."


def test_open_head_ends_where_the_page_begins():
    page = "<html><head><title>T</title><meta charset=x><script>a</script>%s<article><p>Story.</p>"
    for after in ("", "<link rel=x>", "<noscript><p>no</p></noscript>"):
        assert [b[0] for b in H.leaf_blocks(page % after)] == ["Story."]
    assert H.leaf_blocks(page % "")[0][1][1][0] == "article"


def test_unseen_elements_and_comments(field):
    texts = lambda h: [t for t, _, _ in H.leaf_blocks(h)]
    assert texts("<p>One<noscript><p>Please enable scripts</p></noscript> two</p>") == ["One", "two"]
    assert texts("<p>a</p><!-- open <p>two") == ["a"]
    assert texts("<!--><p>a</p><!---><p>b</p><!-- x --!><p>c</p><!-- -- > --><p>d") == list("abcd")
    assert texts("<p>a<template><p>x</p><li>y</template>b") == ["a", "b"]
    assert texts("<p>a</p><!doctype") == texts("<p>a</p><p class='x") == ["a"]
    inside = [a for t, a, _ in H.leaf_blocks(
        "<article><p>a</p><textarea></article></textarea><p>b</p></article><p>c</p>")]
    assert ["article" in [t for t, _ in a] for a in inside] == [True, True, False]
    assert texts("<div><button>Go<p>one</p><p>two</p></div><p>three</p><button>B</button>") == [
        "one", "two", "three"]
    assert texts("<div><button><div>Go</div></button><p>one</p></div>") == ["one"]
    page = ("<body><nav><a>Home</a></nav><article><p>The first paragraph of this story is here."
            "<noscript><p>Please enable scripts</p></noscript> It goes on.</p>"
            "<textarea></article></textarea><p>The second paragraph ends the story.</p>"
            "</article><footer>Imprint</footer><!-- open <p>more")
    assert H.main_text(page, field) == ("The first paragraph of this story is here. It goes on. "
                                        "The second paragraph ends the story.")


def test_scores_by_context(pages, field):
    """Sums carried along the open tags are those of the features of each block."""
    import numpy as np

    odd = ("<div class='a b a'><div class=b>x<p id=a>y</div>z<ul><li>1<li class=q>2</ul>"
           "<a href=x>w</a>v</div>u")
    for html in [odd, "plain", *[r.html for r in pages.limit(30).collect()]]:
        page, blocks = H._parsed(html), H.leaf_blocks(html)
        assert [b[0] for b in page.blocks] == [b[0] for b in blocks]
        assert np.allclose(field.page_scores(page), field.scores(H.features(blocks)))


def test_no_labels_in_the_sample():
    field = H.Field().fit(H.labelled(["<p>Hello</p>", "", "<div>" * 400 + "x"]))
    assert H.main_text('<nav><a href="/">Home</a></nav><article><p>The mayor opened the new '
                       'bridge on Monday.</p><p>It took four years to build.</p></article>'
                       '<footer>Copyright 2020</footer>', field) == (
        "The mayor opened the new bridge on Monday. It took four years to build.")


def test_nested_tags_take_linear_time(field):
    import resource
    import time

    def took(html):
        begin = time.process_time()
        H.main_text(html, field)
        return time.process_time() - begin

    for unit in ("<div><font>x", "<b><p>x", "<ul><li class=c>x", "<font>x</p>"):
        assert took(unit * 50_000) < 12
    many = "".join(f"<div class=c{i}>x" for i in range(50_000))
    assert took(many) < 12
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss < 2_000_000
