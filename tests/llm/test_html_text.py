import itertools
import random
import time

import pytest
from pyspark.sql import functions as F

from subrev.llm import html_text

PAGES = "page_id bigint, url string, html string"
TEMPLATE = """<!DOCTYPE html><html><head><title>T {i}</title><style>p{{}}</style><script>var t="</p><p>no";</script></head><body>
<header><h2>Site name</h2></header><nav><ul><li><a href="/a">Menu</a></li><li><a href="/b">More here</a></li></ul></nav>
<div class="cookie-notice">We use cookies here</div><div class="ad">Buy this thing now, it is good for all of you</div>
<article><h1>Title &amp; {i}</h1><p><b>First   para {words}<br>goes
on<p>Second &quot;para&quot; with <a href="x">a link</a> here.</p><aside>See also this</aside><form>Name <input></form>
<div class="comments"><p>I like it</p></div></article><aside class="sidebar"><p>Other stories of today</p></aside>
<footer>&copy; 2020 site</footer>{end}"""


def page(i, words="of some words", end="</body></html>"):
    return TEMPLATE.format(i=i, words=words, end=end)


def table(spark, extra=()):
    rows = [(i, f"u{i}", page(i, "word " * (i % 7), "" if i % 3 else "</body></html>")) for i in range(40)]
    return spark.createDataFrame([*rows, *extra], PAGES)


def test_articles_without_the_rest(spark):
    for r in html_text.main_texts(table(spark)).collect():
        i = r["page_id"]
        first = " ".join(["First para", *["word"] * (i % 7), "goes on"])
        assert r["text"] == f'Title & {i}\n{first}\nSecond "para" with a link here.'
        assert r["n_chars"] == len(r["text"]) and r["url"] == f"u{i}"


def test_defined_results(spark):
    odd = [(100, "n", None), (101, "e", ""), (102, "s", "<script>x"), (103, "t", "just words"), (104, None, "<p>a<p>b<"),
           (105, "x", "<article><p>é&#233; <i>x</i>y</article"), (106, "y", "<<<>>> <a <b> &nbsp;&lt;p&gt;"), (107, "c", "<!-- a"),
           (108, "l", "<article><p>" + "long " * 40_000 + "</p></article>"), (109, "q", "<p title='\">x</p>" * 50)]
    rows = {r["page_id"]: r["text"] for r in html_text.main_texts(table(spark, odd)).collect()}
    assert [rows[i] for i in (100, 101, 102, 107)] == [""] * 4
    assert rows[103] == "just words" and rows[104] == "a\nb<" and rows[105].startswith("éé xy")
    assert len(rows[108].split()) == 40_000


def test_pages_without_marks_and_empty_table(spark):
    plain = spark.createDataFrame([(1, "u", "<div>menu</div><p>one two three</p><p>four</p>"), (1, "u", "<div>menu</div><p>one two three</p><p>four</p>")], PAGES)
    got = [r["text"] for r in html_text.main_texts(plain.withColumn("text", F.lit("own"))).collect()]
    assert len(got) == 2 and set(got) == {"one two three\nfour"} or all("one two three\nfour" in t for t in got)
    assert html_text.main_texts(spark.createDataFrame([], PAGES)).count() == 0


def test_names_and_attributes_that_only_contain_a_left_out_word():
    def words(page):
        return " ".join(" ".join(t.text for t in html_text.tokens(page)).split())

    for attributes in ('class="overflow-hidden"', 'class="layout has-sidebar"', 'class="no-sidebar"', 'class="single-post no-comments"',
                       'class="article-header"', 'class="post-header"', 'class="side-by-side"', 'title="The hidden cost"', 'data-class="ad"',
                       'hidden="false"', 'style="x-display:nonesuch"'):
        assert words(f"<div {attributes}><article><p>one two</p></article></div>") == "one two", attributes
        assert words(f"<p>a b c</p><div {attributes}>one</div>") == "a b c one", attributes
    assert words('<p>see <a href="/hidden-gems">gems</a> here</p>') == "see gems here"
    # an element that has the whole article stays, whatever its name
    assert words('<div class="modal"><main><p>one two</p></main></div>') == "one two"
    assert words('<form><article><p>one two</p></article></form>') == "one two"
    assert words('<div class="widget"><p>one two three</p></div><p>four</p>') == "one two three four"
    for left_out in ('<div class="x sidebar">z</div>', "<div id=comments>z</div>", "<span hidden>z</span>", '<p style="color:red; display: none">z</p>',
                     '<div aria-hidden="true">z</div>', '<div class="related"><article>z</article></div>', "<form>z</form>"):
        assert words(f"<main><p>one two</p></main>{left_out}<p>three</p>") == "one two three", left_out


def test_best_region_against_all_regions():
    rng = random.Random(7)
    for _ in range(300):
        s = [rng.choice([-3, -1, 1, 2]) for _ in range(rng.randint(0, 12))]
        a, z = html_text.best_region(s)
        best = max([0, *(sum(s[i:j]) for i, j in itertools.combinations(range(len(s) + 1), 2))])
        assert sum(s[a:z]) == best


@pytest.mark.parametrize("part", ['<a href="x ', "<a ", "<div>", "<p><b>", "<header><h1>", '<div class="ad">', "<li><div>", "</b>", "<!--", "<a title='x>\"", "<svg><a>"])
def test_broken_pages_of_a_megabyte_take_linear_time(part):
    page = part * (1_000_000 // len(part))
    html_text.tokens(page)
    begin = time.perf_counter()
    html_text.tokens(page)
    assert time.perf_counter() - begin < 6  # seconds; a quadratic scan takes minutes


def words_of(page):
    return " ".join(" ".join(t.text.split()) for t in html_text.tokens(page) if t.kind == "words").split()


def test_title_in_a_header_of_the_text_stays():
    post = '<body><div class="post"><header><h1>My title</h1></header><p>Some text of the post.</p></div></body>'
    assert words_of(post) == "My title Some text of the post.".split()
    site = '<body><header><h1>The site</h1></header><div><header><h2>Menu</h2><ul><li>Home</li></ul></header><p>Some text.</p></div></body>'
    assert words_of(site) == ["Some", "text."]


def test_unclosed_quotes_and_tags_keep_the_rest():
    assert words_of('<p>one <a href="x>two</a> three</p><p>four</p>')[:1] == ["one"]
    assert words_of("<p>a < b and c <3 d</p>") == "a < b and c <3 d".split()
    assert words_of("<p>x</p><!-- never closed <p>y</p>") == ["x"]
    assert words_of("<p>x <b") == ["x", "<b"]
