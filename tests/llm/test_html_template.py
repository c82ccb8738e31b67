import random
import re
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from wakeline.llm import html_template
from wakeline.llm.html_template import Template, extract_text, host_of, main_text, parse


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("   ", ""), ("plain words  only", "plain words only"),
    ("<article><h1>A &amp; B</h1><p>one\n two<b>three</b> &#233;</p></article>",
     "A & B one twothree é"),
    ("<nav>menu</nav><article><p><b>x<br><p>y <i>z</article><footer>f", "x y z"),
    ("<article><p>a</p><script>var t='</p></article>';</script><style>p{}</style>b</article>c",
     "a b"),
    ("<article><p>a<!-- <p>no</p> --> b<![CDATA[x]]></p><aside>s</aside><form>f</form></article>",
     "a b"),
    ("<article>a<div class='ad'>ad</div><p class=notice>n<p>b<div id=comments>c</div></article>",
     "a b"),
    ("<main><header><h1>T</h1></header>t<div class='content sidebar-left'>u</div></main>", "T t u"),
    ("<header>h</header><div class='post-body'>x</div><section class='comments'>y</section>", "x"),
    ("<article>a<article class='comment'>r</article>b</article>", "a b"),
    ("<body class='has-sidebar'><div role=banner>b</div><div role=main>m</div></body>", "m"),
    ("<article>1 < 2 <3 a<b</article>", "1 < 2 <3 a"),
    ("<p>one<p>two<ul><li>three<li>four</ul>", "one two three four"),
    ("<table><tr><td>a<td>b<tr><td>c</table>", "a b c"),
    ("<article><p title='a > b'>x</p><p title=\"unclosed>y</p></article>", "x y"),
    ("<ARTICLE>U&nbsp;V</ARTICLE >W", "U V"),
    ("<article><div hidden>h</div><span style='display: none'>n</span>v</article>", "v"),
    ("<p><a href=x>link only</a></p><p>words and <a>link</a></p>", "words and link"),
    ("<article><div class='page-sidebar'>s</div><div class='text-ad'>d</div>a"
     "<div class='postComments'>c</div><div class='story-text no-comments'>b</div></article>",
     "a b"),
    ("<div id='AD'>x</div><div class='cookie-notice-box'>y</div><div class='main-content'>z</div>",
     "z"),
    ("<article>a<aside class=related-posts>r</aside><section id=respond>f</section><p>b", "a b"),
    ("<title>T</title><textarea><p>x</textarea><article>y", "y"),
])
def test_single_pages(page, text):
    assert main_text(page, None) == text


@pytest.mark.parametrize("page", [
    "<a b=\"" * 60_000, "<" * 300_000, "<p " * 100_000, "<b>" * 100_000 + "x" + "</i>" * 100_000,
    "<!--" * 100_000, "<div>" * 50_000 + "deep" + "</div>" * 50_000, "<li>" * 100_000,
    "<p><b>x" * 40_000, "&amp" * 100_000, "<script>" * 50_000, "<a x='" + "<q " * 50_000,
    "<a b=\"" * 20_000 + ">", "<a b='\">" * 40_000, "<p title='" + "x" * 300_000 + "'>y"])
def test_broken_pages_end(page):
    started = time.process_time()
    parse(page)
    assert time.process_time() - started < 20


@pytest.mark.parametrize("page, text", [
    (f"<article>a<img src='data:image/png;base64,{'Qk0>' * 5_000}'>b</article>c", "ab"),
    (f"<article data-x=\"{'x>y' * 20_000}\"><p>a</article>b", "a"),
    (f"<!doctype {'x' * 20_000}><article>a</article>b", "a"),
    (f"<article>{'<div>' * 600}a<nav>n</nav><footer>f</footer><div class=comments>c</div>b"
     f"{'</div>' * 600}d</article>e", "a b d"),
    (f"<article>{'<b>' * 2_000}a{'</b>' * 2_000}<p>b</article>c", "a b"),
])
def test_long_tags_and_deep_elements(page, text):
    assert main_text(page, None) == text


@pytest.mark.parametrize("page", [
    "<" * 300_000 + ">", ("<a b='" + "x" * 20_000 + ">") * 200, "<a '\">" * 40_000 + "'",
    "<i><div>" + "<b>" * 100_000 + "</i>" * 100_000])
def test_long_tags_and_deep_elements_end(page):
    started = time.process_time()
    parse(page)
    assert time.process_time() - started < 20


def site(n, seed, host="http://plain.example"):
    """Pages without any element or class that says what is what.

    The line with a number is the page's own text, so no slot but it and the article is left.
    """
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(rng.randint(2, 7)))
    rows, texts = [], {}
    for i in range(n):
        blocks = [" ".join(word() for _ in range(rng.randint(20, 40)))
                  for _ in range(rng.randint(1, 5))]
        links = "".join(f"<a href=/{i}>{word()}</a> " for _ in range(5))
        own = f"Page made {rng.randint(0, 9)}"
        html = (f"<html><body><div class=x1>The Daily Letter</div><div class=x2>{links}</div>"
                f"<div class=x3><h2>{blocks[0]}</h2>" + "".join(f"<p>{b}</p>" for b in blocks[1:])
                + "</div><div class=x4>All rights kept by us</div><div class=x5>"
                f"{own}</div></body></html>")
        rows.append((i, f"{host}/{i}", html))
        texts[i] = " ".join([*blocks, own])
    return rows, texts


PAGES = "page_id bigint, url string, html string"


def test_template_of_unmarked_pages(spark):
    rows, texts = site(40, 1)
    got = extract_text(spark.createDataFrame(rows, PAGES)).collect()
    assert {r.page_id: r.text for r in got} == texts
    assert all(r.n_chars == len(r.text) for r in got)
    # One page alone shows no template: everything but links stays.
    alone = extract_text(spark.createDataFrame(rows[:1], PAGES)).first()
    assert alone.text.startswith("The Daily Letter " + texts[0].rsplit(" Page", 1)[0])


def test_salted_join_gives_the_same(spark, monkeypatch):
    rows, texts = site(30, 2)
    monkeypatch.setattr(html_template, "BROADCAST_TOKENS", 0)
    got = extract_text(spark.createDataFrame(rows, PAGES)).collect()
    assert {r.page_id: r.text for r in got} == texts


def test_repeated_text_of_marked_articles_stays(spark):
    rows = [(i, f"https://u:p@Copies.example:80/{i}?q",
             "<nav><a>m</a></nav><article><h1>Same</h1><p>same text in each page</p></article>"
             "<footer>f</footer>") for i in range(50)]
    rows += [(100, None, None), (101, "no url", ""), (None, "http://x.example", "<p>t</p>"),
             (3, rows[3][1], rows[3][2])]
    pages = spark.createDataFrame(rows, PAGES).withColumns(
        {"host": F.lit(1), "text": F.lit("t"), "tokens": F.lit(0), "pages": F.lit("p")})
    got = extract_text(pages).collect()
    assert len(got) == len(rows)
    assert sum(r.text == "Same same text in each page" for r in got) == 51
    assert {(r.page_id, r.url, r.text) for r in got if r.page_id in (100, 101, None)} == {
        (100, None, ""), (101, "no url", ""), (None, "http://x.example", "t")}
    assert [r[0] for r in pages.where("page_id = 3").select(host_of("url")).collect()] == [
        "copies.example"] * 2
    assert extract_text(pages.where("false")).count() == 0


def test_unmarked_copies_keep_their_text(spark, monkeypatch):
    same = "<html><body><div class=x><h2>Same title</h2><p>same text here</p></div></body></html>"
    rows = [(i, f"http://copies.example/{i}", same) for i in range(20)]
    others, texts = site(30, 3)
    # A group of copies with over a third of the host, equal rows among them.
    rows += others + [(i, "http://plain.example/0", others[0][2]) for i in range(100, 120)]
    rows += [others[0]] * 3
    got = extract_text(spark.createDataFrame(rows, PAGES)).collect()
    assert len(got) == len(rows)
    assert {r.text for r in got if "copies" in r.url} == {"Same title same text here"}
    assert all(r.text == texts[r.page_id if r.page_id < 100 else 0]
               for r in got if "plain" in r.url)
    monkeypatch.setattr(html_template, "BROADCAST_CONTENTS", 0)
    again = extract_text(spark.createDataFrame(rows, PAGES)).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, got))


def test_short_section_behind_a_repeated_heading_stays(spark):
    rng, rows = random.Random(6), []
    for i in range(12):
        long = " ".join(f"w{rng.randrange(9_999)}" for _ in range(80))
        rows.append((i, f"http://h.example/{i}", "<body><div class=t><p>Daily</div><div class=s>"
                     f"<p>{long}</p><h3>Result</h3><p>short {i}</p></div></body>"))
    got = {r.page_id: r.text for r in extract_text(spark.createDataFrame(rows, PAGES)).collect()}
    assert all(got[i].startswith("w") and got[i].endswith(f"short {i}") for i in range(12))


def test_short_own_paragraphs_and_links_stay(spark):
    """A correction beside a long article, and a paragraph of which half is a link."""
    rng, rows = random.Random(7), []
    for i in range(30):
        long = " ".join(f"w{rng.randrange(9_999)}" for _ in range(120))
        rows.append((i, f"http://c.example/{i}", f"<body><div class=t>Daily</div><div class=s><p>{long}"
                     f"</div><div class=u>Contact us</div><div class=v><p>Correction {i} see "
                     f"<a>the note of {i}</a></div></body>"))
    got = extract_text(spark.createDataFrame(rows, PAGES)).collect()
    assert all(r.text.startswith("w") and r.text.endswith(
        f" Correction {r.page_id} see the note of {r.page_id}") for r in got)
    assert not any("Daily" in r.text or "Contact" in r.text for r in got)


def plain_text(pages, page):
    """The article of one page by scanning the whole host: repeated blocks of unmarked pages go."""
    blocks = {i: re.findall(r"<(?:p|h2|div class=x\d)>([^<]+)", html) for i, html in pages.items()}
    count = Counter(b for found in blocks.values() for b in set(found))
    return " ".join(b for b in blocks[page] if count[b] < 0.3 * len(pages))


def test_whole_query_against_a_plain_scan(spark):
    rows = site(60, 8)[0] + [(i + 100, u.replace("plain", "other"), h)
                             for i, u, h in site(40, 9)[0]]
    got = extract_text(spark.createDataFrame(rows, PAGES)).collect()
    hosts = {}
    for i, url, html in rows:
        hosts.setdefault(url.rsplit("/", 1)[0], {})[i] = html
    assert {r.page_id: r.text for r in got} == {
        i: plain_text(pages, i) for pages in hosts.values() for i in pages}


def test_without_its_template_a_page_reads_differently(spark):
    rows, texts = site(40, 5)
    for i, _, html in rows:
        assert html_template.main_text(html, None) != texts[i]


def test_classes_nest_or_are_dropped():
    # Root 1..4; class 20 lies in one gap, class 30 straddles two.
    made = Template.nested([1, 2, 3, 21, 22, 31, 32], [10, 10, 10, 20, 20, 30, 30],
                           [0, 5, 9, 6, 7, 4, 8], [9, 9, 9, 6, 6, 4, 4])
    assert made.root == [1, 2, 3]
    assert set(made.class_of) == {1, 2, 3, 21, 22}
    assert Template.nested([], [], [], []).root == []
    assert made.slots([1, 3, 2], []) is None
