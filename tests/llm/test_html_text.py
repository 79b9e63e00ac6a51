import html
import math
import random
import re
import time
import tracemalloc

import pytest

from lakeshore.llm.html_text import content_blocks, extract, main_text, op10_html_extraction, text_blocks
from tests.conftest import SF01

CASES = {
    "": "",
    "plain  text": "plain text",
    "<div": "",
    "a &lt;b&gt; &eacute;&#8217;&#x41; &amp;amp": "a <b> é’A &amp",
    "<p>one<p>two<br>three<b>bold</b>er": "one two three bolder".replace("three bolder", "threebolder"),
    "<article><h1>T</h1><p>One, two.</p><aside>No.</aside><p>x <script>if (a < b) { s = '</p>' }</script>y</p></article><footer>F</footer>": "T One, two. x y",
    "<header><h1>Site</h1></header><article><header><h1>Title</h1></header><p>Text.</p></article>": "Title Text.",
    "<main><p>Main text.</p><form>Name <input name=q> <button>Go</button></form><div class='cookie-notice'>We use.</div></main>": "Main text.",
    "<nav><a href=/>Home</a></nav><div id=content><p>Long text, with marks. And more of it.</p><p>Second, too.</p>"
    "<section class=comments><p>Nice, really. Great!</p></section></div><div class=sidebar>Links, here.</div>": "Long text, with marks. And more of it. Second, too.",
    "<article>A <a href='x>y'>link</a> <!-- no --> end<ul><li>One<li>Two</ul><table><tr><td>c<td>d</table></article>": "A link end One Two c d",
    "<article><p>Post.</p><article class=comment><p>Reply, long and full of marks, yes.</p></article></article>": "Post.",
    "<nav>Only a menu</nav><footer>And, a footer.</footer>": "",
    "<article><p>cut &am": "cut &am",
    "<article><p hidden>No</p><p style='display: none'>No</p><p>Yes</p></article><div class='ad'>Buy, buy, buy. Now!</div>": "Yes",
}


@pytest.mark.parametrize("page", CASES)
def test_cases(page):
    assert main_text(page) == CASES[page]


def test_scores_decide():
    """A teaser in an article does not outvote the text, and no passing block is dropped."""
    long = " ".join(["Long text, with marks, of the page's own."] * 5)
    teaser = "<article class=card>Read this, too.</article>"
    assert long in main_text(f"<div id=content><p>{long}</p><p>{long} End.</p></div>{teaser}")
    assert long in main_text(f"<div><p>{long}</p><p>{long} End.</p></div>{teaser}")
    parts = [f"{long} {k}" for k in range(10)]
    page = "<div class=a>" + "".join(f"<p>{x}</p>" for x in parts[:9]) + f"</div><div class=b><p>{parts[9]}</p></div>"
    assert " ".join(parts) in main_text(f"<html><body>{page}<div class=c>Link</div></body></html>")


MARKS = ["<div id=content class=with-sidebar>{}</div>", "<div class=no-sidebar>{}</div>", "<article class='post comments-open'>{}</article>",
         "<article class='post no-comments'>{}</article>", "<div class=layout-sidebar-right>{}</div>", "<article class='entry share'>{}</article>"]


@pytest.mark.parametrize("page", MARKS)
def test_a_container_is_not_dropped_for_a_part_of_its_class(page):
    text = "The page's own text, whole. And some more of it, too."
    assert main_text(page.format(f"<p>{text}</p>")) == text


def test_parts_named_as_boilerplate_are_left_out():
    text = " ".join(["Long text, with marks. And more of it."] * 9)
    for name in ("sidebar-left", "cookie-notice", "site-footer", "sidebar"):
        assert main_text(f"<article><p>{text}</p><div class={name}>Other.</div></article>") == text, name


def test_deep_and_long_pages():
    assert main_text("<div>" * 5000 + "deep text" + "</div>" * 5000) == "deep text"
    assert len(main_text("<article>" + "<p>word, word.</p>" * 50000)) == 50000 * 12 - 1
    assert main_text("<article><p>x</p>" + '<a title="unclosed' * 2000).startswith("x")


N = 30_000
HOSTILE = {"nested": ("<div>" * N + "deep" + "</div>" * N, 4), "items": ("<ul><li>x, " * N, 3 * N - 1), "inline": ("<b>" * N + "x<br>" * N, 2 * N - 1),
           "unmatched ends": ("<div>" * N + "</p></span>" * N + "deep", 4), "siblings": ("<div>" * N + "<li>x" * N, 2 * N - 1),
           "bodies": ("<body>" * N + "<div>x, y.</div>" * N, 6 * N - 1)}


@pytest.mark.parametrize("name", HOSTILE)
def test_depth_costs_no_more_than_length(name):
    page, size = HOSTILE[name]
    tracemalloc.start()
    started = time.perf_counter()
    assert len(main_text(page)) == size
    seconds, (_, most) = time.perf_counter() - started, tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert seconds < 60 and most < 150 << 20  # walks to the root took minutes, paths as text gigabytes


def test_links_and_notices_outside_the_text():
    text = " ".join(["The page's own text, whole. And some more of it, too."] * 3)
    for other in ("<div><a href=/>Home</a> <a href=/n>News</a></div>", "<ul><li><a href=/>Home page, of all</a><li><a href=/n>News</a></ul>",
                  "<div class=legal-disclaimer>No advice, of any kind. Ask a lawyer.</div>"):
        assert main_text(f"<html><body>{other}<div id=content><p>{text}</p></div>{other}</body></html>") == text
    linked = f"<article><p>{text}</p><p><a href=/more>More of it.</a></p></article>"
    assert main_text(linked) == f"{text} More of it."  # a link of the article stays
    assert main_text("<div><a href=/>Only a link.</a></div>") == "Only a link."


def plain_content(blocks):
    """Blocks on passing paths, each path written out by walking up."""
    def path(b):
        steps, at = [], b.node
        while at is not None:
            steps.append((at.path, at.name))
            at = at.parent
        return tuple(steps), b.node.weight, b.node.in_article

    order = list(dict.fromkeys(map(path, blocks)))
    rows = [[b for b in blocks if path(b) == k] for k in order]
    text = [sum(len(b.text) for b in r) / len(r) for r in rows]
    marks = [(sum(c in ".,;:!?" for b in r for c in b.text) + 1) / len(r) for r in rows]
    free = [1 - (0 if r[0].node.in_article else sum(b.linked for b in r) / max(1, sum(b.letters for b in r))) for r in rows]

    def smooth(x, i):
        return 0.25 * x[max(0, i - 1)] + 0.5 * x[i] + 0.25 * x[min(len(x) - 1, i + 1)]

    value = [math.sqrt(smooth(text, i) * smooth(marks, i)) * order[i][1] * free[i] for i in range(len(rows))]
    return [b for b in blocks if value[order.index(path(b))] >= 0.15 * max(value)]


def test_path_table_equals_brute_force():
    rng = random.Random(5)
    bits = ["<div>", "</div>", "<p>", "<ul><li>", "</ul>", "<b>", "</b>", "<a href=x>", "</a>", "<article>", "</article>", "text, here. ", "more words ",
            "<div class=note>", "<section class='side comments'>", "</section>", "a long text, with marks; and more: of it. "]
    for _ in range(1500):
        blocks = text_blocks("".join(rng.choice(bits) for _ in range(rng.randrange(1, 40))))
        if blocks:
            assert list(map(id, content_blocks(blocks))) == list(map(id, plain_content(blocks)))


def test_rows(spark):
    pages = [(1, "u", "<p>x y", "clash"), (1, "u", "<p>x y", "clash"), (2, None, None, None), (None, "v", "", None)]
    out = extract(spark.createDataFrame(pages, "page_id long, url string, html string, text string")).collect()
    assert sorted((r.page_id or 0, r.url or "", r.text, r.n_chars) for r in out) == [(0, "v", "", 0), (1, "u", "x y", 3), (1, "u", "x y", 3), (2, "", "", 0)]
    assert extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_query_gives_the_articles(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF01}/pages.parquet").collect()}
    for r in op10_html_extraction(spark, SF01).collect():
        body = re.search(r"<article>(.*?)(</article>|$)", pages[r.page_id], re.S)[1]
        text = re.sub(r"<[^>]*$", "", re.sub(r"</?b>", "", re.sub(r"</?(p|h1|br)>", " ", body)))
        assert r.text == " ".join(html.unescape(text).split()) and r.n_chars == len(r.text)
