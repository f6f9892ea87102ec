from __future__ import annotations

import html
import re

import pytest

from conftest import rows
from tillwatch.llm import html_text as H
from tillwatch.llm.common import table
from tillwatch.llm.queries import op4_html_text


def test_query_gives_the_article(spark):
    sf = "/root/testdata/sf0.01"
    truth = {}
    for r in table(spark, sf, "pages").collect():
        article = re.search(r"<article>(.*)</article>", r["html"], re.S)[1]
        truth[r["page_id"]] = html.unescape(re.sub("<[^>]*>", " ", article)).split()
    got = op4_html_text(spark, sf).collect()
    assert {r["page_id"]: r["text"].split() for r in got} == truth
    assert all(r["n_chars"] == len(r["text"]) for r in got)


@pytest.mark.parametrize(("page", "text"), [
    (None, []), ("", []), ("plain  text\n here", ["plain text here"]),
    ("<p>a<p>b<br>c<div>d</div>e", ["a", "b c", "d", "e"]),
    ("<p>x &amp;&nbsp;&lt;y&gt; &eacute;&#8364;</p>", ["x & <y> é€"]),
    ('<script>if(a<b){"</p>"}</script><style>p{}</style><p>ok</p><noscript>no</noscript>', ["ok"]),
    ("<header>h</header><nav>m</nav><main><header>t</header><p>x</p><aside>s</aside></main><footer>f</footer>",
     ["t", "x"]),
    ('<div class="site-header">h</div><p>a</p><div id="cookieNotice">c</div><ul class="menu"><li>m</ul>', ["a"]),
    ('<article><p>x</p><section class="comments"><p>c</p></section><form>f</form></article>', ["x"]),
    ("<ul><li>one<li>two</ul><table><tr><td>p<td>q<tr><td>r</table>", ["one", "two", "p", "q", "r"]),
    ('<p hidden>h</p><div style="display: none">n</div><p>v</b></i>w</p>', ["vw"]),
    ("<p>a<!-- c --><b>b</b>c", ["abc"]), ("<p>open <b>bold", ["open bold"]),
    ('<div class="header-ad">x</div><div class="shadow readme">y</div>', ["y"]),
])
def test_blocks(page, text):
    assert [t for t, _ in H.blocks_of(page)] == text


def lcs(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


def test_common_lines():
    import random
    draw = random.Random(1)
    for _ in range(200):
        a, b = ([draw.randrange(6) for _ in range(draw.randrange(12))] for _ in "ab")
        common = H.common_lines(a, b)
        assert len(common) == lcs(a, b) and common == sorted(set(common))
        rest = iter(b)
        assert all(a[i] in rest for i in common)


def page(*lines):
    return "".join(f"<div>{line}</div>" for line in lines)


@pytest.fixture(scope="module")
def edge(spark):
    data = [
        (1, "http://a.x/news/1", page("Top", "first story", "Bottom")),
        (2, "http://a.x/news/2", page("Top", "second story", "Bottom")),
        (3, "http://a.x/news/2", page("Top", "second story", "Bottom")),
        (4, "http://b.x/1", page("Top", "alone", "Bottom")),
        (5, "http://c.x/1", "<article>" + page("kept", "twice") + "</article>"),
        (6, "http://c.x/2", "<article>" + page("kept", "twice") + "</article>"),
        (7, None, page("Top", "no host")), (8, "nothing", page("Top", "no host")),
        (None, "http://d.x/", None), (9, "http://d.x/", ""), (9, "http://d.x/", ""),
        (10, "http://e.x/a", page(*(["same"] * 300), "x")), (11, "http://e.x/b", page(*(["same"] * 300), "y")),
    ]
    data += [(100 + i, f"http://hot.x/p/{i:03}", page("Menu", f"story {i}", "End")) for i in range(60)]
    return spark.createDataFrame([(*d, "k") for d in data], "page_id long, url string, html string, row string")


def test_differencing(edge):
    got = {}
    for r in H.main_text(edge).collect():
        got.setdefault(r["page_id"], []).append(r["text"])
    assert got[1] == ["first story"] and got[4] == ["Top\n\nalone\n\nBottom"]
    # A page and its mirror: one is compared with the other, which leaves nothing to cut.
    assert got[2] + got[3] in (["Top\n\nsecond story\n\nBottom"] * 2,)
    assert got[5] == got[6] == ["kept\n\ntwice"]
    assert got[7] == got[8] == ["Top\n\nno host"]
    assert got[None] == [""] and got[9] == ["", ""]
    assert got[10] == ["x"] and got[11] == ["y"]
    assert all(got[100 + i] == [f"story {i}"] for i in range(60))


def test_partition_edges_do_not_matter(spark, edge):
    expected = rows(H.main_text(edge))
    for parts in ("1", "13"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            assert rows(H.main_text(edge)) == expected
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_empty(edge):
    assert H.main_text(edge.limit(0)).count() == 0


def test_versions_keep_their_article(spark):
    """Near mirrors of pages without article or main: only what a page of another path has goes."""
    story = [f"paragraph {i} of the story" for i in range(6)]
    data = [
        (1, "http://f.x/story", page("Top", *story, "as first told")),
        (2, "http://f.x/story-revised", page("Top", *story, "as told again")),
        (3, "http://g.x/a/story", page("Top", *story, "on screen", "Bottom")),
        (4, "http://g.x/a/story?print=1", page("Top", *story, "on paper", "Bottom")),
        (5, "http://g.x/a/story?print=2", page("Top", *story, "in colour", "Bottom")),
        (6, "http://g.x/b", page("Top", "something else", "Bottom")),
        (7, "http://g.x/c", page("Top", "another thing", "Bottom")),
    ]
    pages = spark.createDataFrame(data, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"].split("\n\n") for r in H.main_text(pages).collect()}
    assert got[1] == ["Top", *story, "as first told"] and got[2] == ["Top", *story, "as told again"]
    assert all(set(story) < set(got[i]) for i in (3, 4, 5))
    assert got[4] == [*story, "on paper"] and got[5] == [*story, "in colour"]
    assert got[6] == ["something else"] and got[7] == ["another thing"]
