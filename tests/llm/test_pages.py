"""Main text of pages: markup cases, templates and awkward rows."""

import random

import pytest

from chatloom.llm.html import parse
from chatloom.llm.main_text import JOINT, extracted, main_texts

PAGES = "page_id bigint, url string, html string"


def text_of(html):
    return [t for t, _ in parse(html).article().blocks]


@pytest.mark.parametrize(
    "html, blocks",
    [
        ("", []),
        ("plain  text\n here", ["plain text here"]),
        ("<p>one<p>two<br>three", ["one", "two three"]),
        ("<article><h1>T</h1><p><b>x<br><p>y</article><footer>f", ["T", "x", "y"]),
        ("<nav>m</nav><main><p>a &amp; b &lt;c&gt; &#233; &copy &am</p></main>", ["a & b <c> é © &am"]),
        ("<title>t</title><body><header>h</header><p>x</p><aside>s</aside>", ["x"]),
        ("<article><header><h1>T</h1></header><p>x<footer>by</footer></article>", ["T", "x"]),
        ("<article><p>x</p><div class='user-comments'><p>y</p></div><p>z</p></article>", ["x", "z"]),
        ("<p>a<script>if (a<b) '</p>'</script>b<style>p{}</style></p>", ["ab"]),
        ("<p>a<!-- <p>no</p> -->b", ["ab"]),
        ("<p>a <span class=ad>buy <i>now</i></span> b</p>", ["a", "b"]),
        ("<ul><li>x<li>y<ul><li>z</ul></ul>", ["x", "y", "z"]),
        ("<table><tr><td>1<td>2<tr><td>3</table>", ["1", "2", "3"]),
        ("<p>3 < 4 and 5 > 4</p>", ["3 < 4 and 5 > 4"]),
        ("<p title='a>b'>x</p><p title='open>y", ["x", "y"]),
        ("</div></p>x</article>", ["x"]),
        ("<form><input>q</form><p hidden>h</p><p>x", ["x"]),
        ("<p>cut off <a href=", ["cut off"]),
        ("<div id=sidebar>s<div>t</div></div><div id=content>c</div>", ["c"]),
        ("<p>x<div class='cookie-notice'>c</div>y", ["x", "y"]),
        # Marks on what is or holds the article, states and slugs say nothing.
        ("<article class='post comment-open'><p>x</article>", ["x"]),
        ("<div class='content has-sidebar'><article><p>x</article></div>", ["x"]),
        ("<div id=wrapper class='no-sidebar'><div class=widget><main><p>x</main></div></div>", ["x"]),
        ("<form action=/><article><p>x</article><input></form><form>f</form>", ["x"]),
        ("<article class=related><p>x</article>", ["x"]),
        ("<nav>m</nav><aside><article><p>x</article></aside>", ["x"]),
        ("<aside><article>teaser</article></aside><article><p>x</article>", ["x"]),
        ("<article><h2 id='search-engines'>S</h2><section id='related-work'>w</section></article>", ["S", "w"]),
        ("<article><h2 id=login>L</h2><section id=form>f</section><p class='widget-free'>w</article>", ["L", "f", "w"]),
        ("<article><p><label>Name</label> is <math><mi>x</mi></math></article>", ["Name is x"]),
        ("<div id='form-and-function'><p>x</div>", ["x"]),
        ("<div class='adSlot top'>a</div><div class='related-posts'>r</div><p>x", ["x"]),
        ("<main><p>x</p><div id=comments><article class=comment><p>y</article></div></main>", ["x"]),
        ("<article><p>x</article><ol class='comment-list'><li><article>y</article></ol>", ["x"]),
    ],
)
def test_blocks(html, blocks):
    assert text_of(html) == blocks


def test_deep_and_long_pages():
    assert text_of("<div>" * 3000 + "x" + "</div>" * 3000) == ["x"]
    assert text_of("<p>" + "word " * 200_000)[0].count("word") == 200_000
    assert text_of("<" * 20_000) == ["<" * 20_000]


def test_recurring_subtrees_go_and_copies_of_articles_stay(spark):
    offer = "<div><p>Read our offers</p><ul><li>one</li></ul></div>"
    rows = [
        (i, f"https://Site.example/p/{i}", f"<body>{offer}<div><p>story {i}</p></div><p>Tiny.</p>")
        for i in range(30)
    ]
    # The same on another host is no template: too few pages.
    rows += [(100 + i, f"http://other.example/{i}", f"<body>{offer}<p>tale {i}") for i in range(3)]
    # Copies of one article differ in nothing that is the article.
    rows += [(200 + i, "http://copies.example/", f"<nav>{i}</nav><div><p>same</p></div>") for i in range(40)]
    # Within an article containers may go, paragraphs never do.
    rows += [
        (300 + i, f"http://art.example:80/{i}", f"<article><p>So.</p><p>piece {i}</p>{offer}</article>")
        for i in range(20)
    ]
    got = {r.page_id: r for r in main_texts(spark.createDataFrame(rows, PAGES)).collect()}
    assert len(got) == len(rows)
    for i in range(30):
        # "Tiny." stands on each page of the site, outside of any article.
        assert got[i].text == f"story {i}"
    assert got[100].text == JOINT.join(["Read our offers", "one", "tale 0"])
    assert got[200].text == "same"
    assert got[300].text == JOINT.join(["So.", "piece 0"])
    assert all(r.n_chars == len(r.text) for r in got.values())


def plain_templates(rows):
    """Texts by counting every subtree of every page against every other page."""
    from collections import defaultdict

    parsed = []
    for _, url, html in rows:
        host = url.split("/")[2].split(":")[0].lower()
        blocks, parents, digests = extracted(html)
        parsed.append((host, blocks, parents, digests, JOINT.join(t for t, _ in blocks)))
    articles, seen = defaultdict(set), defaultdict(set)
    for host, _, _, digests, text in parsed:
        articles[host].add(text)
        for digest in digests[1:]:
            seen[host, digest].add(text)
    out = {}
    for (page_id, _, _), (host, blocks, parents, digests, _) in zip(rows, parsed):
        kept = []
        for text, element in blocks:
            while element and not (
                len(seen[host, digests[element]]) >= 8
                and len(seen[host, digests[element]]) >= min(0.3 * len(articles[host]), 100)
            ):
                element = parents[element]
            if not element:
                kept.append(text)
        out[page_id] = JOINT.join(kept)
    return out


def test_templates_equal_plain_counting_also_on_a_large_host(spark):
    """A host of three designs, one of them rare, and hosts of a few pages."""
    rng = random.Random(5)
    boxes = [f"<div><p>Box {i} of this design</p><ul><li>{i}</ul></div>" for i in range(4)]
    rows = []
    for i in range(700):
        design = 0 if i < 400 else 1 if i < 550 else 2
        host = "hot.example" if i < 600 else f"h{rng.randrange(6)}.example"
        tail = rng.choice(["", boxes[3] if rng.random() < 0.2 else ""])
        words = " ".join(rng.choice("abcdefgh") for _ in range(6))
        story = f"<div><p>{words}</p><p>{i % 450}</p></div>"
        rows.append((i, f"http://{host}/{i}", f"<body>{boxes[design]}{story}{tail}</body>"))
    got = {r.page_id: r.text for r in main_texts(spark.createDataFrame(rows, PAGES)).collect()}
    assert got == plain_templates(rows)
    # 100 and more pages are enough on a host of any size.
    assert "Box 1" not in got[450] and "Box 0" not in got[3]


def test_awkward_rows(spark):
    rows = [(1, None, None), (None, "http://h/", "<p>x"), (2, "no host", ""), (3, "", "<p>é"), (3, "", "<p>é")]
    frame = spark.createDataFrame(rows, PAGES).selectExpr("*", "1 AS row", "'h' AS host", "'t' AS text")
    got = sorted((r.page_id or 0, r.url, r.text, r.n_chars) for r in main_texts(frame).fillna("-").collect())
    assert [(k, t, n) for k, _, t, n in got] == [(0, "x", 1), (1, "", 0), (2, "", 0), (3, "é", 1), (3, "é", 1)]
    assert main_texts(frame.limit(0)).count() == 0
