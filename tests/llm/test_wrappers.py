"""Parsing against the standard library's parser, matching against brute force, and sites with and without articles."""

from __future__ import annotations

import functools
import random
import time
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from querylens.llm.dom import parse
from querylens.llm.queries import QUERIES
from querylens.llm.wrappers import Shape, main_blocks, main_texts, simple_tree_matching, slots

SCHEMA = "page_id long, url string, html string"


class ArticleText(HTMLParser):
    """Blocks inside article elements, without scripts, styles and advert parts, as a plain reader sees them."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.blocks = 0, [""]

    def handle_starttag(self, tag, attrs):
        self.inside += tag == "article"
        if tag in ("p", "h1", "article"):
            self.blocks.append("")
        if tag == "br":
            self.blocks[-1] += " "

    def handle_endtag(self, tag):
        if tag in ("p", "h1", "article"):
            self.blocks.append("")
        self.inside -= tag == "article"

    def handle_data(self, data):
        if self.inside:
            self.blocks[-1] += data


def article_text(page: str) -> str:
    reader = ArticleText()
    reader.feed(page)
    reader.close()
    blocks = [" ".join(b.split()) for b in reader.blocks]
    return " ".join(b for b in blocks if b)


def texts(spark, rows: list[tuple]) -> dict:
    return {r["page_id"]: r["text"] for r in main_texts(spark.createDataFrame(rows, SCHEMA)).collect()}


def test_query_equals_the_plain_reader(spark):
    sf_dir = "/root/testdata/sf0.01"
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    found = QUERIES["op12_main_text"](spark, sf_dir).collect()
    assert len(found) == len(pages)
    for row in found:
        page = pages[row["page_id"]]
        assert row["text"] == article_text(page["html"])
        assert (row["url"], row["n_chars"]) == (page["url"], len(row["text"]))


WORDS = "river stone lamp garden winter paper signal copper meadow engine harbor violet".split()


def sentence(draw: random.Random, words: int = 12) -> str:
    return " ".join(draw.choice(WORDS) for _ in range(words)) + "."


def soup(draw: random.Random, body: list[str]) -> str:
    """A page of plain divisions: links, a constant line, the story, another constant line."""
    links = "".join(f'<div><a href="/{i}">{draw.choice(WORDS)}</a></div>' for i in range(5))
    story = "".join(f"<div class=x>{b}</div>" for b in body)
    return f"<body><div>{links}</div><div>Subscribe to our paper today</div><div id=s>{story}</div><div>All rights reserved</div></body>"


def test_constant_slots_become_the_template(spark):
    draw = random.Random(1)
    stories = {i: [sentence(draw) for _ in range(draw.randrange(1, 5))] for i in range(40)}
    rows = [(i, f"https://a.example/{i}", soup(draw, body)) for i, body in stories.items()]
    assert texts(spark, rows) == {i: " ".join(body) for i, body in stories.items()}


def test_copies_are_no_template(spark):
    draw = random.Random(2)
    body = [sentence(draw) for _ in range(3)]
    page = f"<body><article><h1>Title</h1><p>{'</p><p>'.join(body)}</p></article></body>"
    rows = [(i, "https://copies.example/x", page) for i in range(100)]
    assert set(texts(spark, rows).values()) == {" ".join(["Title", *body])}


def test_a_line_inside_all_articles_is_template(spark):
    draw = random.Random(3)
    rows = []
    for i in range(30):
        story = sentence(draw, 20)
        more = "<p>Once again.</p>" if i % 3 == 0 else ""
        rows.append((i, f"http://host.example/{i}", f"<article><p>{story}</p>{more}<p>Follow us on all channels</p></article>"))
    found = texts(spark, rows)
    assert not any("channels" in t for t in found.values())
    assert sum("Once again." in t for t in found.values()) == 10


MARKUP = [
    ("<p>a &amp; b &lt;c&gt; caf&eacute; &#8364; &copy", "a & b <c> café € ©"),
    ("<p>one<br>two  \n three</p>four<div>five</div>", "one two three four five"),
    ("<p>wor<b>ld</b>s <i>and</i>so</p>", "worlds andso"),
    ("<script>var a='</p><p>no';</script><style>p{}</style><p>yes</p><!-- <p>no</p> -->", "yes"),
    ("<p>x<table><tr><td>a<td>b<tr><td>c</table>y", "x a b c y"),
    ("<ul><li>one<li>two</ul>after", "one two after"),
    ("<p>1 < 2 and 3 > 2 & so", "1 < 2 and 3 > 2 & so"),
    ("<p title='a > b' class=\"x\">in</p>", "in"),
    ("<nav>menu</nav><header>top</header><p>body</p><footer>end</footer><aside>side</aside><form>send<input></form>", "body"),
    ("<div class='site-comments'>nice!</div><div class='cookieNotice'>cookies</div><div id='ad-1'>buy</div><p>body</p>", "body"),
    ("<div class='with-sidebar'><p>body</p><div class='sidebar'>side</div></div>", "body"),
    ("<form id=page><article><p>body</p></article><p>rest</p></form>", "body"),
    ("<main><p>lead</p><article><p>body</p><div role=navigation>go</div></article></main><p>rest</p>", "body"),
    ("<article><p>body</p><article class='comment'><p>nice!</p></article></article>", "body"),
    ("<main><p>body</p></main><p>rest</p>", "body"),
    ("<p>a <span class='ad'>buy <b>now</b></span>b</p>", "a b"),
    ("<textarea>no</textarea><noscript>no</noscript><svg><text>no</text></svg>text", "text"),
    ("<title>t</title><p>text", "text"),
    ("no markup at all", "no markup at all"),
    ("", ""),
    (None, ""),
    ("<p>", ""),
    ("<!--", ""),
    ("<article", ""),
]


@pytest.mark.parametrize("page, expected", MARKUP)
def test_markup(page, expected):
    assert " ".join(main_blocks(parse(page), None, (), ())) == expected


def test_nulls_repeats_and_clashing_names(spark):
    rows = [(1, None, "<p>a</p>"), (1, None, "<p>a</p>"), (None, "x", "<p>b</p>"), (2, "http://h/", None), (3, "http://h/", ""), (4, "", "<p>c")]
    found = main_texts(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(r["text"] for r in found) == ["", "", "a", "a", "b", "c"]
    named = [(1, "http://h/", "<p>a</p>", "x", "y", 3)]
    clash = spark.createDataFrame(named, f"{SCHEMA}, host string, text string, shape int")
    assert [tuple(r) for r in main_texts(clash).collect()] == [(1, "http://h/", "a")]
    assert main_texts(spark.createDataFrame([], SCHEMA)).collect() == []


def test_long_and_odd_pages_end_soon():
    odd = ["<a ", '<a ="x>" ', "<div>", "<p><b>", "<!--", "<script>", "</div>", "<td><div>", "<a b='", "<", "&", "<li><ul>", '<p class="a b">x']
    for piece in odd:
        page = piece * 50_000
        start = time.perf_counter()
        found = parse(page)
        slots(found.shape, "#(html)")
        assert time.perf_counter() - start < 10, piece
    text = "word " * 400_000
    assert parse(f"<p>{text}</p>").texts == [text.strip()]


def random_shape(draw: random.Random, depth: int) -> str:
    label = draw.choice("ab")
    inner = [random_shape(draw, depth - 1) for _ in range(draw.randrange(4))] if depth else []
    return label + (f"({','.join(inner)})" if inner else "")


def most_matches(a: Shape, b: Shape) -> int:
    @functools.cache
    def match(i: int, j: int) -> int:
        if a.labels[i] != b.labels[j]:
            return 0
        return 1 + forest(tuple(a.children[i]), tuple(b.children[j]))

    @functools.cache
    def forest(left: tuple, right: tuple) -> int:
        if not left or not right:
            return 0
        skip = max(forest(left[1:], right), forest(left, right[1:]))
        both = match(left[0], right[0])
        return max(skip, both + forest(left[1:], right[1:])) if both else skip

    return match(0, 0)


def test_matching_is_the_largest_there_is():
    draw = random.Random(4)
    for _ in range(300):
        a, b = (Shape(random_shape(draw, 3)) for _ in range(2))
        found = simple_tree_matching(a, b)
        assert len(found) == len(set(found.values())) == most_matches(a, b)
        for i, j in found.items():
            assert a.labels[i] == b.labels[j]
            assert i == j == 0 or found[a.parents[i]] == b.parents[j]
        pairs = sorted(found.items())
        assert pairs == sorted(pairs, key=lambda p: p[1])  # numbered in document order, so order is kept


def test_many_children_are_matched_by_equal_subtrees():
    a, b = (Shape("r(" + ",".join(f"x({'y' * (i + 1)})" for i in range(start, 700)) + ")") for start in (0, 100))
    found = simple_tree_matching(a, b)
    assert len(found) == 1 + 2 * 600
