"""Main text of pages: exact on pages with known parts, and held-out accuracy of the model."""

import html
import math
import random

import pytest
from pyspark.sql import functions as F

from signalmill.llm import html_extract
from signalmill.llm.html_extract import extract, given_labels, html_texts, learn_pages, make_model, parse

SCHEMA = "page_id long, url string, html string"


def sentence(rng):
    return " ".join(rng.choice("alpha beta gamma delta tea & <b> long".split()) for _ in range(rng.randint(4, 20))) + "."


def page(rng, style):
    """A page and its main text; 'tags' marks its parts by tags, 'names' by class names."""
    blocks = [sentence(rng) for _ in range(rng.randint(2, 8))]
    body = "".join(f"<p>{html.escape(b)}" + ("</p>" if rng.random() < 0.8 else "") for b in blocks)
    links = "".join(f'<li><a href="/{i}">Link {i}</a></li>' for i in range(rng.randint(3, 8)))
    extra = f"<script>var x = '<p>no</p>';</script><!-- <p>no</p> --><form><p>{sentence(rng)}</p><input></form>"
    if style == "tags":
        out = (f"<html><head><title>t</title><style>p{{}}</style></head><body><nav><ul>{links}</ul></nav>"
               f"<article>{body}</article><aside><p>{sentence(rng)}</p></aside>{extra}<footer>&copy; all</footer></body></html>")  # fmt: skip
    else:
        out = (f'<html><body><div class="nav-menu"><ul>{links}</ul></div><div id="cookie-notice">We use cookies.</div>'
               f'<div class="post-content">{body}</div>{extra}<div class="comments"><p>{sentence(rng)}</p></div>'
               f'<div class="sidebar">{links}</div><div class="site-footer">&copy; all</div></body></html>')  # fmt: skip
    return out, "\n\n".join(blocks)


@pytest.fixture(scope="module")
def pages(spark):
    rng = random.Random(1)
    made = [page(rng, "tags") for _ in range(60)]
    rows = [(i, f"http://x/{i}", source) for i, (source, _) in enumerate(made)]
    rows += [(100, None, None), (101, "u", ""), (102, "u", "just  some\n text"), (None, "u", rows[0][2]), rows[5],
             (103, "u", "<p"), (104, "u", "<div><p>" * 3000), (105, "u", "<article><p>" + "word. " * 50000)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return df.select("*", F.lit(1).alias("text"), F.lit(2).alias("n_chars"), F.lit(3).alias("label")), rows, made


def test_html_texts(pages):
    df, rows, made = pages
    got = html_texts(df).collect()
    assert len(got) == len(rows)
    by_id = {r["page_id"]: r for r in got}
    for i, (_, want) in enumerate(made):
        assert by_id[i]["text"] == want and by_id[i]["n_chars"] == len(want)
    assert by_id[100]["text"] == by_id[101]["text"] == by_id[103]["text"] == by_id[104]["text"] == ""
    assert by_id[102]["text"] == "just some text"
    assert by_id[105]["n_chars"] == 50000 * 6 - 1


def test_held_out_pages_without_telling_tags(spark, pages):
    model = learn_pages(pages[0])
    rng = random.Random(7)
    good = sum(extract(source, model) == want for source, want in (page(rng, "names") for _ in range(60)))
    assert good >= 54


def test_no_pages(spark):
    assert html_texts(spark.createDataFrame([], SCHEMA)).collect() == []


def test_references_and_white_space():
    model = make_model(html_extract.Counter())
    source = "<article><p>a&amp;amp; b&nbsp;&#233;\n\t c</p><p> </p><p>x<br>y</p></article>"
    assert extract(source, model) == "a&amp; b é c\n\nx y"


def test_open_and_broken_tags():
    assert [t for _, t in parse("<p><b>one<br><p>two</p><ul><li>a<li>b</ul>").blocks] == ["one", "two", "a", "b"]
    assert [t for _, t in parse('<p title="a>b">x</p><a href="q>y').blocks][0] == "x"
    assert parse("<script>never ends <p>x").blocks == []


@pytest.mark.parametrize("source, blocks", [
    ('<article><p>a</p><embed src="x.swf"><p>b</p></article><p>c</p>', ["a", "b", "c"]),
    ("<article><p>a</p><button>x</article><p>c</p>", ["a", "c"]),
    ("<article><p>a</p><video src=v>x<p>y</p></article><div>c</div>", ["a", "c"]),
    ("<article><p>a<video src=v><p>b</p></article>", ["a", "b"]),
    ("<ul><li>a<audio>x<li>b</ul>", ["a", "b"]),
    ("<p>a <svg><svg><text>x</text></svg><text>y</text></svg> b</p>", ["a b"]),
    ("<object><object>x</object>y</object><p>b</p>", ["b"]),
    ("<article><svg><text>x</text><p>b</p></article>", ["b"]),
    ("<svg><foreignObject><div>x</div></foreignObject></svg><p>b</p>", ["b"]),
    ("<p>a<button><p>x</p></button>b</p>", ["a b"]),
    ("<div>a<video><svg><p>x</p></svg></video><p>b</p></div>", ["a", "b"]),
    ("<div>a<select><option>x<script></select></script>y</select>b</div>", ["a b"]),
])
def test_dropped_elements_end_where_they_do(source, blocks):
    assert [t for _, t in parse(source).blocks] == blocks


@pytest.fixture(scope="module")
def given_model(spark, small_dir):
    return learn_pages(spark.read.parquet(f"{small_dir}/pages.parquet"))


PROSE = "".join(f"<p>{'A long and plain sentence of the article goes on here. ' * 4}</p>" for _ in range(3))


@pytest.mark.parametrize("inner, blocks", [
    ("<h2>Heading</h2>", ["Heading"]),
    ("<ul><li>one<li>two</ul>", ["one", "two"]),
    ("<ol><li>first</li><li>second step</li></ol>", ["first", "second step"]),
    ("<pre>x = 1\ny = 2</pre>", ["x = 1 y = 2"]),
    ("<blockquote>So it is said.</blockquote>", ["So it is said."]),
    ("<table><tr><th>k<th>v<tr><td>1<td>2</table>", ["k", "v", "1", "2"]),
    ("<figure><img src=x><figcaption>A picture</figcaption></figure>", ["A picture"]),
    ("<dl><dt>term<dd>meaning</dl>", ["term", "meaning"]),
    ("<div>Bare text.</div>", ["Bare text."]),
    ("<section><h3>Part</h3><p>Of it.</p></section>", ["Part", "Of it."]),
    ("<details><summary>More</summary>Hidden words</details>", ["More", "Hidden words"]),
    ('<p><a href="/x">A linked line</a></p>', ["A linked line"]),
    ('<div class="lead-in paragraph">Named bare text</div>', ["Named bare text"]),
])
def test_articles_are_kept_whole(given_model, inner, blocks):
    text = " ".join("A long and plain sentence of the article goes on here. ".split())
    text = " ".join([text] * 4)
    around = '<nav><ul><li><a href="/a">Home</a><li><a href="/b">News</a></ul></nav><div class="ad">Buy.</div>'
    source = (f"<html><body>{around}<article><h1>Title</h1>{PROSE}{inner}{PROSE}"
              '<div class="share">Share this</div><div class="ad">Buy more</div></article>'
              '<div class="comments"><p>I think so too, and so does everybody.</p></div>'
              "<footer>&copy; us</footer></body></html>")  # fmt: skip
    want = ["Title", *[text] * 3, *blocks, *[text] * 3]
    assert extract(source, given_model) == "\n\n".join(want)


def test_pages_without_an_article_are_kept_but_for_what_is_around(given_model):
    menu = '<nav><ul><li><a href="/a">Home</a></ul></nav>'
    source = f"<body>{menu}<h2>Short</h2><p>One line.</p><footer>us</footer></body>"
    assert extract(source, given_model) == "Short\n\nOne line."
    assert extract(f"<body>{menu}<footer>us</footer></body>", given_model) == ""


def test_messages_give_the_marginals_of_all_labellings():
    rng = random.Random(3)
    pages_ = [parse(page(rng, "tags")[0]) for _ in range(20)]
    seen = html_extract.Counter()
    for p in pages_:
        seen += html_extract.count_labels(p, given_labels(p))
    model = make_model(seen)
    small = parse("<body><nav><a>x</a></nav><div><p>One two. Three.</p></div><footer>f</footer></body>")
    n = len(small.tag)
    odds, amounts, tables = model.potentials(small)
    weight = [0.0] * n
    total = 0.0
    for mask in range(1 << n):
        label = [mask >> i & 1 for i in range(n)]
        log = sum(o for o, y in zip(odds, label, strict=True) if y)
        log += (model.root + amounts[0]) * label[0]
        for i in range(1, n):
            above = label[small.parent[i]]
            log += tables[i][above][label[i]] + amounts[i] * (label[i] and not above)
        total += math.exp(log)
        weight = [w + math.exp(log) * y for w, y in zip(weight, label, strict=True)]
    assert model.marginals(small) == pytest.approx([w / total for w in weight])
