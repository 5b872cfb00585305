import math

import pytest
from pyspark.sql import functions as F

from stayrate.llm import html_text


@pytest.fixture(scope="module")
def model(spark):
    return html_text.train(html_text.labelled_examples(spark))


def test_labelled_pages_are_learnt(model):
    wrong = total = 0
    for source in html_text.example_pages():
        page = html_text.parse(source)
        label = [1] * len(page.tags)
        for i, content in enumerate(model.marginals(page)):
            if i:
                label[i] = label[page.parents[i]] if page.labels[i] is None else page.labels[i]
            if page.tags[i] == html_text.TEXT:
                total += 1
                wrong += (content >= 0.5) != label[i]
    assert wrong / total < 0.01


CASES = [
    ("<nav><a>Home</a></nav><article><h1>Title</h1><p>One &amp; two&nbsp;\n three<br>four</p><p>Five</article><footer>(c)</footer>", "Title\nOne & two three four\nFive"),
    ('<div id="cookie-banner">We use cookies</div><main><p>Real text of it.</p><aside>Related</aside><form><label>Name</label></form><p>Second <a href=x>link</a> text.</p></main>', "Real text of it.\nSecond link text."),
    ('<article><p>Text.</p><section class="comments"><h2>Comments</h2><p>Very nice article I agree with it a lot</p></section></article>', "Text."),
    ('<div class="wrapper"><div class="sidebar"><ul><li><a href=1>A</a></li></ul></div><div class="content"><p>The body text of it all.</p></div></div>', "The body text of it all."),
    ("<p>just text</p><p>x < y & z</p>", "just text\nx < y & z"),
    ("<article><p>a<script>var t='</p>';</script>b<!-- no --><style>p{}</style></p></article>", "ab"),
    ("<article><p><b>bold.<br><p>next</p></article>", "bold.\nnext"),
    ("<article><p>cut off <a hre", "cut off"),
    ("", ""), (None, ""), ("<p>  </p>", ""), ("</div></p>", ""),
]


def test_cases(spark, model):
    pages = spark.createDataFrame([(i, f"u{i}", h) for i, (h, _) in enumerate(CASES)] + [(None, None, CASES[0][0])], "page_id long, url string, html string")
    out = html_text.extracted(pages.withColumn("Text", F.lit(3)), model)
    assert out.columns == ["page_id", "url", "html", "text", "n_chars"]
    rows = out.collect()
    got = {r["page_id"]: r["text"] for r in rows}
    for i, (_, want) in enumerate(CASES):
        assert got[i] == want
    assert got[None] == CASES[0][1] and all(r["n_chars"] == len(r["text"]) for r in rows)
    assert html_text.extracted(pages.limit(0), model).collect() == []


def test_long_and_deep_pages(model):
    assert html_text.main_text(model, "<article>" + "<p>word</p>" * 30000 + "</article>") == "\n".join(["word"] * 30000)
    assert "deep" in html_text.main_text(model, "<article>" + "<div>" * 100 + "a deep text of some words" + "</div>" * 100)


def test_messages_give_exact_marginals(model):
    source = '<div class="page"><nav><a>x</a></nav><p>some <b>text</b></p></div>'
    page = html_text.parse(source)
    words, linked = html_text.measures(page)
    size = len(page.tags)
    total, ones = 0.0, [0.0] * size
    for state in range(2 ** (size - 1)):
        y = [1] + [state >> i & 1 for i in range(size - 1)]
        p = 1.0
        for i in range(1, size):
            named = model.named(page.tags[i], page.names[i])
            pair = model.child.get(html_text.kind_of(page.tags[i], named), model.rest)
            p *= pair[2 * y[page.parents[i]] + y[i]]
            if y[i]:
                p *= model.own(page.tags[i], named, words[i], linked[i])
        total += p
        for i in range(size):
            ones[i] += p * y[i]
    for got, one in zip(model.marginals(page), ones):
        assert math.isclose(got, one / total, abs_tol=1e-9)


ARTICLE = "<article><h1>Title</h1><p>The text of it all.</p></article>"


@pytest.mark.parametrize("page", [
    "<html><head><title>t</title><body>" + ARTICLE,
    "<!doctype html><head><meta charset=utf-8><title>t</title><link rel=x href=y><style>p{}</style>" + ARTICLE,
    "<html><head><title>t</title><noscript><img src=x></noscript><script>1</script></head><body>" + ARTICLE + "</body></html>",
    "<html><head><noscript><link href=x><body>" + ARTICLE,
])
def test_head_without_end_tag(model, page):
    assert html_text.main_text(model, page) == "Title\nThe text of it all."


def test_text_ends_a_head(model):
    assert html_text.main_text(model, "<head><title>t</title>\n Just some text.") == "Just some text."


def test_formulas_are_shown(model):
    formula = "<math><semantics><mrow><mi>a</mi><mo>=</mo><mn>2</mn></mrow><annotation encoding='application/x-tex'>a = {2}</annotation></semantics></math>"
    assert html_text.main_text(model, f"<article><p>It holds that {formula} for all of them.</p></article>") == "It holds that a=2 for all of them."


@pytest.mark.parametrize("block", [
    "p.lead", "p.intro", "div.foo", "div.paragraph", "div.wp-block-group", "ul.steps", "p.share-price", "div.note", "h2.xyzzy", "blockquote.q1", "section.part-7",
])
def test_unknown_names_inside_of_an_article(model, block):
    tag, name = block.split(".")
    inner = "<li>Second of them all.</li>" if tag == "ul" else "Second of them all."
    page = f'<nav class="menu"><a>Home</a></nav><article><p>First text.</p><{tag} class="{name}">{inner}</{tag}><p>Third text.</p></article>'
    assert html_text.main_text(model, page) == "First text.\nSecond of them all.\nThird text."


def test_all_blocks_named(model):
    page = '<div class="site-nav menu"><a>Home</a></div><article class="a1"><h1 class="t9 big">The title</h1><p class="x">One text.</p><div class="zz"><p class="y">Two texts.</p></div></article>'
    assert html_text.main_text(model, page) == "The title\nOne text.\nTwo texts."


@pytest.mark.parametrize("menu", ["<nav><a href=/foo/>Home</a> <a href=/news/>News</a></nav>", "<div class=menu data-u=http://a/b/><a href=/x/>Home</a> News</div>", "<nav/><a>Home</a></nav>"])
def test_unquoted_values_and_void_slashes(model, menu):
    assert html_text.main_text(model, menu + ARTICLE + menu) == "Title\nThe text of it all."


def test_foreign_elements_close_themselves(model):
    assert html_text.main_text(model, "<article><p>It is <math><mi>a</mi><mspace/><mi>b</mi></math> here<svg><path d=x /></svg> now.</p></article>") == "It is ab here now."
