"""Block parsing, the labeller's gradients, and accuracy on pages it has not seen."""

import numpy as np
import pytest

from emberlake.llm import htmltext
from emberlake.llm.common import read_table

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize(
    "page, blocks",
    [
        (None, []),
        ("", []),
        ("plain &amp; text", ["plain & text"]),
        ("<p>a\n b<b> c</b>d<p>e", ["a b cd", "e"]),
        ("<p>a<br>b</p>", ["a b"]),
        ("<script>var x='</p>';</script><p>x</p><style>p{}</style>", ["x"]),
        ("<script>never closed <p>x", []),
        ("<!-- <p>no</p> --><p>yes", ["yes"]),
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", ["a", "b", "c", "d"]),
        ("<p>&lt;b&gt; &nbsp;&#233;&copy; &am", ["<b> é© &am"]),
        ("<p title='a>b'>c</p", ["c</p"]),
        ("</p></div>x<div>y</span></div>z", ["x", "y", "z"]),
        ("<table><tr><td>1<td>2<tr><td>3</table>", ["1", "2", "3"]),
        ('<a href="x>y" b', ['y" b']),
    ],
)
def test_blocks(page, blocks):
    assert [b.text for b in htmltext.parse_blocks(page)] == blocks


def test_paths_and_labels():
    page = '<body><main><article><p>x</p><div class="ad big">y</div></article></main><section id=comments><article>z</article></section><div>?</div>'
    blocks = htmltext.parse_blocks(page)
    assert blocks[1].path == ("body", "main", "article", "div", ".ad", ".big")
    assert [htmltext.markup_label(b.path) for b in blocks] == [1, 0, 0, None]


def test_gradients():
    rng = np.random.default_rng(0)
    model = htmltext.Labeller(5, hidden=3)
    model.weights = {k: w.astype(np.float64) for k, w in model.weights.items()}
    pages = [rng.normal(size=(n, 5)) for n in (4, 2, 3)]
    labels = [rng.integers(0, 2, len(p)) for p in pages]
    x, mask = htmltext.Labeller.padded(pages)
    y = np.zeros_like(mask)
    for i, own in enumerate(labels):
        y[: len(own), i] = own

    def loss():
        f, _ = model._run(x, mask, "f")
        b, _ = model._run(x, mask, "b")
        p = htmltext._sigmoid(np.concatenate((f, b), axis=2).astype(float) @ model.weights["o"] + model.weights["oc"])
        return -((y * np.log(p) + (1 - y) * np.log(1 - p)) * mask).sum() / mask.sum()

    grads = {}
    f, kept_f = model._run(x, mask, "f")
    b, kept_b = model._run(x, mask, "b")
    both = np.concatenate((f, b), axis=2)
    error = (htmltext._sigmoid(both @ model.weights["o"] + model.weights["oc"]) - y) * mask / mask.sum()
    d = error[:, :, None] * model.weights["o"]
    model._back(x, kept_f, d[:, :, :3], "f", grads)
    model._back(x, kept_b, d[:, :, 3:], "b", grads)
    for key in ("xf", "hf", "cf", "xb", "hb", "cb"):
        weight = model.weights[key]
        for at in [tuple(rng.integers(0, s) for s in weight.shape) for _ in range(4)]:
            before = weight[at]
            weight[at] = before + 1e-2
            up = loss()
            weight[at] = before - 1e-2
            down = loss()
            weight[at] = before
            assert abs((up - down) / 2e-2 - grads[key][at]) < 2e-3


def test_extraction_of_held_out_pages(spark):
    pages = read_table(spark, SF, "pages")
    model = htmltext.train(pages.filter("page_id % 2 = 0"))
    rest = pages.filter("page_id % 2 = 1")
    got = {r["page_id"]: r for r in htmltext.extract(rest, model).collect()}
    right = blocks = 0
    for page in rest.collect():
        want = [b.text for b in htmltext.parse_blocks(page["html"]) if htmltext.markup_label(b.path) == 1]
        text = got[page["page_id"]]["text"]
        assert got[page["page_id"]]["n_chars"] == len(text)
        right += text == "\n".join(want)
        blocks += 1
    assert right / blocks > 0.97
    other = """<html><head><title>T of it</title></head><body><header><p>The site's name and motto</p></header>
    <nav><ul class="menu"><li><a href="/">Home</a></li></ul></nav><div class="cookie-notice"><p>We use cookies here.</p></div>
    <main><article><h1>A long story</h1><p>It begins here, with many words in a row.</p><div class="ad"><p>Buy it now!</p></div>
    <p>Then it goes on for some time, with more words.</p><form><label>Mail</label><button>Send</button></form></article></main>
    <aside class="sidebar"><p>Other stories that you may like to read.</p></aside>
    <section class="comments"><div class="comment"><p>I liked it very much, thank you all.</p></div></section><footer>Bye</footer></body></html>"""
    frame = spark.createDataFrame([(1, other)], "page_id long, html string")
    assert htmltext.extract(frame, model).first()["text"].split("\n") == [
        "A long story", "It begins here, with many words in a row.", "Then it goes on for some time, with more words.",
    ]


def test_blocks_of_unnamed_pages(spark):
    """Pages it has not seen, with telling elements and names taken away: words, lengths and order are left."""
    pages = [r["html"] for r in read_table(spark, "/root/testdata/sf0.1", "pages").orderBy("page_id").limit(450).collect()]
    parsed = [htmltext.parse_blocks(p) for p in pages]
    labels = [[-1 if (m := htmltext.markup_label(b.path)) is None else m for b in blocks] for blocks in parsed]
    model = htmltext.fit_pages(parsed[:250], labels[:250])
    rng = np.random.default_rng(5)
    for seen in (parsed[250:], [htmltext.unnamed(p, rng) for p in parsed[250:]]):
        kept = np.concatenate(model.probabilities([htmltext.vectors(p) for p in seen])) >= 0.5
        real = np.concatenate([np.array(marks) for marks in labels[250:]])
        assert (kept & (real == 1)).sum() >= 0.97 * kept[real >= 0].sum()
        assert (kept & (real == 1)).sum() >= 0.97 * (real == 1).sum()


def test_names_in_other_case(spark):
    pages = spark.createDataFrame([(1, "<main><p>x</p></main>", "a", "b")], "page_id long, html string, Text string, N_CHARS string")
    got = htmltext.extract(pages, None)
    assert got.columns == ["page_id", "text", "n_chars"] and got.collect() == [(1, "x", 1)]
