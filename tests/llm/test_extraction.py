import html
import random
import re

import pytest

import compare
from tavola.llm import extraction
from tavola.llm.labelled_pages import labelled_page, labelled_pages
from tavola.llm.tables import pages


@pytest.fixture(scope="module")
def model():
    return extraction.train(labelled_pages())


def test_held_out_layouts(model):
    rng, right, total = random.Random(404), 0, 0
    for _ in range(150):
        tree = extraction.parse(labelled_page(rng))
        likely = extraction.main_blocks([tree], model)[0]
        right += sum((p >= 0.5) == b.main for p, b in zip(likely, tree.blocks))
        total += len(likely)
    assert right / total > 0.99


def test_messages_equal_enumeration(model):
    tree = extraction.parse("<body><nav><p>a</p></nav><article><h1>b</h1><p>c <b>d</b></article>")
    import itertools

    import numpy as np

    found = extraction._features(tree)
    own = [sum(model.weights.get(n, 0) * v for n, v in f) for f in found]
    weight = np.zeros(len(own))
    whole = 0.0
    for labels in itertools.product((0, 1), repeat=len(own)):
        energy = sum(o for o, x in zip(own, labels) if x)
        for x, b in zip(labels, tree.blocks):
            if b.parent >= 0:
                energy += model.ties.get(b.tag, 0) * (2 * x - 1) * (2 * labels[b.parent] - 1)
        whole += np.exp(energy)
        weight += np.exp(energy) * np.array(labels)
    assert np.allclose(extraction.main_blocks([tree], model)[0], weight / whole)


def test_given_pages(spark):
    """The article of the given layout, cut out by a pattern."""
    table = pages(spark, f"{compare.DATA}/sf0.01")
    got = {r["page_id"]: r for r in extraction.extract_pages(table).collect()}
    for r in table.collect():
        inner = re.search("<article>(.*)</article>", r["html"], re.S)[1]
        parts = [html.unescape(re.sub("</?b>", "", x.replace("<br>", " "))) for x in re.split("</?(?:p|h1)>", inner)]
        text = "\n".join(" ".join(x.split()) for x in parts if x.strip())
        assert got[r["page_id"]]["text"] == text and got[r["page_id"]]["n_chars"] == len(text)


def test_text_of_blocks(model):
    page = (
        "<body><div class=cookie-notice>We use &amp; need</div><article><h1>A &lt;b&gt; &eacute;</h1><p>one\n two <b>th</b>ree"
        "<p>four<br>five<script>var t='</p>';</script><ul><li>x<li>y</ul>tail</article><section class='comments'><p>Nice "
        "read, thanks a lot for it</p></section>"
    )
    assert extraction.extract([page, ""], model) == ["A <b> é\none two three\nfour five\nx\ny\ntail", ""]


def test_edge_rows(spark):
    rows = [(1, "u", None, 5), (None, None, "", 5), (2, "a", "</div><p>", 5), (2, "a", "<article><p>" + "<b>" * 3000 + "deep text here", 5)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int")
    got = sorted(((r["page_id"], r["text"], r["n_chars"]) for r in extraction.extract_pages(frame).collect()), key=str)
    assert got == sorted([(1, "", 0), (None, "", 0), (2, "", 0), (2, "deep text here", 14)], key=str)
    assert extraction.extract_pages(frame.limit(0)).collect() == []


@pytest.mark.parametrize(
    "before, inside",
    (
        ("<html><head><title>t</title><body>", ""),
        ("<html><head><title>t</title>", ""),
        ("<html><head><title>t<meta charset=utf-8><body>", ""),
        ("<html><head><script>var x = '<p>';</script><noscript><link href=x><body>", ""),
        ("<title>t</title>", ""),
        ("<body><div><select><option>one</div>", ""),
        ("<body><div><button><div>x</div>Menu</div>", ""),
        ("<body><button>Menu", ""),
        ("<body><button>Menu<button>Close</button>", ""),
        ("<body><div><object data=x><param name=y></div>", ""),
        ("<body>", "<p><canvas>old</p>"),
        ("<body>", "<div><noscript>no script</div>"),
        ("<body>", "<div><canvas><button><div>a</div>b</canvas></div>"),
    ),
)
def test_hidden_elements_that_are_not_closed(model, before, inside):
    page = f"{before}<article>{inside}<h1>Title of it</h1><p>A text of some length that stands in the article.</p><p>And more.</p></article>"
    text = extraction.extract([page], model)[0]
    assert text == "Title of it\nA text of some length that stands in the article.\nAnd more."


def test_text_ends_the_head():
    pieces = [text for _, text in extraction.parse("<html><head><title>t</title> plain text</html>").pieces]
    assert pieces == ["plain text"]


def test_closed_hidden_elements_hold_blocks(model):
    page = "<article><p>one two three</p><noscript><article><p>no</p></article></noscript><button><div>no</div><p>no</button><p>four</p></article>"
    assert extraction.extract([page], model) == ["one two three\nfour"]
