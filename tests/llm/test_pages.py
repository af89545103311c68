"""Pages written by hand, not by the generator that the network learns from."""

import time

import pytest

from tidemark.llm import html_text

TOP = '<html><head><title>Council</title></head><body><nav><ul><li><a href="/">Home</a></li><li><a href="/n">News</a></li><li><a href="/c">Contact us</a></li></ul></nav>'
END = "<footer>Copyright 2024 Example Media. All rights reserved.</footer></body></html>"
PARAGRAPHS = [
    "The town council met on Tuesday to discuss the new bridge. Several residents said they were worried about the cost.",
    "Work is expected to begin next spring and will take about two years.",
    "Engineers inspected the old structure and found cracks in three places. The mayor thanked everyone who took part.",
]


@pytest.fixture(scope="module")
def model():
    return html_text.trained()


@pytest.mark.parametrize("container", ["<article>{}</article>", "<main>{}</main>", '<div class="content">{}</div>', "<div>{}</div>", '<div class="qx17">{}</div>', '<div id="bodyContent"><div class="inner">{}</div></div>', "{}"])
def test_containers(model, container):
    body = "<h1>Council meets about bridge</h1>" + "".join(f"<p>{p}</p>" for p in PARAGRAPHS)
    text = html_text.main_texts([TOP + container.format(body) + END], model)[0].split("\n")
    assert [t for t in text if t in PARAGRAPHS] == PARAGRAPHS and not {"Home", "News", "Contact us"} & set(text) and not any("Copyright" in t for t in text)


@pytest.mark.parametrize(
    ("page", "texts"),
    [
        ("<a " * 100_000, ["<a " * 99_999 + "<a"]),
        ("<div>" * 8000 + "<p>x</p>" * 8000, ["x"] * 8000),
        ("<div>" * 3000 + "</x>" * 30_000 + "text", ["text"]),
        ('<a "' * 50_000 + ">t", ["t"]),
        ("<p>a</p><script>var x = 1 < 2; if (a > b) text", ["a"]),
        ("<p>a</p><!-- b <i>c</i> d", ["a"]),
        ("<p>a</p> rest < of text", ["a", "rest < of text"]),
        ("<p>1<svg/>2</p><p>x <math><mi>y</mi></math></p>", ["1 2", "x y"]),
        ("", []),
        (None, []),
        ("no tags &amp; text", ["no tags & text"]),
    ],
)
def test_odd_pages_are_read_whole_and_fast(page, texts):
    began = time.process_time()
    assert [b.text for b in html_text.blocks(page)] == texts
    assert time.process_time() - began < 5
