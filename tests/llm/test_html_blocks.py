import html
import re
import time

import numpy as np
import pytest

from dwellmap.llm import html_blocks as hb
from dwellmap.llm.queries import op2_html_text

SF_DIR = "/root/testdata/sf0.01"


def texts(page):
    return [t for t, _, _ in hb.blocks(page)]


@pytest.mark.parametrize(
    "page,want",
    [
        (None, []),
        ("", []),
        ("plain &amp; simple\n text", ["plain & simple text"]),
        ("<p>a<p>b</p>c", ["a", "b", "c"]),
        ("<p><b>x.<br><p>y</p>z</b>", ["x.", "y", "z"]),
        ("<script>var t='</p>';</script><p>in<i>li</i>ne &copy;&#233;</p><!-- a > b --><style>p{}</style>", ["inline ©é"]),
        ("<ul><li>1<li>2<ul><li>3</ul><li>4</ul>", ["1", "2", "3", "4"]),
        ("<div class='a>b'>x</div><p title=\"</p>\">y", ["x", "y"]),
        ("a < b and <3 <unclosed", ["a < b and <3 <unclosed"]),
        ("<p>x</div></span>y</p>", ["x", "y"]),
        ("<script>never closed", []),
    ],
)
def test_blocks(page, want):
    assert texts(page) == want


def test_paths_and_links():
    (text, path, share), = hb.blocks('<div id=Top class="Nav-bar x1"><a href=1>home</a></div>')
    assert (text, path, share) == ("home", ("div top nav bar x",), 1.0)


@pytest.mark.parametrize(
    "unit,tail",
    [
        ("<a ", ""), ("<a<a", ""), ('<a "', ""), ("<a '\" ", ""), ("<div>", "x"), ("<div>x", "</i></foo>" * 9),
        ("<svg/>", "x"), ("<li>x<b>", ""), ("<b><p>x</b>", ""), ("<!-- ", ""), ("<div>x", "</foo>" * 90_000),
    ],
)
def test_time_grows_with_the_page(unit, tail):
    """Some 0.2 s here for 200 000 characters; the square of it would be minutes."""
    started = time.process_time()
    hb.blocks(unit * (200_000 // len(unit)) + tail)
    assert time.process_time() - started < 5


def test_unclosed_tags_are_text_and_closed_ones_are_found_behind_them():
    assert texts("<a <b \"<p>x") == ['<a <b "', "x"]
    assert texts("<p title='>x</p><i \">y") == ["<p title='>x", '<i ">y']
    assert texts("<script><a '</script><p>in</p>") == ["in"]


def test_references_of_very_many_digits():
    assert texts("&#" + "9" * 6000 + "; &#" + "0" * 6000 + "65;") == ["\ufffd A"]


def test_paths_share_what_is_around_them():
    outer, inner = (path for _, path, _ in hb.blocks("<div id=a>x<section>y"))
    assert inner.outer is outer and list(inner) == ["div a", "section"] and len(inner) == 2


def test_long_pages_are_read_in_slices(monkeypatch):
    page = hb.blocks("".join(f"<p class=c{n % 7}>word {n}" + ".</p>" * (n % 3) for n in range(500)))
    model = hb.Labeller.start(3)
    want = hb.label(model, [hb.vectors(page)])[0]
    monkeypatch.setattr(hb, "_BATCH_BLOCKS", 64)
    np.testing.assert_allclose(hb.label_long(model, page), want, atol=1e-5)
    source = "<p>a. </p>" * 100
    assert hb.main_text(model, [source, None, "<p>b", source, "<p>b"]) == [
        t for p in (source, None, "<p>b", source, "<p>b") for t in hb.main_text(model, [p])
    ]


def test_gradients_match_differences():
    rng = np.random.default_rng(2)
    model = hb.Labeller.start(1)
    for i, part in enumerate(model.parts()):
        setattr(model, "wubvc"[i], part.astype(np.float64))
    x = rng.normal(size=(2, 4, hb.INPUTS)) * 0.3
    mask = np.array([[1, 1, 1, 1], [1, 1, 0, 0]], float)
    x *= mask[:, :, None]
    y = rng.integers(0, 2, (2, 4)) * mask

    def loss():
        p = model.probabilities(x, mask)
        return -(mask * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum() / mask.sum()

    for part, grad in zip(model.parts(), model.gradients(x, mask, y), strict=True):
        for at in rng.integers(0, part.size, 6):
            old = part.flat[at]
            part.flat[at] = old + 1e-4
            up = loss()
            part.flat[at] = old - 1e-4
            down = loss()
            part.flat[at] = old
            assert abs((up - down) / 2e-4 - grad.flat[at]) < 1e-3


def article(page):
    inner = page[page.index("<article>") + 9 : page.index("</article>")]
    parts = re.split(r"</?(?:p|h1|br)\b[^>]*>", inner)
    return " ".join(" ".join(html.unescape(re.sub(r"</?b>", "", p)).split()) for p in parts)


def test_pages_of_the_table(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()}
    rows = op2_html_text(spark, SF_DIR).collect()
    assert {r.page_id for r in rows} == set(pages) and len(rows) == len(pages)
    right = 0
    for r in rows:
        assert r.url == pages[r.page_id].url and r.n_chars == len(r.text)
        right += r.text.split() == article(pages[r.page_id].html).split()
    assert right >= 0.98 * len(rows)


def test_held_out_layouts(spark):
    model = hb.train(spark.read.parquet(f"{SF_DIR}/pages.parquet"))
    rng = np.random.default_rng(77)
    want, got = [], []
    vocabulary = ["".join(rng.choice(list("abcdeéstn,."), rng.integers(1, 9))) for _ in range(400)]
    for _ in range(200):
        page, flags = hb.training_page(rng, vocabulary)
        found = hb.blocks(page)
        if len(found) == len(flags):
            want += flags
            got += list(hb.label(model, [hb.vectors(found)])[0] >= 0.5)
    want, got = np.array(want), np.array(got)
    assert got[want].mean() > 0.95 and got[~want].mean() < 0.05


def test_edge_rows(spark):
    schema = "page_id long, text string, html string, n_chars string"
    page = "<nav><a href=1>Home</a></nav><article><p>Some &lt;long&gt; words, in a row of words.</p></article>"
    model = hb.train(spark.createDataFrame([(1, "t", page, "n")] * 3, schema))
    rows = [(1, "t", None, "n"), (2, None, "", None), (None, "t", page, "n"), (None, "t", page, "n")]
    rows += [(3, "t", "<article>" + "<p>word word word word.</p>" * 20_000 + "</article>", "n")]
    got = hb.extract(spark.createDataFrame(rows, schema), model).collect()
    assert len(got) == 5
    by_id = {r.page_id: r for r in got}
    assert by_id[1].text == by_id[2].text == "" and by_id[1].n_chars == 0
    assert by_id[None].text == "Some <long> words, in a row of words."
    assert by_id[3].text.count("word.") > 19_000
    empty = spark.createDataFrame([], schema)
    assert hb.extract(empty, hb.train(empty)).collect() == []
