"""Pages that are broken, long or hinted, and what the comparison decides."""

import time

import pytest

from hustings.llm import page_lines
from hustings.llm.extract import main_texts


@pytest.mark.parametrize("piece", ["<a ", "<span>", "<a \"'>", "<!", "<b></x>", "<!--", "<script>", "<p class=advert>a", "<", "<div>", "<![CDATA[", "&amp", "<a b='x>", "<h1>"])
def test_a_megabyte_of_unclosed_markup(piece):
    start = time.perf_counter()
    page_lines.page_lines(piece * (1_000_000 // len(piece)))
    assert time.perf_counter() - start < 3


def lines(html):
    return page_lines.main_text(page_lines.page_lines(html), set())


def test_hinted_paragraphs_are_not_content():
    page = "<article><p>one<p class='advert'>buy <b>now</b> cheap<p>two</p><p id=cookie-notice>we use</p>tail<p hidden>gone</article>"
    assert lines(page) == "one\ntwo\ntail"


@pytest.mark.parametrize("name, kept", [
    ("related work", True), ("related-posts", False), ("search results-of-study", True), ("search-form", False), ("notice", False),
    ("notice of meeting", True), ("social", False), ("social-history", True), ("share-buttons", False), ("comments", False), ("tags list", False),
])
def test_words_that_name_only_part_of_a_section(name, kept):
    assert (lines(f"<article><p>a</p><section class='{name}'><p>b</p></section></article>") == "a\nb") == kept


def test_broken_tags_lose_no_text():
    assert lines("<article><p>a < b and c <d</p><p>x <a title=it's>y</a> z</p></article>") == "a < b and c\nx y z"
    assert lines("<p>1 < 2 and <b") == "1 < 2 and <b"
    assert lines('<p>a<img alt="x > y">b</p><!-- <p>c</p> --><p>d <!-- open') == "ab\nd"
    assert lines("text <![CDATA[ <p>x ]]> more") == "text more"


def test_settled_pages_need_no_other_and_open_ones_are_compared(spark, frame):
    """A host with an article page and open pages: the article's lines count in the comparison, its text stays."""
    shell = "<div>Our site</div><p>{}</p><div>Imprint</div>"
    rows = [(i, f"http://h.org/a/{i}", shell.format(f"Story {i}")) for i in range(3)]
    rows += [(7, "http://h.org/a/7", "<div>Our site</div><article><p>Article</p></article><div>Imprint</div>"), (8, "http://g.org/x", "<main>Whole</main>")]
    got = {r.page_id: r.text for r in main_texts(frame(rows, "page_id int, url string, html string")).collect()}
    assert got == {0: "Story 0", 1: "Story 1", 2: "Story 2", 7: "Article", 8: "Whole"}
    only = main_texts(frame([rows[4], (9, None, None), (10, "u", "<nav>menu</nav>")], "page_id int, url string, html string"))
    assert {r.page_id: (r.text, r.n_chars) for r in only.collect()} == {8: ("Whole", 5), 9: ("", 0), 10: ("", 0)}


def test_long_addresses(spark, frame):
    rows = [(i, "http://h.org/" + "a/" * 100_000 + str(i), f"<p>same</p><p>own {i}</p>") for i in range(4)]
    start = time.perf_counter()
    got = {r.page_id: r.text for r in main_texts(frame(rows, "page_id int, url string, html string")).collect()}
    assert got == {i: f"own {i}" for i in range(4)} and time.perf_counter() - start < 60
