"""Pages without an article element that stand at several addresses."""

from hustings.llm import extract, page_lines


def page(*lines):
    return "<html><body>" + "".join(f"<div>{line}</div>" for line in lines) + "</body></html>"


def test_copies_keep_their_text(frame):
    mirrored = page("Menu of the site", "A story told twice", "and its end")
    rows = [
        (1, "http://a.org/x/1", mirrored),
        (2, "http://a.org/x/2", mirrored),
        (3, "http://a.org/x/3", page("Menu of the site", "Another story")),
        (4, "http://b.org/1", mirrored),
        (5, "http://b.org/2", mirrored),
    ]
    got = {r.page_id: r.text for r in extract.main_texts(frame(rows, "page_id bigint, url string, html string")).collect()}
    assert got[1] == got[2] == "A story told twice\nand its end" and got[3] == "Another story"
    assert got[4] == got[5] == "Menu of the site\nA story told twice\nand its end"


def test_open_lines_are_never_all_deleted():
    lines = page_lines.page_lines(page("one", "two"))
    assert page_lines.main_text(lines, {0, 1}) == "one\ntwo"
