"""Every page goes through the comparison; the structure is checked after it."""

from hustings.llm import extract
from hustings.llm.extract import main_texts


def article(*lines):
    return "<nav><p>Start</p><p>Sitemap</p></nav><article>" + "".join(f"<p>{line}</p>" for line in lines) + "</article><p>Since 1900</p>"


def test_pages_with_an_article_are_compared(frame):
    rows = [
        (1, "http://a.org/x/1", article("One", "told by both", "end of one")),
        (2, "http://a.org/x/2", article("Two", "told by both")),
        (3, "http://b.org/1", article("Alone")),
        (4, "http://c.org/x/1", None),
    ]
    got = {r.page_id: r for r in main_texts(frame(rows, "page_id int, url string, html string")).collect()}
    assert [got[i].text for i in (1, 2, 3, 4)] == ["One\ntold by both\nend of one", "Two\ntold by both", "Alone", ""]
    # Shared with the neighbour: two menu lines, the passage and the line below; taken back is only the passage.
    assert got[2].n_shared == got[1].n_shared == 4 and got[3].n_shared == got[4].n_shared == 0


def test_texts_are_not_written(frame, monkeypatch):
    """Texts are dealt once to the results of the comparison; a written copy beside that would double the disk."""
    written = []
    keep = extract.stored
    monkeypatch.setattr(extract, "stored", lambda df, name: written.append((name, df.columns)) or keep(df, name))
    rows = [(i, f"http://a.org/x/{i}", article(f"Page {i}", "told by all", "x" * i)) for i in range(1, 9)]
    got = {r.page_id: r for r in main_texts(frame(rows, "page_id int, url string, html string")).collect()}
    assert all(got[i].text == f"Page {i}\ntold by all\n{'x' * i}" and got[i].n_shared == 4 for i in got) and len(got) == 8
    assert [name for name, _ in written] == ["page-lines", "line-lists", "page-order"]
    assert not {"packed", "html", "text"} & {c for _, columns in written for c in columns}
