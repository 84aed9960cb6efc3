from pyspark.sql import functions as F

from hustings.operators.cleaning import clean_candidates, drop_incomplete, with_defaults
from hustings.plans.web import candidates_from_pages
from hustings.sources.pages import WEB_COLUMNS, page_rows, pages_without_table, standard_name

PAGE = """<html><table id="other"><tr><th>Candidate</th></tr><tr><td>wrong</td></tr></table>
<table border=1 id='table1' class=x>
<tr><th>Sno<th>Candidate &nbsp;</th><th>Constituency</th><th>Party</th><th>Criminal Case</th><th>Education</th><th>Total Assets</th></tr>
<tr><td>1</td><td><b>A &amp; B</b></td><td> P </td><td>BJP</td><td>2</td><td>Graduate</td><td>Rs&nbsp;1,000 ~ 1 Thou+</td></tr>
<tr></tr>
<TR><TD>2<TD>C D</TD><TD>Q<TD>INC</TD><TD>x</TD><TD></TD><TD>Nil</TD></TR>
</table></html>"""


def test_only_the_named_table_is_read(frame):
    pages = frame([("kerala2021", PAGE), ("assam2021", "<html><table id=table10><tr><td>x</td></tr></table></html>")], "source string, html string")
    rows = page_rows(pages).orderBy("row_idx").collect()
    assert [r.cells for r in rows] == [
        ["1", "A & B", "P", "BJP", "2", "Graduate", "Rs 1,000 ~ 1 Thou+"],
        ["2", "C D", "Q", "INC", "x", "", "Nil"],
    ]
    assert rows[0].header[1] == "Candidate"
    assert [tuple(r) for r in pages_without_table(pages).collect()] == [("assam2021", "candidate table not found")]


def test_candidates_get_standard_columns_and_clean_values(frame):
    pages = frame([("Puducherry2021", PAGE)], "source string, html string")
    got = clean_candidates(candidates_from_pages(pages)).orderBy("row_idx").collect()
    assert [(r.state, r.candidate, r.constituency, r.party, r.crim_count, r.education, r.assets_numeric) for r in got] == [
        ("Puducherry", "A & B", "P", "BJP", 2.0, "Graduate", 1000.0),
        ("Puducherry", "C D", "Q", "INC", 0.0, "", 0.0),
    ]


def test_first_matching_name_wins(column):
    titles = ["CANDIDATE party", "Party Constituency", "Educational", "Liabilities", "Assets"]
    assert column(standard_name, titles) == ["candidate", "constituency", "education", "Liabilities", "total_assets"]
    assert list(WEB_COLUMNS) == ["candidate", "constituency", "party", "criminal", "educat", "asset"]


def test_absent_columns_get_defaults(frame):
    got = clean_candidates(frame([("x", None)], "candidate string, party string")).collect()[0]
    assert (got.party, got.education, got.constituency, got.crim_count, got.assets_numeric) == ("IND", "Unknown", "Unknown", 0, 0)
    assert with_defaults(frame([(1,)], "a int"), {"a": 0, "b": "z"}).collect()[0].asDict() == {"a": 1, "b": "z"}


def test_incomplete_rows_go_before_numbers_are_read(frame):
    df = frame([("a", "p", "x"), ("b", "p", None), (None, "p", "1")], "candidate string, constituency string, total_votes_raw string")
    assert [r.candidate for r in drop_incomplete(df, df.columns).collect()] == ["a"]
    assert drop_incomplete(df, ["candidate"]).where(F.col("total_votes_raw").isNull()).count() == 1


def test_tables_inside_cells_and_signs_inside_attributes(frame):
    html = """<table class="a>b" id="table1"><tr><th>Candidate</th><th>Party</th></tr>
    <tr><td title="x>y">A<table id=inner><tr><td> (old)</td></tr></table></td><td>P</td></tr>
    <tr><td>B &rsquo;99 &amp;lt; &#38;gt;</td><td>Q</td></tr></table><table><tr><td>after</td></tr></table>"""
    got = page_rows(frame([("s", html)], "source string, html string")).orderBy("row_idx").collect()
    assert [[" ".join(c.split()) for c in r.cells] for r in got] == [["A (old)", "P"], ["B \u201999 &lt; &gt;", "Q"]]
    assert got[0].header == ["Candidate", "Party"]


def test_pages_of_one_source_keep_their_rows_apart(frame):
    pages = frame([("s", PAGE), ("s", PAGE.replace("A &amp; B", "E"))], "source string, html string")
    found = candidates_from_pages(pages).collect()
    assert len({(r.source, r.page, r.row_idx) for r in found}) == len(found) == 4
