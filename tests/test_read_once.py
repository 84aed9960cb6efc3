"""What several steps read is made once."""

import pytest

from hustings.sources import pages

PAGE = """<table id="table1"><tr><th>Candidate</th><th>Party</th><th>Constituency</th><th>Total Assets</th></tr>
<tr><td>A {i}</td><td>P{p}</td><td>AC {c}</td><td>Rs {v}</td></tr><tr></tr><tr><td>B {i}</td><td>Q</td><td>AC {c}</td><td>Rs 5</td></tr></table>"""


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture
def stored_pages(frame):
    rows = [(f"s{i % 3}2021", PAGE.format(i=i, p=i % 4, c=i % 5, v=i * 1000)) for i in range(40)]
    return frame([*rows, ("s12021", "<p>none</p>"), ("s22021", '<table id="table1"></table>')], "source string, html string")


def test_tables_are_cut_into_rows_once(spark, stored_pages):
    table_id = pages.TABLE_ID
    html = stored_pages.selectExpr("source", f"replace(html, 'table1', '{table_id}') as html")
    rows = pages.page_candidates(html)
    assert rows.count() == 80
    assert "size(regexp_extract_all" not in optimized(rows)
