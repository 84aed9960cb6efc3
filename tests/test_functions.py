import html
import math
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from hustings.functions.numbers import money, number_or_zero, percent, uniform
from hustings.functions.text import (
    MAJOR_PARTIES,
    MAJOR_PARTIES_LONG,
    category,
    major_party,
    missing_to_null,
    name_key,
    plain_text,
    title_case,
    unescape,
    word_count,
)

FEW = settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def test_numbers_or_zero(column):
    texts = [" 12 ", "1e3", "+5", ".5", "1,234", "0x10", "1_000", "", "TOTAL", "1d", "NaN", None, "5.", "-2.5E-1", "inf"]
    assert column(number_or_zero, texts) == [12, 1000, 5, 0.5, 0, 0, 0, 0, 0, 0, 0, 0, 5, -0.25, math.inf]


@FEW
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False).map(repr) | st.text("0123456789.eE+-dfx, ", max_size=6), min_size=30))
def test_numbers_follow_float_syntax(column, texts):
    def expected(t):
        if re.fullmatch(r"\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*", t, re.ASCII):
            return float(t)
        return 0.0

    assert column(number_or_zero, texts) == [expected(t) for t in texts]


def test_titles(column):
    texts = ["O'BRIEN", "JAMMU-KASHMIR", "A&N ISLANDS", " tamil nadu ", "3rd place", "\tX y\n", None, "தமிழ்abc"]
    got = column(title_case, texts)
    assert got == ["O'Brien", "Jammu-Kashmir", "A&N Islands", "Tamil Nadu", "3Rd Place", "X Y", None, "தமிழ்Abc"]


@FEW
@given(st.lists(st.text("abcXYZéÀ '-&.09\t", max_size=12), min_size=30))
def test_titles_follow_title_then_strip(column, texts):
    assert column(title_case, texts) == [t.title().strip() for t in texts]


def test_money(column):
    texts = ["Rs 5,000", "Rs 1,23,456 ~ 1 Lacs+", "Rs 1 Crore 20 Lacs", "Rs 10.50", "Nil", " ", "-", "~9", None, "Rs १२"]
    assert column(money, texts) == [5000, 123456, 120, 1050, 0, 0, 0, 0, 0, 12]


@FEW
@given(st.lists(st.text("Rs ,.~Nil0123456789-", max_size=20), min_size=30))
def test_money_joins_all_digits_before_the_tilde(column, texts):
    def expected(t):
        digits = "".join(re.findall(r"\d+", t.split("~")[0]))
        return 0.0 if "Nil" in t or not digits else float(digits)

    assert column(money, texts) == [expected(t) for t in texts]


def test_major_party(column):
    texts = ["AIADMK", "bjp", "INCREDIBLE PARTY", "IND", None, "CPI"]
    assert column(lambda c: major_party(c, any_case=False), texts) == [1, 0, 1, 0, 0, 0]
    assert column(major_party, texts) == [1, 1, 1, 0, 0, 0]
    assert column(lambda c: major_party(c, MAJOR_PARTIES_LONG), texts) == [1, 1, 1, 0, 0, 1]
    assert len(MAJOR_PARTIES_LONG) == 13 and len(MAJOR_PARTIES) == 11


def test_missing_texts_and_categories(column):
    assert column(missing_to_null, ["", "NA", "n/a", "None", "0", " "]) == [None, None, None, None, "0", " "]
    assert column(category, [None, "x"]) == ["nan", "x"]


def test_names_compare_without_case_and_punctuation(column):
    assert len(set(column(name_key, ["DR. A. B. Rao", " dr a b  rao", "Dr A.B. Rao."]))) == 1


@pytest.mark.parametrize("text", ["a&amp;b", "&#65;&#x20AC;x", "&#bad;&lt;b&gt;", "&amp;#65;", "no &", "&quot;q&#39;", "&nbsp;x"])
def test_references_decode_like_the_standard_library(column, text):
    if text == "&#bad;&lt;b&gt;":
        assert column(unescape, [text]) == ["&#bad;<b>"]
    else:
        assert column(unescape, [text]) == [html.unescape(text)]


def test_plain_text(column):
    assert column(plain_text, ["<b>A &amp; B</b>", "\n <i>x</i> <!-- y --> "]) == ["A & B", "x"]


def test_words(column):
    assert column(word_count, ["", "  ", "a", " a  b\nc ", None]) == [0, 0, 1, 3, 0]


def test_percent_and_noise(column):
    assert column(lambda c: percent(c.cast("double")), ["0.8", "0.12346"]) == ["80.00%", "12.35%"]
    noise = column(lambda c: uniform(c, 2026), [str(i) for i in range(400)])
    assert all(0 <= x < 1 for x in noise) and 0.4 < sum(noise) / 400 < 0.6
    assert noise == column(lambda c: uniform(c, 2026), [str(i) for i in range(400)])
