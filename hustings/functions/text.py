"""Text expressions."""

from __future__ import annotations

import json
from functools import reduce
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# Party names whose appearance inside a party text marks a major party.
MAJOR_PARTIES_LONG = [
    "BJP", "INC", "AITC", "DMK", "AIADMK", "CPI(M)", "JD(U)", "AGP", "AIUDF", "TMC", "IUML", "CPI", "PMK",
]
MAJOR_PARTIES = ["BJP", "INC", "AITC", "DMK", "AIADMK", "CPI(M)", "JD(U)", "AGP", "AIUDF", "TMC", "IUML"]
MAJOR_PARTIES_WEB = ["BJP", "INC", "AITC", "DMK", "AIADMK", "CPI(M)", "JD(U)", "AGP", "AIUDF", "TMC"]

# Cell texts that a spreadsheet reader takes as missing.
MISSING_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
]

# What may stand in a tag up to its end: quoted values may hold the closing sign.
ATTRIBUTES = r"""(?:"[^"]*+"|'[^']*+'|[^>"']++)*+"""
REFERENCE = r"&(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"

BLANK = r"[\s\x1c-\x1f\x85\p{Z}]"


def missing_to_null(c: Column) -> Column:
    return F.when(~c.isin(MISSING_TEXTS), c)


def strip(c: Column) -> Column:
    """Remove white space of any kind, tabs and line breaks included, at both ends."""
    return F.regexp_replace(c, f"^{BLANK}+|{BLANK}+$", "")


def title_case(c: Column) -> Column:
    """Upper-case every letter that follows a non-letter, lower-case the rest, and strip."""
    words = F.split(F.lower(c), r"(?<=[^\p{Lu}\p{Ll}\p{Lt}])")
    capital = F.transform(words, lambda w: F.concat(F.upper(F.substr(w, F.lit(1), F.lit(1))), F.substr(w, F.lit(2))))
    return strip(F.array_join(capital, ""))


def name_key(c: Column) -> Column:
    """A person's name reduced to what two sources agree on: case, punctuation and spacing removed."""
    return strip(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", " "))


def contains_any(c: Column, parts: list[str]) -> Column:
    hit = reduce(lambda a, b: a | b, [c.contains(p) for p in parts])
    return F.coalesce(hit, F.lit(False))


def major_party(party: Column, names: list[str] | None = None, any_case: bool = True) -> Column:
    """1 when the party text contains one of the names."""
    text = F.upper(party) if any_case else party
    return contains_any(text, MAJOR_PARTIES if names is None else names).cast("int")


def category(c: Column) -> Column:
    """A nullable value as a category of its own: null becomes the text ``nan``."""
    return F.coalesce(c.cast("string"), F.lit("nan"))


def word_count(c: Column) -> Column:
    return F.coalesce(F.regexp_count(c, F.lit(r"\S+")), F.lit(0))


def unescape(c: Column) -> Column:
    """Character references (named, decimal, hexadecimal) back to characters, in one pass from left to right."""
    known = {name[:-1]: char for name, char in html5.items() if name.endswith(";")}
    named = F.from_json(F.lit(json.dumps(known)), "map<string,string>")

    def decoded(ref: Column) -> Column:
        is_hex = F.lower(F.substring(ref, 2, 1)) == "x"
        code = F.when(is_hex, F.conv(F.substr(ref, F.lit(3)), 16, 16)).otherwise(F.conv(F.substr(ref, F.lit(2)), 10, 16))
        number = F.conv(code, 16, 10).cast("bigint")
        valid = (number > 0) & (number <= 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
        char = F.when(valid, F.decode(F.unhex(F.lpad(code, 8, "0")), "UTF-32")).otherwise(F.lit("\ufffd"))
        text = F.when(F.startswith(ref, F.lit("#")), char).otherwise(F.try_element_at(named, ref))
        return F.coalesce(text, F.concat(F.lit("&"), ref, F.lit(";")))

    between = F.split(c, REFERENCE, F.lit(-1))
    refs = F.transform(F.regexp_extract_all(c, F.lit(REFERENCE), F.lit(1)), decoded)
    parts = F.transform(F.arrays_zip(between.alias("a"), refs.alias("b")), lambda p: F.concat(p["a"], F.coalesce(p["b"], F.lit(""))))
    return F.when(c.rlike(REFERENCE), F.array_join(parts, "")).otherwise(c)


def plain_text(markup: Column) -> Column:
    """Text of a piece of markup: comments and tags removed, references decoded, ends stripped."""
    return strip(unescape(F.regexp_replace(markup, rf"(?s)<!--.*?-->|<{ATTRIBUTES}>|<[^>]*>", "")))
