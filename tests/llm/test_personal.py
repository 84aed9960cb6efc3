"""Personal data against the plain regular expressions of the contract, and the added kinds by example."""

import hashlib
import random
import re

import pytest

from hustings.llm import personal
from hustings.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
ANCHORS = personal.automaton()


def plain_luhn(digits):
    doubled = [int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(digits[::-1])]
    return sum(doubled) % 10 == 0


def plain(text):
    """The base finds by the contract's own expressions."""
    found = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 12 <= len(digits) <= 19 and plain_luhn(digits):
            found.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


def test_base_over_the_table(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op12_personal_data"](spark, SF).collect()
    assert len(rows) == len(texts) and sum(r.n_email + r.n_ip + r.n_card + r.n_phone for r in rows) > 20
    for r in rows:
        found = plain(texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for _, k, _ in found) for i in range(4)]
        assert r.base_sha256 == hashlib.sha256(personal.written(found).encode()).hexdigest()
        assert set(filter(None, personal.written(found).split(","))) <= set(r.spans.split(","))


@pytest.mark.parametrize("letters", ["a.@-", "1.2 5", "0123456789 -", "+1 (2).-9", "a1.@+- é\U0001f600(", "@@.aa", "4 4-444444444444"])
def test_base_over_random_strings(letters):
    random.seed(letters)
    for _ in range(4000):
        text = "".join(random.choices(letters, k=random.randrange(60)))
        assert [f for f in personal.find(text, ANCHORS) if f[1] < 4] == plain(text), text


@pytest.mark.parametrize("kind, text, found", [
    ("login", "see ftp://bob:s3cret@files.example.org/x now", "ftp://bob:s3cret@files.example.org"),
    ("login", "see http://example.org/a@b", None),
    ("ipv6", "host 2001:db8::ff00:42 up", "2001:db8::ff00:42"),
    ("ipv6", "std::vector a::b", None),
    ("tel", "tel:030 123-4567.", "030 123-4567"),
    ("iban", "IBAN: DE89 3704 0044 0532 0130 00 please", "DE89 3704 0044 0532 0130 00"),
    ("iban", "IBAN: DE88 3704 0044 0532 0130 00 please", None),
    ("account", "Account number: 1234-567890", "1234-567890"),
    ("account", "accounting 1234567890", None),
    ("account", "on account of 3 things", None),
    ("ssn", "his SSN 123-45-6789,", "123-45-6789"),
    ("ssn", "SSN 666-45-6789", None),
    ("passport", "Passport no. C01X00T47", "C01X00T47"),
])
def test_added_kinds(kind, text, found):
    got = [text[a:b] for a, k, b in personal.find(text, ANCHORS) if personal.KINDS[k] == kind]
    assert got == ([found] if found else [])


@pytest.mark.parametrize("text", ["1" * 400_000, "1." * 200_000, "a@" * 200_000, "a" * 400_000 + "@", "+1" * 200_000, "4 " * 200_000,
                                  "::" * 200_000, "a://" * 100_000, "account " * 60_000, "tel:" * 100_000, "iban A" + "1 " * 90_000])
def test_very_long_texts_take_linear_time(text):
    import time

    start = time.perf_counter()
    personal.find(text, ANCHORS)
    assert time.perf_counter() - start < 5


def test_edge_rows(spark, frame):
    ddl = "doc_id bigint, text string, spans string, n_email int"
    rows = [(1, "a@b.c", None, 1), (1, "a@b.c", None, 1), (None, "x" * 300_000 + " 10.0.0.1", "s", 2), (2, None, None, None), (3, "", None, None)]
    got = sorted(((r.doc_id or 0, r.n_email, r.n_ip, r.spans) for r in personal.find_personal_data(frame(rows, ddl)).collect()))
    assert got == [(0, 0, 1, "ip:300001:300009"), (1, 1, 0, "email:0:5"), (1, 1, 0, "email:0:5"), (2, 0, 0, ""), (3, 0, 0, "")]
    assert personal.find_personal_data(frame([], ddl)).collect() == []


def test_redaction(spark, frame):
    rows = [(1, "write to \U0001f600 a.b@c.org or +49 30 1234567", "x"), (2, None, "y")]
    got = personal.redact(frame(rows, "id int, text string, more string")).orderBy("id").collect()
    assert [tuple(r) for r in got] == [(1, "write to \U0001f600 [email] or [phone]", "x"), (2, None, "y")]
