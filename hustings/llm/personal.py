"""Find personal data by anchors.

One Aho-Corasick automaton walks each text once and reports at-signs, plus signs, digits, scheme marks, double colons and the
cue words of identifiers.  At each anchor a small parser for its kind looks left and right, settles where the find begins and
ends, and validates it.  Every parser is linear: it never reads again what an earlier anchor of its kind has covered.
"""

from __future__ import annotations

import hashlib
import ipaddress
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from hustings.llm.tables import own_columns

# The base kinds in the order in which finds at one place are listed, then those the method adds.
BASE = ("email", "ip", "card", "phone")
MORE = ("login", "ipv6", "tel", "iban", "account", "ssn", "passport")
KINDS = BASE + MORE

# Words that announce an identifier.
CUES = {
    "iban": ("iban",),
    "account": ("account", "acct", "konto", "compte", "cuenta"),
    "ssn": ("ssn", "social security"),
    "passport": ("passport", "reisepass", "passeport", "pasaporte"),
}

LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9.]+")
NUMBER = re.compile(r"[0-9]+(?:[\x20-][0-9]+)*")
DIALLED = re.compile(r"[\x20().0-9-]*")
AUTHORITY = re.compile(r"[^\s/?#\"'<>\\]+")
SCHEME = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+.-"
HEX_COLONS = "0123456789abcdefABCDEF:"
COLONS = re.compile(r"[0-9A-Fa-f:]+")
# Between a cue and its identifier: a few words that say "number", and marks.
GAP = r"(?:[\x20]?(?:no|nr|num|number|nummer|security|insurance|de))*[\x20.:#=]{0,4}"
AFTER = {
    "iban": re.compile(GAP + r"([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30})(?![A-Za-z0-9])", re.I | re.A),
    "account": re.compile(GAP + r"([0-9](?:[\x20-]?[0-9]){5,16})(?![0-9])", re.I | re.A),
    "ssn": re.compile(GAP + r"([0-9]{3}-[0-9]{2}-[0-9]{4})(?![0-9])", re.I | re.A),
    "passport": re.compile(GAP + r"((?=[A-Z]{0,3}[0-9])[A-Z0-9]{6,9})(?![A-Za-z0-9])", re.I | re.A),
}


def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for mark, kind in (("@", "email"), ("+", "phone"), ("://", "login"), ("::", "ipv6"), ("tel:", "tel"), *((d, "number") for d in "0123456789")):
        found.add_word(mark, (kind, len(mark)))
    for kind, words in CUES.items():
        for word in words:
            for form in {word, word.upper(), word.capitalize(), word.title()}:
                found.add_word(form, (kind, len(form)))
    found.make_automaton()
    return found


def run_before(text: str, least: int, end: int, letters: str) -> int:
    """Where the run of ``letters`` that ends at ``end`` begins, not before ``least``; read in growing windows."""
    start, window = end, 64
    while start > least:
        piece = text[max(least, start - window) : start]
        left = len(piece) - len(piece.rstrip(letters))
        start -= left
        if left < len(piece):
            break
        window *= 2
    return start


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def dotted_quads(region: str, at: int) -> Iterator[tuple[int, int]]:
    """Every four neighbouring parts of a run of digits and dots, from the left, with parts of at most 255."""
    chain: list[tuple[int, str]] = []
    for part in region.split("."):
        chain = [*chain, (at, part)] if part else []
        at += len(part) + 1
        if len(chain) == 4:
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for _, p in chain):
                yield chain[0][0], chain[3][0] + len(chain[3][1])
            chain = []


def valid_iban(written: str) -> bool:
    plain = written.replace(" ", "").upper()
    return 15 <= len(plain) <= 34 and int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def shortened_iban(written: str) -> str | None:
    """The longest beginning of whole groups that is a valid IBAN: words may follow the number after a blank."""
    while len(written) >= 15:
        if valid_iban(written):
            return written
        written = written.rpartition(" ")[0]
    return None


def valid_ssn(written: str) -> bool:
    area, group, serial = written.split("-")
    return area not in ("000", "666") and area < "900" and group != "00" and serial != "0000"


def find(text: str, anchors: ahocorasick.Automaton) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of all finds, in order; finds of one kind never overlap, finds of different kinds may."""
    found: list[tuple[int, int, int]] = []
    done = dict.fromkeys((*KINDS, "at"), 0)

    def keep(kind: str, start: int, end: int) -> None:
        found.append((start, KINDS.index(kind), end))
        done[kind] = end

    for last, (kind, length) in anchors.iter(text):
        at, after = last + 1 - length, last + 1
        if kind == "number":
            if at >= done["ip"]:
                region = DOTTED.match(text, at)[0]
                for start, end in dotted_quads(region, at):
                    found.append((start, 1, end))
                done["ip"] = at + len(region)
            if at >= done["card"]:
                end = NUMBER.match(text, at).end()
                # 19 digits have at most 18 marks between them.
                digits = text[at:end].replace(" ", "").replace("-", "") if end - at <= 37 else ""
                if 12 <= len(digits) <= 19 and luhn(digits):
                    found.append((at, 2, end))
                done["card"] = end
        elif kind == "email":
            start = run_before(text, max(done["email"], done["at"]), at, LOCAL)
            done["at"] = after
            domain = DOMAIN.match(text, after)
            if start < at and domain:
                keep("email", start, domain.end())
        elif kind == "phone":
            if text[after : after + 1] in tuple("0123456789"):
                body = DIALLED.match(text, after + 1)[0].rstrip(" ().-")
                digits = 1 + sum(map(body.count, "0123456789"))
                if len(body) >= 2 and 9 <= digits <= 15:
                    keep("phone", at, after + 1 + len(body))
        elif kind == "login":
            start = run_before(text, done["login"], at, SCHEME)
            named = AUTHORITY.match(text, after) if start < at else None
            user, sign, host = named[0].rpartition("@") if named else ("", "", "")
            if named and user.strip(":") and sign and host.strip(":."):
                keep("login", start, named.end())
        elif kind == "ipv6":
            if at >= done["ipv6"]:
                start = run_before(text, done["ipv6"], at, HEX_COLONS)
                end = COLONS.match(text, start).end()
                done["ipv6"] = end
                alone = not (text[start - 1 : start].isalnum() if start else False) and not text[end : end + 1].isalnum()
                written = text[start:end]
                if alone and end - start <= 39 and len([p for p in written.split(":") if p]) >= 3:
                    try:
                        ipaddress.IPv6Address(written)
                    except ValueError:
                        continue
                    found.append((start, KINDS.index("ipv6"), end))
        elif kind == "tel":
            body = DIALLED.match(text, after)[0].rstrip(" ().-")
            if 7 <= sum(map(body.count, "0123456789")) <= 15:
                keep("tel", after + len(body) - len(body.lstrip(" .-")), after + len(body))
        elif at >= done[kind] and not (at and text[at - 1].isalnum()):
            match = AFTER[kind].match(text, after)
            if match and not text[after : after + 1].isalnum() | (match.start(1) == after):
                value = shortened_iban(match[1]) if kind == "iban" else match[1]
                if value and (kind != "ssn" or valid_ssn(value)):
                    keep(kind, match.start(1), match.start(1) + len(value))
    return sorted(found)


def written(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in found)


def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    anchors = automaton()
    for batch in batches:
        base, full, counts = [], [], [[] for _ in BASE]
        for text in batch.column(1):
            found = find(text.as_py() or "", anchors)
            own = [f for f in found if f[1] < len(BASE)]
            base.append(hashlib.sha256(written(own).encode()).hexdigest())
            full.append(written(found))
            for k, count in enumerate(counts):
                count.append(sum(f[1] == k for f in own))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *[pa.array(c, pa.int64()) for c in counts], pa.array(base, pa.string()), pa.array(full, pa.string())],
            names=["doc_id", *[f"n_{kind}" for kind in BASE], "base_sha256", "spans"],
        )


def find_personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans``.

    ``spans`` lists ``kind:start:end`` in code points, end exclusive, by start and then by ``KINDS``.  Null and empty texts hold
    nothing: counts 0, ``spans`` empty, ``base_sha256`` that of the empty string.  Repeated rows give repeated results, a null
    id stays null, an empty table gives none, further columns are not looked at.  Texts of any length are read whole.
    """
    rows = own_columns(docs, doc_id=doc_id, text=text)
    kind = rows.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"n_{k} bigint" for k in BASE)
    return rows.mapInArrow(scan, f"doc_id {kind}, {counts}, base_sha256 string, spans string")


def masked(text: str, found: list[tuple[int, int, int]]) -> str:
    """``text`` with every find replaced by its kind in brackets; finds that overlap become one, named after the first."""
    parts, end = [], 0
    for a, k, b in found:
        if a >= end:
            parts += [text[end:a], f"[{KINDS[k]}]"]
        end = max(end, b)
    return "".join([*parts, text[end:]])


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the personal data of ``text`` masked; null stays null, all other columns and every row stay."""
    place = docs.columns.index(text)

    def mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = automaton()
        for batch in batches:
            values = [t.as_py() for t in batch.column(place)]
            values = [None if t is None else masked(t, find(t, anchors)) for t in values]
            yield batch.set_column(place, batch.schema.field(place), pa.array(values, batch.schema.field(place).type))

    return docs.mapInArrow(mask, docs.schema)
