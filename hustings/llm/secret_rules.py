"""Rules for secrets and the Boolean trigram queries that follow from their regular expressions."""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import product

try:  # the standard library's own parser of regular expressions
    from re import _constants as code
    from re import _parser as parser
except ImportError:  # before 3.11
    import sre_constants as code
    import sre_parse as parser

EVERY = ("every",)
MOST_STRINGS = 16


@dataclass(frozen=True)
class Rule:
    """``least`` is the least length of group ``group``; shorter finds are dropped after matching."""

    kind: str
    pattern: str
    flags: int = re.ASCII
    group: int = 0
    least: int = 0


# The three base kinds.
BASE = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        re.ASCII | re.IGNORECASE,
        2,
        6,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", re.ASCII, 0, 20),
    Rule("hex", r"[0-9a-f]+", re.ASCII, 0, 24),
)
MORE = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("github-fine", r"github_pat_[A-Za-z0-9_]{40,}"),
    Rule("gitlab", r"glpat-[A-Za-z0-9_-]{20,}"),
    Rule("slack", r"xox[abprs]-[0-9A-Za-z-]{10,}"),
    Rule("slack-hook", r"hooks\.slack\.com/services/[A-Za-z0-9/]{20,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("google-oauth", r"[0-9]+-[0-9a-z]{32}\.apps\.googleusercontent\.com"),
    Rule("stripe", r"(?:sk|rk|pk)_(?:live|test)_[0-9A-Za-z]{16,}"),
    Rule("sendgrid", r"SG\.[A-Za-z0-9_-]{16,}\.[A-Za-z0-9_-]{16,}"),
    Rule("mailgun", r"key-[0-9a-z]{32}"),
    Rule("npm", r"npm_[A-Za-z0-9]{36}"),
    Rule("pypi", r"pypi-[A-Za-z0-9_-]{40,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("private-key", r"-----BEGIN (?:RSA |EC |DSA |OPENSSH |ENCRYPTED |PGP )?PRIVATE KEY(?: BLOCK)?-----"),
    Rule("url-password", r"[A-Za-z][A-Za-z0-9+.-]{1,20}://[^\s/:@]{1,80}:[^\s/:@]{1,80}@"),
    Rule("bearer", r"bearer\x20+[A-Za-z0-9._~+/-]{16,}=*", re.ASCII | re.IGNORECASE),
    Rule("aws-session", r"ASIA[A-Z0-9]{16}"),
    Rule("azure", r"AccountKey=[A-Za-z0-9+/]{40,}={0,2}"),
    Rule("telegram", r"[0-9]{8,10}:AA[A-Za-z0-9_-]{32,}"),
    Rule("shopify", r"shp(?:at|ca|pa|ss)_[0-9a-fA-F]{32}"),
    Rule("digitalocean", r"do[opr]_v1_[0-9a-f]{32,}"),
    Rule("age-key", r"AGE-SECRET-KEY-1[0-9A-Z]{40,}"),
    Rule("hf", r"hf_[A-Za-z0-9]{30,}"),
)
RULES = BASE + MORE


def both(parts: list) -> tuple:
    parts = [p for p in parts if p != EVERY]
    return EVERY if not parts else parts[0] if len(parts) == 1 else ("and", *parts)


def either(parts: list) -> tuple:
    return EVERY if EVERY in parts or not parts else parts[0] if len(parts) == 1 else ("or", *parts)


def of_string(string: str) -> tuple:
    """All trigrams of a string that must occur, over bytes with A-Z in lower case."""
    data = string.encode().lower()
    return both([("has", data[i : i + 3]) for i in range(len(data) - 2)])


def characters(members: list) -> list[str] | None:
    """The characters of a small set, else None."""
    found = []
    for op, value in members:
        if op is code.LITERAL:
            found.append(chr(value))
        elif op is code.RANGE and value[1] - value[0] < MOST_STRINGS:
            found += map(chr, range(value[0], value[1] + 1))
        else:
            return None
    return found if len(found) <= MOST_STRINGS else None


def of_sequence(items) -> tuple:
    """What must occur in any match of a parsed sequence.

    Neighbouring literals and small sets form strings; anything else ends them and adds what it demands itself.
    """
    demands, strings = [], [""]

    def end():
        nonlocal strings
        demands.append(either([of_string(s) for s in strings]))
        strings = [""]

    for op, value in items:
        if op is code.LITERAL:
            strings = [s + chr(value) for s in strings]
        elif op is code.IN and (among := characters(value)) and len(strings) * len(among) <= MOST_STRINGS:
            strings = [s + c for s, c in product(strings, among)]
        else:
            end()
            if op is code.SUBPATTERN:
                demands.append(of_sequence(value[-1]))
            elif op is code.BRANCH:
                demands.append(either([of_sequence(branch) for branch in value[1]]))
            elif op in (code.MAX_REPEAT, code.MIN_REPEAT) and value[0] > 0:
                demands.append(of_sequence(value[2]))
    end()
    return both(demands)


def trigram_query(rule: Rule) -> tuple:
    """``("and", …)``, ``("or", …)``, ``("has", trigram)`` or ``("every",)`` for a rule without mandatory trigrams.

    The index is built over bytes with A-Z in lower case, so one query serves rules with and without case.
    """
    return of_sequence(parser.parse(rule.pattern, rule.flags))


def trigrams(query: tuple) -> set[bytes]:
    if query[0] == "has":
        return {query[1]}
    return set().union(*map(trigrams, query[1:])) if query[0] in ("and", "or") else set()
