"""Every text that a license rule matches is one on which the rule is tried."""

import re
from collections import defaultdict
from itertools import product

from hustings.llm import licenses


def samples(parsed):
    """Texts that a parsed pattern matches, every alternative and option among them."""
    choices = []
    for kind, value in parsed:
        kind = str(kind)
        if kind == "LITERAL":
            choices.append([chr(value)])
        elif kind == "IN":
            first, of = value[0]
            choices.append([chr(of) if str(first) == "LITERAL" else "1" for first, of in value])
        elif kind == "SUBPATTERN":
            choices.append(list(samples(value[3])))
        elif kind == "BRANCH":
            choices.append([s for part in value[1] for s in samples(part)])
        elif kind == "MAX_REPEAT":
            least, most, part = value
            assert most == 1
            choices.append([*samples(part), *([""] if not least else [])])
        else:
            raise AssertionError(kind)
    return map("".join, product(*choices))


def test_gates_admit_every_match():
    gates = defaultdict(list)
    for rule in licenses.rules():
        gates[rule["pattern"]].append(rule)
    for pattern, rules in gates.items():
        for text in samples(re._parser.parse(pattern)):
            words = set(text.split())
            assert any(r["keyword"] in words and (not r["more"] or words & set(r["more"])) for r in rules), (pattern, text)


def test_names_without_gnu(frame):
    rows = [
        (1, "Licensed under the General Public License version 3"),
        (2, "Lesser General Public License, version 2.1"),
        (3, "released under CC0 1.0"),
    ]
    got = {r.doc_id: r.labels.split(",") for r in licenses.license_notices(frame(rows, "doc_id int, text string")).collect()}
    assert got[1] == ["gnu-gpl-3", "gpl"] and "gnu-lgpl-2.1" in got[2] and got[3] == ["cc0-1.0"]
