"""License notices by ordered signature rules, with built-in functions only.

Rules are regular expressions over the words of a text in lower case, joined by single spaces.  A rule is tried only on
texts that hold its keywords; of overlapping finds a lower or equal rule inside the interval of another one is suppressed.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hustings.llm.license_wording import WORDING
from hustings.llm.tables import own_columns, text_of

SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# Phrase, label.
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
BASE_WEIGHT = 0.4

# Family, name as words (a regular expression), keyword, versions as words; a short name has a row of its own.
FAMILIES = (
    ("apache", "apache(?: software)?", "apache", ("1 0", "1 1", "2 0", "2")),
    ("mit", "mit", "mit", ()),
    ("x11", "x11", "x11", ()),
    ("expat", "expat", "expat", ()),
    ("isc", "isc", "isc", ()),
    ("zlib", "zlib(?: libpng)?", "zlib", ()),
    ("boost", "boost software", "boost", ("1 0",)),
    ("bsd", "(?:free )?bsd", "bsd", ("0 clause", "2 clause", "3 clause", "4 clause")),
    ("gnu-gpl", "(?:gnu )?general public", "public", ("1", "1 0", "2", "2 0", "3", "3 0")),
    ("gnu-gpl", "(?:gnu )?gpl", "gpl", ("1", "1 0", "2", "2 0", "3", "3 0")),
    ("gnu-lgpl", "(?:gnu )?(?:lesser|library) general public", "public", ("2", "2 0", "2 1", "3", "3 0")),
    ("gnu-lgpl", "(?:gnu )?lgpl", "lgpl", ("2", "2 0", "2 1", "3", "3 0")),
    ("gnu-agpl", "(?:gnu )?affero general public", "affero", ("1", "3", "3 0")),
    ("gnu-agpl", "(?:gnu )?agpl", "agpl", ("1", "3", "3 0")),
    ("gnu-fdl", "(?:gnu )?free documentation", "documentation", ("1 1", "1 2", "1 3")),
    ("gnu-fdl", "(?:gnu )?fdl", "fdl", ("1 1", "1 2", "1 3")),
    ("mpl", "mozilla public", "mozilla", ("1 0", "1 1", "2 0")),
    ("mpl", "mpl", "mpl", ("1 0", "1 1", "2 0")),
    ("epl", "eclipse public", "eclipse", ("1 0", "2 0")),
    ("epl", "epl", "epl", ("1 0", "2 0")),
    ("edl", "eclipse distribution", "eclipse", ("1 0",)),
    ("cddl", "common development and distribution", "distribution", ("1 0", "1 1")),
    ("cddl", "cddl", "cddl", ("1 0", "1 1")),
    ("cpl", "common public", "common", ("1 0",)),
    ("artistic", "(?:the )?artistic", "artistic", ("1 0", "2 0")),
    ("osl", "open software", "open", ("1 0", "2 0", "2 1", "3 0")),
    ("afl", "academic free", "academic", ("2 0", "2 1", "3 0")),
    ("ofl", "(?:sil )?open font", "font", ("1 0", "1 1")),
    ("eupl", "european union public", "european", ("1 0", "1 1", "1 2")),
    ("eupl", "eupl", "eupl", ("1 0", "1 1", "1 2")),
    ("ms-pl", "microsoft public", "microsoft", ()),
    ("ms-rl", "microsoft reciprocal", "microsoft", ()),
    ("python", "python software foundation", "python", ("2", "2 0")),
    ("ruby", "ruby", "ruby", ()),
    ("php", "php", "php", ("3 0", "3 01")),
    ("postgresql", "postgresql", "postgresql", ()),
    ("openssl", "openssl", "openssl", ()),
    ("unlicense", "(?:the )?unlicense", "unlicense", ()),
    ("wtfpl", "wtfpl", "wtfpl", ("2",)),
    ("ncsa", "university of illinois ncsa open source", "ncsa", ()),
    ("odbl", "open database", "database", ("1 0",)),
    ("pddl", "public domain dedication and", "dedication", ("1 0",)),
    ("bsl", "business source", "business", ("1 0", "1 1")),
    ("sspl", "server side public", "server", ("1",)),
    ("cecill", "cecill", "cecill", ("1 0", "2 0", "2 1")),
    ("cc0", "creative commons zero", "creative", ("1 0",)),
    ("cc0", "cc0", "cc0", ("1 0",)),
    ("cc-attribution", "creative commons attribution", "creative", ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("cc-sharealike", "creative commons attribution share ?alike", "creative", ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("cc-noncommercial", "creative commons attribution non ?commercial", "creative", ("2 0", "3 0", "4 0")),
    ("cc-noderivatives", "creative commons attribution no ?deriv(?:ative)?s", "creative", ("2 0", "3 0", "4 0")),
)

SPELLINGS = ("license", "licence")

# Level (higher wins), weight, words of which a text must hold one, pattern around the name; "{v}" stands for the version,
# forms without it need none.
FORMS = (
    (5, 0.99, ("spdx",), "spdx license identifier {n} {v}(?: or later| only)?"),
    (5, 0.95, ("spdx",), "spdx license identifier {n}(?: or later| only)?"),
    (4, 0.97, ("under",), "(?:licen[sc]ed|released|distributed|available|published) under (?:the )?(?:terms of )?(?:the )?{n}(?: licen[sc]e)?(?: version| v)? {v}"),
    (4, 0.90, ("under",), "(?:licen[sc]ed|released|distributed|available|published) under (?:the )?(?:terms of )?(?:the )?{n}(?: licen[sc]e)?"),
    (3, 0.90, SPELLINGS, "{n} licen[sc]e(?: version| v)? {v}"),
    (2, 0.70, (), "{n}(?: version| v)? {v}"),
    (1, 0.60, SPELLINGS, "{n} licen[sc]e"),
)

# Notices that name no license: label, keyword, level, weight, pattern.
NOTICES = (
    ("copyright-notice", "copyright", 3, 0.50, r"copyright (?:c )?(?:19|20)\d\d(?: (?:19|20)\d\d)?"),
    ("copyright-notice", "copyright", 1, 0.30, "copyright (?:c|by|holders?|owners?)"),
    ("no-warranty", "warranty", 3, 0.60, "without warranty of any kind"),
    ("no-warranty", "warranty", 3, 0.60, "without any warranty"),
    ("as-is", "provided", 3, 0.50, "(?:software )?is provided as is"),
    ("permission-notice", "permission", 4, 0.80, "permission is hereby granted free of charge"),
    ("permission-notice", "permission", 4, 0.80, "permission to use copy modify and or distribute"),
    ("redistribution", "redistribution", 4, 0.80, "redistribution and use in source and binary forms"),
    ("public-domain", "domain", 3, 0.70, "(?:released|placed|dedicated) (?:in|into|to) the public domain"),
    ("proprietary", "confidential", 3, 0.50, "proprietary and confidential"),
    ("see-license", "license", 1, 0.30, "see (?:the )?license(?: file)?"),
)


def rules() -> list[dict]:
    """All rules in order: names in their forms, notices, wording.  ``keyword`` and one of ``more``, if any, must occur in a text
    for its rule to be tried."""
    made = []
    for family, name, keyword, versions in FAMILIES:
        for level, weight, more, form in FORMS:
            for version in versions if "{v}" in form else ("",):
                label = "-".join([family, *([version.replace(" clause", "-clause").replace(" ", ".")] if version else [])])
                pattern = form.replace("{n}", name).replace("{v}", version)
                made.append({"label": label, "keyword": keyword, "more": more, "level": level, "weight": weight, "pattern": pattern})
    for label, keyword, level, weight, pattern in (*NOTICES, *WORDING):
        made.append({"label": label, "keyword": keyword, "more": (), "level": level, "weight": weight, "pattern": pattern})
    return [{"rule": i, **rule} for i, rule in enumerate(made)]


def spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def places(words: Column, pattern: Column) -> Column:
    """Start and end (words from 0, end exclusive) of all matches of ``pattern`` in single-spaced ``words``."""
    whole = F.concat(F.lit("(?<= )(?:"), pattern, F.lit(")(?= )"))
    between = F.transform(F.split(words, whole, F.lit(-1)), spaces)
    inside = F.transform(F.regexp_extract_all(words, whole, F.lit(0)), spaces)

    def step(state: Column, gap: Column) -> Column:
        start = state["at"] + gap["between"]
        found = F.struct(start.alias("start"), (start + gap["inside"] + 1).alias("end"))
        return F.struct(
            (start + gap["inside"]).alias("at"),
            F.when(gap["inside"].isNull(), state["out"]).otherwise(F.concat(state["out"], F.array(found))).alias("out"),
        )

    start = F.struct(F.lit(-1).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("out"))
    pairs = F.arrays_zip(between.alias("between"), inside.alias("inside"))
    return F.aggregate(pairs, start, step, lambda state: state["out"])


SPAN = "array<struct<start:int,down:int,fall:int,rule:int,end:int,level:int,label:string,weight:double>>"


def uncovered(spans: Column) -> Column:
    """Spans that no earlier one of at least their level contains, taken by start, longest and highest first."""
    levels = 1 + max(rule["level"] for rule in rules())
    ends = F.array(*[F.lit(-1)] * levels)

    def step(state: Column, span: Column) -> Column:
        covered = F.exists(F.slice(state["ends"], span["level"] + 1, levels), lambda end: end >= span["end"])
        here = F.transform(
            state["ends"], lambda end, i: F.when(i == span["level"], F.greatest(end, span["end"])).otherwise(end)
        )
        kept = F.when(covered, state["kept"]).otherwise(F.concat(state["kept"], F.array(span)))
        return F.struct(here.alias("ends"), kept.alias("kept"))

    start = F.struct(ends.alias("ends"), F.array().cast(SPAN).alias("kept"))
    return F.aggregate(F.array_sort(spans), start, step, lambda state: state["kept"])


def license_notices(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans``.

    A null or empty text has no words, no places, null ``first_word`` and ``last_word``, empty labels and score 0.
    Repeated rows give repeated results; a null id stays null; further columns are not looked at.  ``spans`` are the
    finds of the rules that survive suppression; ``score`` is the chance that at least one of them or of the base
    phrases is right, taking their weights as independent.
    """
    rows = own_columns(docs, doc_id=doc_id, text=text)
    plain = F.trim(F.regexp_replace(text_of("text"), SEPARATORS, " "))
    spaced = rows.select("doc_id", plain.alias("_plain"))
    table = rules()
    keywords = {k for rule in table for k in (rule["keyword"], *rule["more"])}
    # lower() goes beyond A-Z; that can only let more texts through.
    counted = spaced.select(
        "doc_id",
        "_plain",
        F.when(F.col("_plain") == "", 0).otherwise(spaces(F.col("_plain")) + 1).cast("bigint").alias("n_words"),
        F.array_intersect(F.split(F.lower("_plain"), " "), F.lit(sorted(keywords))).alias("_found"),
    )
    schema = "array<struct<rule:int,label:string,keyword:string,more:array<string>,level:int,weight:double,pattern:string>>"
    every = F.from_json(F.lit(json.dumps(table)), schema)

    def held(r: Column) -> Column:
        return F.array_contains("_found", r["keyword"]) & ((F.size(r["more"]) == 0) | F.arrays_overlap("_found", r["more"]))

    tried = F.when(F.size("_found") > 0, F.filter(every, held)).otherwise(F.array().cast(schema))
    phrase = "|".join(phrase for phrase, _ in BASE)
    gated = counted.select("doc_id", "n_words", "_plain", F.col("_plain").rlike(f"(?i){phrase}").alias("_phrase"), tried.alias("_rules"))
    known = F.col("_phrase") | (F.size("_rules") > 0)
    low = F.translate(F.concat(F.lit(" "), F.col("_plain"), F.lit(" ")), LETTERS, LETTERS.lower())
    found = gated.select("doc_id", "n_words", "_phrase", "_rules", F.when(known, low).alias("_words"))

    def spans(r: Column) -> Column:
        return F.transform(
            places(F.col("_words"), r["pattern"]),
            lambda p: F.struct(
                p["start"].alias("start"),
                (-p["end"]).alias("down"),
                (-r["level"]).alias("fall"),
                r["rule"].alias("rule"),
                p["end"].alias("end"),
                r["level"].alias("level"),
                r["label"].alias("label"),
                r["weight"].alias("weight"),
            ),
        )

    def labelled(phrase: str, label: str) -> Column:
        return F.transform(
            places(F.col("_words"), F.lit(phrase)), lambda p: F.struct(p["start"].alias("start"), F.lit(label).alias("label"))
        )

    base = F.concat(*[labelled(phrase, label) for phrase, label in BASE])
    seen = found.select(
        "doc_id",
        "n_words",
        F.when(F.col("_phrase"), base).otherwise(F.array().cast("array<struct<start:int,label:string>>")).alias("_base"),
        F.flatten(F.transform("_rules", spans)).alias("_all"),
    )
    left = seen.select("doc_id", "n_words", "_base", uncovered(F.col("_all")).alias("_kept"))
    base_labels = F.array_sort(F.array_distinct(F.col("_base.label")))
    unsure = F.aggregate("_kept", F.pow(F.lit(1 - BASE_WEIGHT), F.size(base_labels)), lambda p, s: p * (1 - s["weight"]))
    starts = F.col("_base.start").cast("array<bigint>")
    return left.select(
        "doc_id",
        "n_words",
        F.size("_base").cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join(base_labels, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base_labels, F.col("_kept.label"))), ",").alias("labels"),
        (F.lit(1.0) - unsure).alias("score"),
        F.transform("_kept", lambda s: F.struct(s["label"].alias("label"), s["start"].alias("start"), s["end"].alias("end"))).alias("spans"),
    )
