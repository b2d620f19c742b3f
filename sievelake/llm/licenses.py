"""License scan with ordered signature rules, in DataFrame functions only.

A text is put in canonical form: its words (runs of digits, a-z and characters beyond ASCII, after A-Z in lower case),
each between two blanks of its own. A rule is a regex over that form with a label, a tier (0 is the
strongest) and a keyword; it is tried only where its keyword occurs, and texts in which no root of a
keyword occurs are not even put in canonical form. Rules are written as phrases: `a|b` is either word, a final
`?` makes a word optional. Families times names times forms give some hundreds of rules, in order.

Detections overlap. Sorted by start, longest first, then tier, then order of rule, a detection is
suppressed if its interval lies within that of one before it of its own or a stronger tier. A running
maximum of ends per tier tells that in one pass over a document's detections. All happens within the row: no shuffle.

Defined cases: a null text is empty and has no words; texts without detection have empty labels, null places
and score 0; any number of equal rows give equal results; extra columns are not looked at.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievelake.llm.text import ascii_lower

#: Phrases whose every place counts as a base hit, and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Words after A-Z are in lower case, and before.
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
RAW_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
TIERS = 4
SCORES = (1.0, 0.9, 0.6, 0.3)

L = "license|licence"
#: label: (versions as words, names). A name's first word in capitals is its keyword, else its last word.
FAMILIES: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = {
    "gpl": (("1", "1 0", "2", "2 0", "3", "3 0"), (f"gnu general public {L}", "gnu GPL", "GPL")),
    "lgpl": (("2", "2 0", "2 1", "3", "3 0"), (f"gnu lesser|library general public {L}", "gnu LGPL", "LGPL")),
    "agpl": (("1", "1 0", "3", "3 0"), (f"gnu affero general public {L}", "gnu AGPL", "AGPL")),
    "gfdl": (("1 1", "1 2", "1 3"), (f"gnu free documentation {L}", "GFDL")),
    "apache": (("1 0", "1 1", "2", "2 0"), (f"apache {L}", f"apache software {L}")),
    "mit": ((), (f"mit {L}", f"expat {L}", f"x11 {L}", f"mit style {L}")),
    "bsd": (("2 clause", "3 clause", "4 clause"), (f"bsd {L}", f"modified bsd {L}", f"new bsd {L}", f"simplified bsd {L}")),
    "0bsd": ((), (f"0bsd {L}", f"zero clause bsd {L}")),
    "mpl": (("1 0", "1 1", "2 0"), (f"mozilla public {L}", "MPL")),
    "epl": (("1 0", "2 0"), (f"eclipse public {L}", "EPL")),
    "edl": (("1 0",), (f"eclipse distribution {L}",)),
    "cddl": (("1 0", "1 1"), (f"common development and distribution {L}", "CDDL")),
    "cpl": (("0 5", "1 0"), (f"common public {L}",)),
    "ipl": (("1 0",), (f"ibm public {L}",)),
    "isc": ((), (f"isc {L}",)),
    "zlib": ((), (f"zlib {L}", f"zlib libpng {L}")),
    "libpng": (("2 0",), (f"libpng {L}",)),
    "artistic": (("1 0", "2 0"), (f"artistic {L}", f"perl artistic {L}")),
    "bsl": (("1 0",), (f"boost software {L}",)),
    "busl": (("1 1",), (f"business source {L}",)),
    "sspl": (("1 0",), (f"server side public {L}", "SSPL")),
    "eupl": (("1 0", "1 1", "1 2"), (f"european union public {L}", "EUPL")),
    "cecill": (("1 0", "2 0", "2 1"), (f"cecill free software {L}", f"cecill {L}")),
    "psf": (("2", "2 0"), (f"python software foundation {L}", f"psf {L}")),
    "php": (("3 0", "3 01"), (f"php {L}",)),
    "ruby": ((), (f"ruby {L}",)),
    "openssl": ((), (f"openssl {L}",)),
    "postgresql": ((), (f"postgresql {L}",)),
    "w3c": ((), (f"w3c {L}", f"w3c software {L}")),
    "zpl": (("1 1", "2 0", "2 1"), (f"zope public {L}",)),
    "lppl": (("1 0", "1 2", "1 3", "1 3c"), (f"latex project public {L}", "LPPL")),
    "ncsa": ((), (f"university of illinois ncsa open source {L}", f"ncsa {L}")),
    "ofl": (("1 0", "1 1"), (f"sil open font {L}", f"open font {L}")),
    "osl": (("1 0", "2 0", "2 1", "3 0"), (f"open software {L}",)),
    "afl": (("1 1", "2 0", "2 1", "3 0"), (f"academic free {L}",)),
    "ecl": (("1 0", "2 0"), (f"educational community {L}",)),
    "upl": (("1 0",), (f"universal permissive {L}",)),
    "ms-pl": ((), (f"microsoft public {L}",)),
    "ms-rl": ((), (f"microsoft reciprocal {L}",)),
    "odbl": (("1 0",), (f"open database {L}", "ODBL")),
    "odc-by": (("1 0",), (f"open data commons attribution {L}",)),
    "pddl": (("1 0",), (f"public domain dedication and {L}", "PDDL")),
    "blueoak": (("1 0 0",), (f"blue oak model {L}",)),
    "mulan": (("1", "2"), (f"mulan permissive software {L}", f"mulan psl {L}")),
    "wtfpl": (("1", "2"), (f"do what the fuck you want to public {L}", "WTFPL")),
    "unlicense": ((), ("the UNLICENSE", "UNLICENSE")),
    "cc0": (("1 0",), ("CC0", f"creative COMMONS zero {L}?")),
    "cc-by-nc-nd": (("2 0", "2 5", "3 0", "4 0"), ("CC by nc nd", "creative COMMONS attribution noncommercial noderivatives")),
    "cc-by-nc-sa": (("2 0", "2 5", "3 0", "4 0"), ("CC by nc sa", "creative COMMONS attribution noncommercial sharealike")),
    "cc-by-nc": (("2 0", "2 5", "3 0", "4 0"), ("CC by nc", "creative COMMONS attribution noncommercial")),
    "cc-by-nd": (("2 0", "2 5", "3 0", "4 0"), ("CC by nd", "creative COMMONS attribution noderivatives")),
    "cc-by-sa": (("1 0", "2 0", "2 5", "3 0", "4 0"), ("CC by sa", "creative COMMONS attribution sharealike")),
    "cc-by": (("1 0", "2 0", "2 5", "3 0", "4 0"), ("CC by", "creative COMMONS attribution")),
}
#: Rules of a single phrase: (label, tier, phrase).
SINGLE: tuple[tuple[str, int, str], ...] = (
    ("gpl", 2, f"general public {L}"),
    ("creative-commons", 2, "creative COMMONS"),
    ("public-domain", 1, "released|dedicated|placed into|in|to the? public DOMAIN"),
    ("public-domain", 2, "public DOMAIN"),
    ("proprietary", 1, "all rights RESERVED"),
    ("mit", 0, "permission is HEREBY granted free of charge to any person obtaining a copy"),
    ("bsd", 0, "REDISTRIBUTION and use in source and binary forms with or without modification"),
    ("license-reference", 3, "LICENSED|licenced under the? terms? of? the?"),
    ("license-reference", 3, f"see the? LICENSE|licence file"),
    ("license-reference", 3, "LICENSE|licence agreement"),
    ("commercial", 2, f"commercial {L}"),
    ("open-source", 3, f"open source {L}"),
)
# Identifiers of the SPDX list, as they stand after "SPDX-License-Identifier:", and their labels here.
SPDX = {
    "0BSD": "0bsd", "AFL-3.0": "afl-3.0", "AGPL-3.0-only": "agpl-3.0", "AGPL-3.0-or-later": "agpl-3.0", "AGPL-3.0": "agpl-3.0",
    "Apache-1.1": "apache-1.1", "Apache-2.0": "apache-2.0", "Artistic-2.0": "artistic-2.0", "BlueOak-1.0.0": "blueoak-1.0.0",
    "BSD-2-Clause": "bsd-2.clause", "BSD-3-Clause": "bsd-3.clause", "BSD-4-Clause": "bsd-4.clause", "BSL-1.0": "bsl-1.0",
    "BUSL-1.1": "busl-1.1", "CC0-1.0": "cc0-1.0", "CC-BY-4.0": "cc-by-4.0", "CC-BY-SA-4.0": "cc-by-sa-4.0", "CC-BY-NC-4.0": "cc-by-nc-4.0",
    "CC-BY-ND-4.0": "cc-by-nd-4.0", "CC-BY-NC-SA-4.0": "cc-by-nc-sa-4.0", "CC-BY-NC-ND-4.0": "cc-by-nc-nd-4.0", "CDDL-1.0": "cddl-1.0",
    "CECILL-2.1": "cecill-2.1", "ECL-2.0": "ecl-2.0", "EPL-1.0": "epl-1.0", "EPL-2.0": "epl-2.0", "EUPL-1.2": "eupl-1.2",
    "GFDL-1.3-only": "gfdl-1.3", "GFDL-1.3-or-later": "gfdl-1.3", "GPL-1.0-only": "gpl-1.0", "GPL-1.0-or-later": "gpl-1.0",
    "GPL-2.0": "gpl-2.0", "GPL-2.0+": "gpl-2.0", "GPL-2.0-only": "gpl-2.0", "GPL-2.0-or-later": "gpl-2.0",
    "GPL-3.0": "gpl-3.0", "GPL-3.0-only": "gpl-3.0", "GPL-3.0-or-later": "gpl-3.0", "ISC": "isc",
    "LGPL-2.0-only": "lgpl-2.0", "LGPL-2.0-or-later": "lgpl-2.0", "LGPL-2.1": "lgpl-2.1", "LGPL-2.1-only": "lgpl-2.1", "LGPL-2.1-or-later": "lgpl-2.1",
    "LGPL-3.0-only": "lgpl-3.0", "LGPL-3.0-or-later": "lgpl-3.0", "LPPL-1.3c": "lppl-1.3c", "MIT": "mit", "MIT-0": "mit", "MPL-1.1": "mpl-1.1",
    "MPL-2.0": "mpl-2.0", "MS-PL": "ms-pl", "MS-RL": "ms-rl", "MulanPSL-2.0": "mulan-2", "NCSA": "ncsa", "ODbL-1.0": "odbl-1.0",
    "OFL-1.1": "ofl-1.1", "OpenSSL": "openssl", "OSL-3.0": "osl-3.0", "PHP-3.01": "php-3.01", "PostgreSQL": "postgresql",
    "PSF-2.0": "psf-2.0", "Python-2.0": "psf-2.0", "Ruby": "ruby", "SSPL-1.0": "sspl-1.0", "Unlicense": "unlicense", "UPL-1.0": "upl-1.0",
    "W3C": "w3c", "WTFPL": "wtfpl", "Zlib": "zlib", "ZPL-2.1": "zpl-2.1",
}
# Sentences of licenses and of the notices that refer to them, with their labels. The word in capitals is the keyword.
NOTICES: tuple[tuple[str, str], ...] = (
    ("gpl-1", "general public license as published by the free software FOUNDATION either version 1"),
    ("gpl-2", "general public license as published by the free software FOUNDATION either version 2 of the license"),
    ("gpl-2", "general public license as published by the free software FOUNDATION version 2"),
    ("gpl-2", "general public license version 2 as published by the free software FOUNDATION"),
    ("gpl-3", "gnu general public license as published by the free software FOUNDATION either version 3 of the license"),
    ("gpl-3", "general public license version 3 as published by the free software FOUNDATION"),
    ("gpl", "the licenses for most software are designed to take away your FREEDOM to share and change it"),
    ("gpl-3", "the gnu general public license is a free COPYLEFT license for software and other kinds of works"),
    ("lgpl-2", "library general public license as published by the free software FOUNDATION either version 2 of the license"),
    ("lgpl-2.1", "lesser general public license as published by the free software FOUNDATION either version 2 1 of the license"),
    ("lgpl-3", "lesser general public license as published by the free software FOUNDATION either version 3 of the license"),
    ("lgpl-3", "this version of the gnu LESSER general public license incorporates the terms and conditions of version 3"),
    ("agpl-3", "affero general public license as published by the free software FOUNDATION either version 3 of the license"),
    ("agpl-3", "the gnu AFFERO general public license is a free copyleft license for software and other kinds of works"),
    ("apache-2.0", "you may not use this file except in COMPLIANCE with the license you may obtain a copy of the license at http|https www apache org licenses license 2 0"),
    ("apache-2.0", "each contributor hereby grants to you a PERPETUAL worldwide non exclusive no charge royalty free irrevocable copyright license"),
    ("apache-1.1", "this product includes software developed by the APACHE software foundation"),
    ("bsd-3.clause", "neither the name of the? copyright? holder|owner nor the names of its contributors may be used to ENDORSE or promote products derived from this software"),
    ("bsd-4.clause", "all advertising materials mentioning features or use of this software must display the following ACKNOWLEDGEMENT"),
    ("isc", "permission to use copy modify and or? distribute this software for any purpose with or without fee is HEREBY granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("0bsd", "permission to use copy modify and or distribute this software for any purpose with or without fee is HEREBY granted"),
    ("zlib", "in no event will the authors be held LIABLE for any damages arising from the use of this software"),
    ("zlib", "the origin of this software must not be MISREPRESENTED you must not claim that you wrote the original software"),
    ("bsl-1.0", "permission is HEREBY granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"),
    ("ncsa", "permission is HEREBY granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal with the software without restriction"),
    ("unlicense", "this is free and UNENCUMBERED software released into the public domain"),
    ("wtfpl", "everyone is permitted to copy and distribute VERBATIM or modified copies of this license document"),
    ("cc0-1.0", "to the extent possible under law has WAIVED all copyright and related or neighboring rights"),
    ("cc0-1.0", "the person who associated a work with this deed has DEDICATED the work to the public domain"),
    ("mpl-2.0", "this source code form is subject to the terms of the MOZILLA public license v 2 0"),
    ("mpl-1.1", "the contents of this file are subject to the MOZILLA public license version 1 1"),
    ("epl-2.0", "the accompanying program is provided under the terms of this ECLIPSE public license"),
    ("epl-1.0", "this program and the accompanying materials are made available under the terms of the ECLIPSE public license v1 0"),
    ("epl-2.0", "made available under the terms of the ECLIPSE public license 2 0"),
    ("postgresql", "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written AGREEMENT is hereby granted"),
    ("psf", "psf is making PYTHON available to licensee on an as is basis"),
    ("artistic", "you may make and give away VERBATIM copies of the source form of the standard version"),
    ("ofl-1.1", "this font software is licensed under the SIL open font license version 1 1"),
    ("ofl-1.1", "the fonts including any derivative works can be BUNDLED embedded redistributed and or sold"),
    ("ms-pl", "this license governs use of the ACCOMPANYING software if you use the software you accept this license"),
    ("upl-1.0", "to any person obtaining a copy of this software associated documentation and or data collectively the software free of charge and under any and all copyright rights in the software and any and all PATENT rights"),
    ("sspl-1.0", "server side public license as published by MONGODB inc"),
    ("busl-1.1", "the licensor hereby grants you the right to copy modify create derivative works redistribute and make non PRODUCTION use of the licensed work"),
    ("eupl", "licensed under the EUPL version|v 1 2"),
    ("cc-by-4.0", "this work is licensed under a creative COMMONS attribution 4 0 international license"),
    ("cc-by-sa-4.0", "this work is licensed under a creative COMMONS attribution sharealike 4 0 international license"),
    ("cc-by-nc-4.0", "this work is licensed under a creative COMMONS attribution noncommercial 4 0 international license"),
)
#: Strings of which a text holds one, in any case, if any rule's keyword occurs in it.
ROOTS = ("licen", "gpl", "cc", "gfdl", "mpl", "epl", "cddl", "lppl", "sspl", "eupl", "odbl", "pddl", "wtfpl", "commons", "domain", "reserved", "hereby", "redistribution",
         "acknowledgement", "endorse", "liable", "misrepresented", "unencumbered", "waived", "bundled", "verbatim", "apache")


class Rule(NamedTuple):
    no: int
    label: str
    tier: int
    keyword: str
    pattern: str


def pattern_of(phrase: str) -> str:
    out = []
    for word in phrase.lower().split():
        optional, word = word.endswith("?"), word.rstrip("?")
        either = f" (?:{word}) " if "|" in word else f" {word} "
        out.append(f"(?:{either})?" if optional else either)
    return "".join(out)


def _keywords(phrase: str) -> list[str]:
    """The words of which one must occur: the word in capitals, or the last one."""
    words = phrase.split()  # of which one may stand in capitals
    marked = next((w for w in words if w.isupper() or w.split("|")[0].isupper() and w.split("|")[0].isalpha()), words[-1])
    return marked.rstrip("?").lower().split("|")


def _rules() -> list[Rule]:
    phrases: list[tuple[str, int, str, str]] = []
    for label, (versions, names) in FAMILIES.items():
        for name in names:
            for version in versions:
                named = f"{label}-{version.replace(' ', '.')}"
                phrases.append((named, 0, name, f"{name} version|v? {version} or? any? later?"))
                if " " not in version:
                    phrases.append((f"{label}-{version}", 0, name, f"{name} v{version} or? any? later?"))
            phrases.append((label, 1, name, f"under the? terms? of? the? {name}"))
            phrases.append((label, 1, name, name))
    for label, tier, phrase in SINGLE:
        phrases.append((label, tier, phrase, phrase))
    for name, label in SPDX.items():
        phrase = "SPDX license identifier " + " ".join(name.lower().replace("-", " ").replace(".", " ").replace("+", " ").split())
        phrases.append((label, 0, phrase, phrase))
    for label, phrase in NOTICES:
        phrases.append((label, 0, phrase, phrase))
    return [
        Rule(no, label, tier, word, pattern_of(phrase))
        for no, (label, tier, name, phrase) in enumerate(phrases)
        for word in _keywords(name)
    ]


RULES = _rules()


def canonical(text: Column) -> Column:
    words = F.filter(F.split(F.regexp_replace(ascii_lower(text), NOT_WORD, " "), " "), lambda w: w != "")
    return F.concat(F.lit(" "), F.array_join(words, "  "), F.lit(" "))


def _count(piece: str) -> str:
    return f"((length({piece}) - length(replace({piece}, ' ', ''))) div 2)"


def _base(number: int, phrase: str) -> str:
    """Struct n, first, last, label of a base phrase in `canon`; places are null if n is 0."""
    pattern, size = pattern_of(phrase), len(phrase.split())
    pieces = f"split(canon, '{pattern}', -1)"
    return f"""transform(array({pieces}), p -> named_struct(
      'n', CAST(size(p) - 1 AS BIGINT),
      'first', CASE WHEN size(p) > 1 THEN CAST({_count('p[0]')} AS BIGINT) END,
      'last', CASE WHEN size(p) > 1 THEN CAST(n_words - {_count('element_at(p, -1)')} - {size} AS BIGINT) END,
      'label', CASE WHEN size(p) > 1 THEN '{list(BASE.values())[number]}' END))[0]"""


_INTERVALS = """flatten(transform(array(regexp_extract_all(canon, r.pattern, 0)), matches -> aggregate(
  zip_with(matches, slice(split(canon, r.pattern, -1), 1, size(matches)), (m, p) -> named_struct('m', m, 'p', p)),
  named_struct('at', 0, 'hits', CAST(array() AS array<struct<s: int, e: int>>)),
  (a, x) -> named_struct('at', a.at + length(x.p) + length(x.m),
    'hits', concat(a.hits, array(named_struct('s', a.at + length(x.p), 'e', a.at + length(x.p) + length(x.m))))),
  a -> a.hits)))"""
_HITS = f"""array_sort(flatten(transform(rules, r -> transform({_INTERVALS},
  h -> named_struct('s', h.s, 'back', -h.e, 'tier', r.tier, 'no', r.no, 'label', r.label)))))"""


def _resolved() -> str:
    ends = ", ".join(f"'m{t}', -1" for t in range(TIERS))
    before = "CASE h.tier " + " ".join(
        f"WHEN {t} THEN greatest({', '.join(f'a.m{u}' for u in range(t + 1))}, -1)" for t in range(TIERS)
    )
    hidden = f"{before} END >= -h.back"
    moved = ", ".join(f"'m{t}', CASE WHEN h.tier = {t} THEN greatest(a.m{t}, -h.back) ELSE a.m{t} END" for t in range(TIERS))
    return f"""aggregate(hits,
      named_struct({ends}, 'labels', CAST(array() AS array<string>), 'best', {TIERS}, 'n', 0L),
      (a, h) -> named_struct({moved},
        'labels', CASE WHEN {hidden} THEN a.labels ELSE array_union(a.labels, array(h.label)) END,
        'best', CASE WHEN {hidden} THEN a.best ELSE least(a.best, h.tier) END,
        'n', CASE WHEN {hidden} THEN a.n ELSE a.n + 1 END))"""


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of `docs`: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, n_detections, score."""
    some = F.coalesce(F.col(text), F.lit(""))
    lower = F.lower(some)
    hint = F.lit(False)
    for root in ROOTS:
        hint = hint | lower.contains(root)
    listed = F.array(
        *[F.struct(F.lit(r.no).alias("no"), F.lit(r.label).alias("label"), F.lit(r.tier).alias("tier"), F.lit(r.pattern).alias("pattern"), F.lit(r.keyword).alias("keyword")) for r in RULES]
    )
    words = F.array(*[F.lit(w) for w in sorted({r.keyword for r in RULES})])
    read = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.regexp_count(some, F.lit(RAW_WORD)).cast("long").alias("n_words"),
        F.when(hint, canonical(some)).otherwise("").alias("canon"),
    )
    gated = read.withColumn(
        "present", F.filter(words, lambda w: F.col("canon").contains(F.concat(F.lit(" "), w, F.lit(" "))))
    ).withColumn(
        "rules",
        F.when(F.size("present") > 0, F.filter(listed, lambda r: F.array_contains(F.col("present"), r["keyword"]))).otherwise(
            F.filter(listed, lambda r: F.lit(False))
        ),
    )
    found = gated.withColumn("hits", F.expr(_HITS)).withColumn(
        "base", F.when(F.col("canon") != "", F.array(*[F.expr(_base(i, p)) for i, p in enumerate(BASE)]))
    )
    done = found.withColumn("out", F.expr(_resolved()))
    base_labels = F.array_compact(F.coalesce(F.transform("base", lambda b: b["label"]), F.array().cast("array<string>")))
    n_base = F.aggregate(F.coalesce(F.transform("base", lambda b: b["n"]), F.array().cast("array<bigint>")), F.lit(0).cast("long"), lambda a, b: a + b)
    score = F.element_at(F.array(*[F.lit(s) for s in (*SCORES, 0.0)]), F.col("out.best") + 1)
    return done.select(
        "doc_id",
        "n_words",
        n_base.alias("n_base"),
        F.array_min(F.transform("base", lambda b: b["first"])).alias("first_word"),
        F.array_max(F.transform("base", lambda b: b["last"])).alias("last_word"),
        F.array_join(F.array_sort(base_labels), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base_labels, F.col("out.labels"))), ",").alias("labels"),
        F.col("out.n").alias("n_detections"),
        score.alias("score"),
    )
