"""Mixing, license scan, quality rules, substring dedup and line dedup on small tables."""

import random
import re
from collections import Counter, defaultdict

import pytest
from llm_rows import edge_docs, empty_docs, prose, rows
from pyspark.sql import functions as F

from sievelake.llm import licenses, line_windows, mixing, quality_rules, substring


def found(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


# ---- mixing


def test_raking_meets_all_margins(spark):
    rng = random.Random(1)
    cells = [(s, l, p, rng.randint(1, 1000)) for s in "abcd" for l in ("en", "fr") for p in "xy"]
    table = spark.createDataFrame(cells, "source string, lang string, topic string, tokens long")
    targets = {"source": dict(zip("abcd", (0.1, 0.2, 0.3, 0.4))), "lang": {"en": 0.7, "fr": 0.3}, "topic": {"x": 0.5, "y": 0.5}}
    raked = mixing.raked_cells(table, targets, rounds=20).collect()
    total = sum(c[3] for c in cells)
    for margin, goal in targets.items():
        sums = defaultdict(float)
        for r in raked:
            sums[r[margin]] += r["tokens"] * r["weight"]
        assert {k: v / total for k, v in sums.items()} == pytest.approx(goal, rel=1e-6)


def test_probabilities_are_calibrated(spark):
    table = spark.createDataFrame(
        [("a", "", "", 100, 5.0), ("b", "", "", 900, 0.5)], "source string, lang string, topic string, tokens long, weight double"
    )
    got = {r["source"]: r["probability"] for r in mixing.calibrated(table, 0.5).collect()}
    assert got["a"] == 1.0
    assert got["b"] == pytest.approx(400 / 900)


def test_mixing_edges(spark):
    docs = edge_docs(spark)
    mixed = mixing.mix(docs, fraction=0.5)
    assert mixed.columns == docs.columns + ["mix_"]
    assert Counter(found(mixed, "doc_id", "text")) == Counter(found(docs, "doc_id", "text"))
    draws = {}
    for doc_id, m in found(mixed, "doc_id", "mix_"):
        assert 0 <= m["draw"] < 1 and 0 <= m["probability"] <= 1
        assert m["selected"] == (m["draw"] < m["probability"])
        assert draws.setdefault(doc_id, m["draw"]) == m["draw"]
    assert mixing.sample(docs).columns == docs.columns
    assert mixing.mix(empty_docs(spark)).count() == 0


def test_absent_targets_are_scaled_over_those_present(spark):
    docs = edge_docs(spark)
    mixed = mixing.mix(docs, targets={"source": {"hot": 0.5, "nowhere": 0.5}})
    weights = {r["source"]: r["w"] for r in mixed.groupBy("source").agg(F.max("mix_.weight").alias("w")).collect()}
    assert weights["hot"] > 0 and weights["cold"] == 0


# ---- licenses


def license_brute(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    ws = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    places, labels = [], set()
    for phrase, label in licenses.BASE.items():
        p = phrase.split()
        for i in range(len(ws) - len(p) + 1):
            if ws[i : i + len(p)] == p:
                places.append(i)
                labels.add(label)
    canon = " " + "  ".join(ws) + " "
    hits = []
    for rule in licenses.RULES:
        if rule.keyword in ws:
            hits += [(m.start(), -m.end(), rule.tier, rule.no, rule.label) for m in re.finditer(rule.pattern, canon)]
    kept = set()
    for h in hits:
        inside = [o for o in hits if o != h and o[2] <= h[2] and o[0] <= h[0] and o[1] <= h[1] and (o[:4] < h[:4])]
        if not inside:
            kept.add(h)
    all_labels = ",".join(sorted(labels | {h[4] for h in kept}))
    return len(ws), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)), all_labels


def test_license_scan_is_the_brute_force_scan(spark):
    rng = random.Random(5)
    phrases = [
        "GNU General Public License, version 3 or later", "Licensed under the Apache License, Version 2.0.", "CC BY-NC 4.0", "CC-BY CC_BY cc by",
        "MIT License", "the GPLv2", "gpl v3", "GNU Lesser General Public Licence 2.1", "All rights reserved", "public domain", "Apache\nLicense",
        "Ünited cc bÿ", "under the terms of the MIT license", "BSD 3-Clause", "bsd license 3-clause", "creative commons attribution 4.0", "see the license file",
    ]
    texts = []
    for i in range(60):
        parts = []
        for _ in range(rng.randint(0, 6)):
            parts += [rng.choice(phrases), " ".join(prose(rng, 4).split())]
        texts.append((1000 + i, rng.choice([" ", "\n", "; ", ""]).join(parts), "en", "s", 1) + ("x",) * 12)
    docs = edge_docs(spark, texts)
    got = Counter(found(licenses.scan(docs), "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels"))
    assert got == Counter((d[0], *license_brute(d[1])) for d in rows() + texts)
    assert licenses.scan(empty_docs(spark)).count() == 0


def test_a_stronger_detection_hides_what_it_contains(spark):
    docs = spark.createDataFrame([(1, "This is under the GNU General Public License version 2.")], "doc_id long, text string")
    row = licenses.scan(docs).first()
    assert row["labels"] == "gpl,gpl-2" and row["n_detections"] == 2 and row["score"] == 1.0
    none = licenses.scan(spark.createDataFrame([(1, None), (1, "")], "doc_id long, text string")).collect()
    assert {(r["labels"], r["score"], r["first_word"], r["n_words"]) for r in none} == {("", 0.0, None, 0)}


#: Texts as they stand in files, with labels that must be found and labels that must not.
LICENSED = [
    ("// SPDX-License-Identifier: Apache-2.0", "apache-2.0", "mit"),
    ("# SPDX-License-Identifier: MIT", "mit", "isc"),
    ("/* SPDX-License-Identifier: GPL-2.0-or-later */", "gpl-2.0", "gpl-3.0"),
    ("SPDX-License-Identifier: GPL-2.0+", "gpl-2.0", "lgpl-2.0"),
    ("SPDX-License-Identifier: LGPL-2.1-only", "lgpl-2.1", "gpl-2.0"),
    ("SPDX-License-Identifier: BSD-3-Clause\n", "bsd-3.clause", "bsd-2.clause"),
    ("SPDX-License-Identifier: CC0-1.0", "cc0-1.0", "cc-by"),
    ("SPDX-License-Identifier: MPL-2.0", "mpl-2.0", "mpl-1.1"),
    (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as\n"
        "published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.", "gpl-2", "gpl-3",
    ),
    ("the GNU General Public License as published by the Free Software Foundation, either version 3 of the License", "gpl-3", "gpl-2"),
    ("GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License", "lgpl-2.1", "gpl-2"),
    ("GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License", "agpl-3", "lgpl-3"),
    ("You may obtain a copy of the License at\n\n    http://www.apache.org/licenses/LICENSE-2.0", "", "apache-2.0"),
    (
        "you may not use this file except in compliance with the License.\nYou may obtain a copy of the License at\n\n"
        "    http://www.apache.org/licenses/LICENSE-2.0\n", "apache-2.0", "apache-1.1",
    ),
    (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,\n"
        "provided that the above copyright notice and this permission notice appear in all copies.", "isc", "0bsd",
    ),
    ("Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted.", "0bsd", "isc"),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software", "mit", "ncsa"),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted", "bsd", "mit"),
    ("Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software", "bsd-3.clause", "bsd-4.clause"),
    ("In no event will the authors be held liable for any damages arising from the use of this software.", "zlib", "libpng"),
    ("This is free and unencumbered software released into the public domain.", "unlicense", "cc0"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "mpl-2.0", "mpl-1.1"),
    ("Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license", "bsl-1.0", "mit"),
    ("Everyone is permitted to copy and distribute verbatim or modified copies of this license document", "wtfpl", "gpl"),
    ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "cc-by-sa-4.0", "cc-by-4.0"),
    ("This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0", "epl-1.0", "epl-2.0"),
    ("The identifier of the driver was apt to fail.", "", "apache"),
]


def test_notices_and_identifiers_have_the_labels_they_must_have(spark):
    docs = spark.createDataFrame([(i, t[0]) for i, t in enumerate(LICENSED)], "doc_id long, text string")
    got = {r["doc_id"]: set(r["labels"].split(",")) for r in licenses.scan(docs).collect()}
    for i, (text, label, other) in enumerate(LICENSED):
        assert label in got[i] and other not in got[i], (text, got[i])


# ---- quality rules


def quality_brute(text):
    text = text or ""
    ws = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    windows = Counter(tuple(ws[i : i + 8]) for i in range(len(ws) - 7))
    covered = {i + k for i in range(len(ws) - 7) if windows[tuple(ws[i : i + 8])] > 1 for k in range(8)}
    counts = len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)
    return *counts, len(ws) < 20 or 100 * len(covered) > 30 * len(ws)


def test_quality_counts_are_the_brute_force_counts(spark):
    rng = random.Random(8)
    more = []
    for i in range(30):
        p = prose(rng, rng.randint(5, 60))
        text = p + rng.choice(["", "\n" + p, " " + p + " " + p, "\n" + p[: len(p) // 2], " #$% | <>&*", "\n\n\n \t"])
        more.append((500 + i, text, "en", "s", 1) + ("x",) * 12)
    more.append((600, "a b c d e f g h", "en", "s", 1) + ("x",) * 12)
    more.append((601, "a b c d e f g h i", "en", "s", 1) + ("x",) * 12)
    more.append((602, "a " * 9, "en", "s", 1) + ("x",) * 12)
    judged = quality_rules.judge(edge_docs(spark, more))
    got = Counter(found(judged, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"))
    assert got == Counter((d[0], *quality_brute(d[1])) for d in rows() + more)
    assert all(not k for b, k in found(judged, "base_failed", "kept") if b)
    assert quality_rules.judge(empty_docs(spark)).count() == 0


def test_fences_follow_their_group(spark):
    """A share of symbols usual in one source is an outlier in another."""
    rng = random.Random(2)
    table = []
    for i in range(250):
        table.append((i, prose(rng, 60) + " |" * (8 + i % 7), "en", "tables"))
        table.append((1000 + i, prose(rng, 60), "en", "plain"))
    table.append((5000, prose(rng, 60) + " |" * 12, "en", "plain"))
    docs = spark.createDataFrame(table, "doc_id long, text string, lang string, source string")
    kept = dict(found(quality_rules.judge(docs), "doc_id", "kept"))
    assert not kept.pop(5000)
    assert all(kept.values())


def test_sketch_quantiles_are_near_the_true_ones(spark):
    values = spark.range(1, 5001).select(quality_rules.middle_of(quality_rules.bin_of(F.col("id"))).alias("m"), "id")
    assert values.where("abs(m - id) > 0.021 * id").count() == 0


# ---- substring and line dedup


def units_brute(table, least):
    """Lines, paragraphs and sentences by splitting, with their places."""
    first, out, units = {}, Counter(), []
    for doc_id, text in {(d[0], d[1]) for d in table}:
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        lines = lower.splitlines(keepends=True) if set(lower) & {"\n"} and not set(lower) & set("\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029") else re.split(r"(?<=\n)", lower)
        pieces, at, held, held_at = [], 0, "", 0
        for line in lines:
            pieces.append(("line", at, line))
            if held and line != "\n" and held.endswith("\n\n"):
                pieces.append(("paragraph", held_at, held))
                held, held_at = "", at
            elif not held.strip("\n") and line != "\n":
                held, held_at = "", at  # empty lines before the first paragraph belong to none
            held += line
            at += len(line)
        pieces.append(("paragraph", held_at, held))
        pieces += [("sentence", m.start(), m[0]) for m in re.finditer(substring.UNITS["sentence"], lower)]
        for unit, start, body in pieces:
            ws = re.findall(r"[^\x20\x09-\x0D]+", body)
            if unit in least and len(ws) >= least[unit]:
                units.append((unit, doc_id is None, doc_id or 0, start, start + len(body), tuple(ws), doc_id))
    for u in sorted(units, key=lambda u: u[1:4]):
        if (u[0], u[5]) in first:
            out[u[0], u[6], u[3], u[4]] += 1
        else:
            first[u[0], u[5]] = u
    return out


@pytest.mark.parametrize("units", [substring.DEFAULT, {"line": 1}, {"paragraph": 3, "sentence": 1}])
def test_substring_dedup_is_the_brute_force_one(spark, units):
    rng = random.Random(4)
    passage = prose(rng, 55).replace("\n", " ")
    more = [(700 + i, "Start here " + passage + " " + prose(rng, 20), "en", "s", 1) + ("x",) * 12 for i in range(5)]
    more += [(800 + i, f"Own {i}\n\nThe same\ntwo lines.\n\n\nYes\nno {i}\n\nYES", "en", "s", 1) + ("x",) * 12 for i in range(4)]
    docs = edge_docs(spark, more)
    removed = substring.repeated_units(docs, units)
    got = found(removed, "unit", "doc_id", "start", "end")
    assert set(got) == set(units_brute(rows() + more, units))
    texts = {d[0]: d[1] for d in rows() + more if d[0] is not None}
    for doc_id, start, end, first_id, first_start in found(removed, "doc_id", "start", "end", "first_doc_id", "first_start"):
        if doc_id is not None:
            same = texts[first_id][first_start : first_start + end - start].lower().split()
            assert texts[doc_id][start:end].lower().split()[:3] == same[:3]
    cleaned = substring.drop_repeated_units(docs, units)
    assert cleaned.columns == docs.columns and cleaned.count() == docs.count()
    gone = defaultdict(set)
    for _, doc_id, start, end in got:
        gone[doc_id].update(range(start, end))
    for doc_id, text in found(cleaned, "doc_id", "text"):
        if doc_id is not None:  # the union of the spans, and nothing else, is lost
            assert text == (None if texts[doc_id] is None else "".join(c for i, c in enumerate(texts[doc_id]) if i not in gone[doc_id]))
    assert substring.repeated_units(empty_docs(spark)).count() == 0


def test_units_make_up_the_whole_text():
    text = "A b. C!? d\n\ne 4.0 f\n.\n x"
    for pattern in substring.UNITS.values():
        assert "".join(m[0] for m in re.finditer(pattern, text)) == text


def lines_brute(table):
    windows, seen, gone = [], set(), defaultdict(set)
    for doc_id, text in {(d[0], d[1]) for d in table}:
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        own = [(i, " ".join(re.findall(r"[^\x20\x09-\x0D]+", x))) for i, x in enumerate(lower.split("\n"))]
        own = [x for x in own if x[1]]
        windows += [((doc_id is None, doc_id or 0, own[i][0]), tuple(x[1] for x in own[i : i + 3]), [x[0] for x in own[i : i + 3]], doc_id) for i in range(len(own) - 2)]
    for _, key, covers, doc_id in sorted(windows):
        if key in seen:
            gone[doc_id] |= set(covers)
        seen.add(key)
    return gone


def test_line_windows_are_the_brute_force_ones(spark):
    rng = random.Random(6)
    block = prose(rng, 200)
    more = [(800 + i, prose(rng, 20) + "\n\n" + block.upper() + "\n" + prose(rng, 20), "en", "s", 1) + ("x",) * 12 for i in range(4)]
    more.append((900, "a\nb\nc\na\nb\nc\nd", "en", "s", 1) + ("x",) * 12)
    docs = edge_docs(spark, more)
    got = {d: set(c) for d, c in found(line_windows.repeated_lines(docs), "doc", "covered")}
    assert got == lines_brute(rows() + more)
    assert got[900] == {3, 4, 5}
    cleaned = line_windows.drop_repeated_lines(docs)
    assert cleaned.columns == docs.columns and cleaned.count() == docs.count()
    left = dict(found(cleaned, "doc_id", "text"))
    assert left[900] == "a\nb\nc\nd" and left[800] == more[0][1] and left[23] is None
    assert line_windows.repeated_lines(empty_docs(spark)).count() == 0
