import random
import re
import time

from weftline.llm import licenses
from weftline.llm.licenses import Scanner, op10_licenses, resolve, rules, scan_licenses

DOCS = "doc_id long, text string, lang string, source string, n_chars long, words string, label string"


def docs(spark, *texts):
    return spark.createDataFrame([(k, t, None, None, None, "x", "y") for k, t in enumerate(texts)], DOCS)


def brute_resolve(found):
    """One detection after another, each held against all those taken."""
    kept = []
    for start, end, rule in sorted(found, key=lambda d: (d[2].priority, d[0] - d[1], d[0], d[2].name)):
        if not any((a <= start and end <= b) or (r.priority < rule.priority and a < end and start < b) for a, b, r in kept):
            kept.append((start, end, rule))
    return sorted(kept, key=lambda d: (d[0], d[1], d[2].name))


def brute(text):
    line = " ".join(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")))
    words = line.split(" ") if line else []
    base = [(label, k) for phrase, label in licenses.BASE.items() for k in range(len(words)) if words[k : k + len(phrase.split())] == phrase.split()]
    found = brute_resolve([(m.start(), m.end(), r) for r in rules() for m in r.pattern.finditer(line)])
    return len(words), sorted(base), sorted({b for b, _ in base} | {r.label for _, _, r in found})


TEXTS = [
    None,
    "",
    "Licensed under CC BY-NC 4.0.",
    "x GNU General Public License, version 3. All rights reserved; ALL RIGHTS RESERVED",
    "cc by cc by",
    "Licensed under the Apache License, Version 2.0, see LICENSE.txt. Copyright (c) 2020",
    "é all rights reservedé",
    "Permission is hereby granted, free of charge, to any person obtaining a copy",
    "Released under the MIT License. " * 500,
    "Beerware license, zope public license, (1-clause BSD) simplified bsd; Creative Commons Attribution-NonCommercial 3.0",
]


def test_prefilter_and_base_against_brute_force(spark):
    rows = {r.doc_id: r for r in scan_licenses(docs(spark, *TEXTS, TEXTS[2])).collect()}
    for k, text in enumerate([*TEXTS, TEXTS[2]]):
        n, base, labels = brute(text)
        assert rows[k].n_words == n
        assert sorted((b.label, b.start) for b in rows[k].base) == base
        assert sorted({b.label for b in rows[k].base} | {d.label for d in rows[k].detections}) == labels
        assert 0 <= rows[k].score <= 1


def test_every_rule_has_a_keyword_that_its_matches_hold():
    assert len(rules()) > 200
    for r in rules():
        assert r.keywords and all(r.keywords)
    s = Scanner()
    assert [d["label"] for d in s.scan("Licensed under CC BY-NC 4.0")["detections"]] == ["cc-by-nc-4.0"]


def test_containment_and_priority():
    found = Scanner().scan("this file is released under the GNU General Public License version 2")["detections"]
    assert [d["rule"] for d in found] == ["gpl-2.0:grant"]


def test_query_on_whole_table(spark):
    rows = op10_licenses(spark, "/root/testdata/sf0.001").collect()
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    assert len(rows) == len(table)
    by = {r.doc_id: r for r in rows}
    for d in table:
        n, base, labels = brute(d.text)
        r = by[d.doc_id]
        assert (r.n_words, r.n_base, r.labels) == (n, len(base), ",".join(labels))
        assert (r.first_word, r.last_word) == ((min(k for _, k in base), max(k for _, k in base)) if base else (None, None))


def test_empty_table(spark):
    assert scan_licenses(docs(spark).limit(0)).collect() == []


def examples(parsed):
    """Strings that a parsed pattern matches: one of every alternative, and with every optional part."""
    parts = []
    for op, arg in parsed:
        op = str(op)
        if op == "LITERAL":
            parts.append([chr(arg)])
        elif op == "NOT_LITERAL":
            parts.append(["x"])
        elif op == "IN":
            parts.append([chr(v) if str(o) == "LITERAL" else chr(v[0]) if str(o) == "RANGE" else "a" for o, v in arg if str(o) != "NEGATE"] if str(arg[0][0]) != "NEGATE" else ["x"])
        elif op == "BRANCH":
            parts.append([e for p in arg[1] for e in examples(p)])
        elif op == "SUBPATTERN":
            parts.append(examples(arg[3]))
        elif op in ("MAX_REPEAT", "MIN_REPEAT"):
            each = examples(arg[2])
            parts.append([each[0] * arg[0], *(e * max(1, arg[0]) for e in each)])
    return ["".join(p[k % len(p)] if j == i else p[0] for j, p in enumerate(parts)) for i, own in enumerate(parts) for k in range(len(own))] or [""]


def test_prefilter_loses_no_alternative():
    for r in rules():
        for text in set(examples(re._parser.parse(r.pattern.pattern))):
            if r.pattern.search(text):
                assert r.gate in text and any(k in text for k in r.keywords), (r.name, text)
    scanned = Scanner().scan("This document may not be copied without written consent.")
    assert [d["label"] for d in scanned["detections"]] == ["no-redistribution"]


def test_sweep_against_pairs():
    rng, own = random.Random(4), rules()
    for size in (0, 1, 5, 40, 200):
        for _ in range(40):
            found = [(a, a + rng.randint(1, 12), rng.choice(own[:: len(own) // 9])) for a in (rng.randint(0, 3 * size) for _ in range(size))]
            found = list({(a, b, r.name): (a, b, r) for a, b, r in found}.values())
            assert resolve(found) == brute_resolve(found)


def test_long_text_takes_linear_time():
    line = "Licensed under the MIT License, see zlib license; cc by 4.0 x. "
    scanner, took = Scanner(), []
    for n in (4000, 40_000):
        began = time.perf_counter()
        out = scanner.scan(line * n)
        took.append(time.perf_counter() - began)
        assert len(out["base"]) == n and out["base"][-1]["start"] == 13 * n - 5 and len(out["detections"]) == 3 * n
    assert took[1] < 30 * took[0] + 1
