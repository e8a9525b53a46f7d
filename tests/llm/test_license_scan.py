import math
import re

import pytest
from llm_fixtures import docs_of, edge_docs, empty_docs

from quern.llm import license_scan as ls

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def slow_scan(text, threshold=0.8):
    w = WORDS.findall(low(text))
    places, base, best = [], set(), 0.0
    for phrase, label in ls.PHRASES:
        p = phrase.split()
        at = [i for i in range(len(w) - len(p) + 1) if w[i:i + len(p)] == p]
        places += at
        base |= {label} if at else set()
    labels = set(base)
    for line in (text or "").split("\n"):
        have = set(WORDS.findall(low(line)))
        for label, body in ls.TEMPLATES:
            t = set(body.split())
            held = len(t & have)
            if held >= math.ceil(threshold * len(t) - 1e-9):
                labels.add(label)
                best = max(best, held / len(t))
    return (len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(labels)),
            1.0 if places else best)


TEXTS = ["Licensed under CC BY-NC 4.0.", "cc\nby", "CC by cc BY cc by", "All rights\treserved. all RIGHTS reserved", "", None, "cc", "...",
         "This work is licensed under the GNU General Public License, version 3.\nx", "K cc by", "Released under the MIT License.",
         "word Licensed under the Apache License, Version 2.0 here", "the released license of mit under that", "license mit",
         "Redistribution and use in source, and binary forms; with or without modification are allowed", "ŉcc by", "cc_by", "0cc by",
         "no part may be reproduced without permission", "by cc all rights", "İcc by   cc by"]


def test_matches_brute_force(spark):
    docs = docs_of(spark, TEXTS)
    got = {r.doc_id: tuple(r)[1:] for r in ls.scan(docs).collect()}
    for i, t in enumerate(TEXTS):
        want = slow_scan(t)
        assert got[i][:6] == want[:6], (i, t, got[i], want)
        assert got[i][6] == pytest.approx(want[6]), t


def test_edges(spark):
    docs = edge_docs(spark)
    got = sorted((tuple(r) for r in ls.scan(docs).collect()), key=repr)
    assert got == sorted(((r.doc_id, *slow_scan(r.text)) for r in docs.collect()), key=repr)
    assert ls.scan(empty_docs(spark)).collect() == []
    bare = ls.scan(docs_of(spark, ["cc by", "x"]), phrases=[], templates=[]).collect()
    assert sorted((r.doc_id, r.n_words, r.n_base, r.labels) for r in bare) == [(0, 2, 0, ""), (1, 1, 0, "")]


BSD = "Redistribution and use in source and binary forms, with or without{}modification, are permitted provided that"


def test_wrapped_notices(spark):
    lorem = " ".join(f"z{i}" for i in range(300))
    cases = [(BSD.format("\n"), "bsd", 1.0), (BSD.format(" "), "bsd", 1.0), (f"{lorem}\n{lorem} {BSD.format(chr(10))} {lorem}\n{lorem}", "bsd", 1.0),
             (BSD.format("\r\n").replace(" ", "\n# "), "bsd", 1.0), (BSD.format("\n\n * \n"), "bsd", 1.0),
             (f"x\n{BSD.format(chr(10))}\nLicensed under the\nApache License,\nVersion 2.0\n", "apache,bsd", 1.0),
             (BSD.format("\n" + lorem + "\n"), "", 0.0), ("und mit dem\nLicensed under the Apache License, Version 2.0.", "apache", 1.0),
             ("Permission is hereby granted,\nfree of charge, to any\nperson obtaining\na copy of this\nsoftware", "mit", 1.0)]
    got = {r.doc_id: (r.labels, r.score) for r in ls.scan(docs_of(spark, [t for t, _, _ in cases])).collect()}
    assert [got[i] for i in range(len(cases))] == [(label, score) for _, label, score in cases]


def test_a_named_license_needs_its_name(spark):
    cases = [("Released under the Apache License.", ""), ("Released under the BSD License.", ""), ("Under MIT license, released.", "mit"),
             ("The license was released under pressure from the board.", ""), ("Licensed under the Foo License, Version 2.0", ""),
             ("Licensed under the Apache License, Version 2", "apache"), ("Released under the\nMIT License.", "mit")]
    got = {r.doc_id: r.labels for r in ls.scan(docs_of(spark, [t for t, _ in cases])).collect()}
    assert [got[i] for i in range(len(cases))] == [label for _, label in cases]
