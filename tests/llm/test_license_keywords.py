"""No keyword and no gate drops what a rule matches: samples of every rule against the scan without prefilter."""

import random
from re import _constants as sre
from re import _parser

import pytest

from quern.llm import licenses


def sample(parsed, rng):
    """A text that the parsed pattern matches."""
    out = b""
    for op, arg in parsed:
        if op is sre.LITERAL:
            out += bytes([arg])
        elif op is sre.IN:
            out += bytes([rng.choice([v for o, v in arg if o is sre.LITERAL])])
        elif op is sre.ANY:
            out += b"x"
        elif op is sre.BRANCH:
            out += sample(rng.choice(arg[1]), rng)
        elif op is sre.SUBPATTERN:
            out += sample(arg[3], rng)
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
            out += b"".join(sample(arg[2], rng) for _ in range(rng.randint(arg[0], min(arg[1], 3))))
        else:
            assert op is sre.ASSERT
    return out


def test_every_rule_fires_on_its_samples():
    rng = random.Random(42)
    for rule in licenses.rules():
        parsed = _parser.parse(rule.pattern.pattern)
        for _ in range(40):
            row = b" " + sample(parsed, rng) + b" "
            assert rule.pattern.search(row), row
            assert all(any(k in row for k in keys) for keys in rule.keywords), row
            assert rule in licenses.tried(row), row
            assert any(rule is r for _, _, r in licenses._detections(row)), (rule.label, row)


@pytest.mark.parametrize("name", ["BSL-1.0", "BUSL-1.1", "CPL-1.0", "OSL-3.0", "OFL-1.1", "MS-PL", "MS-RL", "PSF-2.0"])
def test_identifier_alone(name):
    assert [d["confidence"] for d in licenses.scan(f"// SPDX-License-Identifier: {name}\n")["detections"]] == [1.0]


def test_names_that_lost_their_keyword():
    assert [d["label"] for d in licenses.scan("data: CC Zero 1.0")["detections"]] == ["cc0"]
    assert "cc-by-nd" in [d["label"] for d in licenses.scan("Creative Commons Attribution No Derivatives 4.0")["detections"]]


def test_gated_scan_finds_what_trying_every_rule_finds(spark, sf_dir):
    rng = random.Random(7)
    parsed = [_parser.parse(r.pattern.pattern) for r in licenses.rules()]
    filler = [w.encode() for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").limit(40).collect() for w in (r.text or "").lower().split()[:40]]
    for _ in range(150):
        parts = [sample(rng.choice(parsed), rng) for _ in range(rng.randint(1, 5))]
        row = b" " + b" ".join(x for p in parts for x in (p, *rng.sample(filler, rng.randint(0, 6)))) + b" "
        row = b" " + b" ".join(licenses._WORD.findall(row)) + b" "
        every = [(m.span(), r.number) for r in licenses.rules() for m in r.pattern.finditer(row)]
        gated = [(m.span(), r.number) for r in licenses.tried(row) for m in r.pattern.finditer(row)]
        assert gated == every


def test_rules_are_ordered_and_told_apart():
    rules = licenses.rules()
    assert [r.priority for r in rules] == sorted(r.priority for r in rules)
    assert len({(r.label, r.pattern.pattern) for r in rules}) == len(rules)
    assert len(licenses.SIGNATURES) > 250
    assert all(r.keywords and min(len(k) for keys in r.keywords for k in keys) > 2 for r in rules)


def test_overlapping_detections():
    text = "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."
    found = licenses.scan(text)["detections"]
    assert [d["label"] for d in found] == ["apache-2", "apache-2"] and found[0]["confidence"] == 0.99
    text = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software. MIT License, Copyright (c) 2020"
    assert [d["label"] for d in licenses.scan(text)["detections"]] == ["mit", "mit"]
