"""Licence detection: base phrases and suppression against plain versions, every rule reached, the prefilter without effect on results."""

import random
import re
import re._parser as regex_tree

import pytest

from taxaloom.llm import license_rules, license_scan

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def base(text):
    words = WORD.findall(lower(text))
    places = [(i, label) for i in range(len(words)) for phrase, label in PHRASES.items() if words[i:i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


def sample(tree, rng):
    """A text that a parsed pattern matches."""
    out = []
    for op, arg in tree:
        name = str(op)
        if name == "LITERAL":
            out.append(chr(arg))
        elif name == "NOT_LITERAL":
            out.append("w")
        elif name == "IN":
            kind, value = rng.choice(arg)
            out.append("w" if str(kind) == "NEGATE" or ("NEGATE" in str(arg[0])) else chr(value) if str(kind) == "LITERAL" else chr(rng.randint(*value)))
        elif name == "BRANCH":
            out.append(sample(rng.choice(arg[1]), rng))
        elif name == "SUBPATTERN":
            out.append(sample(arg[3], rng))
        elif name in ("MAX_REPEAT", "MIN_REPEAT"):
            low, high, inner = arg
            out += [sample(inner, rng) for _ in range(rng.randint(low, min(int(high), low + 2)))]
        else:
            raise AssertionError(name)
    return "".join(out)


def samples(seed, each=3):
    rng = random.Random(seed)
    return [(rule, sample(regex_tree.parse(rule.source), rng)) for rule in license_scan.rules().all for _ in range(each)]


def test_hundreds_of_rules_and_each_is_reached_through_its_gate():
    assert len(license_rules.RULES) >= 250
    for rule, text in samples(1, 8):
        found = license_scan.detect(text)[1]
        assert any(r is rule for _, _, r in found), (rule.name, text)


def noisy(rng, texts):
    """Samples as they stand in files: wrapped, commented, in capitals, with words between them."""
    parts = []
    for t in texts:
        sep = rng.choice([" ", "\n * ", "-", " \t", "/"])
        t = sep.join(t.split(" "))
        parts += [rng.choice([t, t.upper(), t.title()]), rng.choice(["", ".", "alpha beta", "— é"])]
    return " ".join(parts)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    pool = [t for _, t in samples(2)]
    out = [noisy(rng, rng.sample(pool, rng.randint(1, 12))) for _ in range(300)]
    return out + [None, "", "cc", "cc by", "CC-BY cc.by", "mit licenses", "MIT\nLicense", "xmit license", "gnu general public license " * 50, "éapache license", "apache license", "apache license\x00"]


def outranks(a, b):
    return (-a[2].priority, -(a[1] - a[0]), a[2].number) < (-b[2].priority, -(b[1] - b[0]), b[2].number)


def test_suppression_as_defined(texts):
    dropped = 0
    for text in texts:
        found = license_scan.detect(text)[1]
        kept = [d for d in found if d[2].base or not any(o is not d and o[0] <= d[0] and d[1] <= o[1] and outranks(o, d) for o in found)]
        assert license_scan.suppress(found) == sorted(kept, key=lambda d: (d[0], d[1], d[2].number))
        dropped += len(found) - len(kept)
    assert dropped > 300


def test_prefilter_changes_nothing(texts, monkeypatch):
    behind = [license_scan.judge(t) for t in texts]
    monkeypatch.setattr(license_scan.Rules, "gated", lambda self, words: self.all)
    assert [license_scan.judge(t) for t in texts] == behind


def test_base_phrases(texts):
    for text in texts:
        got = license_scan.judge(text)
        assert got[:5] == base(text)
        assert set(filter(None, got[4].split(","))) <= set(got[5].split(",")) and 0 <= got[6] <= 1
        assert (got[6] == 0) == (not got[7])


def test_places_in_the_text(texts):
    for text in texts:
        words = WORD.findall(lower(text))
        for label, name, _, _, a, b, start, end in license_scan.judge(text)[7]:
            assert WORD.findall(lower(text[start:end])) == words[a:b] and name.startswith(label)


@pytest.mark.parametrize("text,labels", [
    ("Licensed under CC BY-NC 4.0.", "cc-by,cc-by-nc-4.0"),
    ("/* This work is licensed under the GNU General\n * Public License, version 2 or later. */", "gpl,gpl-2.0-or-later"),
    ("Licensed under the Apache License,\n# Version 2.0", "apache,apache-2.0"),
    ("SPDX-License-Identifier: BSD-3-Clause", "bsd-3-clause"),
    ("We went to the public domain of mit and apache by cc.", ""),
    ("GNU Lesser General Public License v2.1", "lgpl-2.1"),
    ("© 2020 Someone. All rights reserved.", "all-rights-reserved"),
])
def test_known_notices(text, labels):
    assert license_scan.judge(text)[5] == labels


def test_rows(spark, docs, corpus, empty, twice):
    assert license_scan.scan(empty).count() == 0
    out = license_scan.scan(docs)
    assert out.columns == [*docs.columns, "licences"]
    got = {r["doc_id"]: r for r in out.collect()}
    assert len(got) == len(corpus)
    for i, text, _ in corpus:
        assert tuple(got[i]["licences"])[:5] == base(text) and got[i]["text"] == text and got[i]["_batch"] == "b"
    assert license_scan.scan(twice).count() == 7
    long = "word " * 200_000 + "MIT License " * 20_000
    row = license_scan.scan(spark.createDataFrame([(long, 1)], "text string, licences int")).first()
    assert (row["_licences"]["n_base"], row["_licences"]["first_word"], row["licences"]) == (20_000, 200_000, 1)
    assert len(row["_licences"]["found"]) == 20_000
