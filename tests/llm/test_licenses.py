import random
import re

from tests.llm.cases import LONG, ROWS, docs, none, odd, rows
from tidemark.llm.licenses import INDEX_WORDS, TEMPLATES, scan_licenses, words_of


def brute(doc_id, text):
    """Every template at every place."""
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = [x for x in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", low) if x]
    base, base_labels, labels, score = [], set(), set(), 0.0
    for t in TEMPLATES:
        key, words = t.key, t.words
        for s in range(len(w) - len(key) + 1):
            if w[s:s + len(key)] == key:
                labels.add(t.label)
                if t.base:
                    base.append(s)
                    base_labels.add(t.label)
                at = s - t.key_at
                score = max(score, sum(0 <= at + j < len(w) and w[at + j] == x for j, x in enumerate(words)) / len(words))
    return (doc_id, len(w), len(base), min(base, default=None), max(base, default=None),
            ",".join(sorted(base_labels)), ",".join(sorted(labels)), score)


TEXTS = ["", None, "under the MIT license", "Under the\nmit  LICENSE.", "the mit license under", "under the mit licenses",
         "apache license version 2", "Apache License, Version 2.0", "apache license version", "cc by nc cc by nc cc by nc",
         "CC-BY-NC 4.0, CC BY-NC", "under the mit license under the mit license", "é under the mit license é",
         "license", "mit mit mit", "under thé mit license", "nc by cc", LONG + " released under the mit license",
         "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
         "this work is licensed under the GNU General Public License, version 3.", "x" * 100_000]


def sort(some):
    return sorted(some, key=lambda r: tuple((x is not None, x) for x in r))


def test_against_all_places(spark):
    r = random.Random(4)
    vocabulary = sorted({w for t in TEMPLATES for w in t.words}) + ["x", "y"]
    mixed = [" ".join(r.choice([r.choice(vocabulary), r.choice(TEMPLATES).key_phrase, r.choice(TEMPLATES).text])
                      for _ in range(r.randrange(12))) for _ in range(300)]
    some = TEXTS + mixed
    assert rows(scan_licenses(docs(spark, some))) == sort(brute(*p) for p in enumerate(some))


def test_odd_rows(spark):
    assert rows(scan_licenses(odd(spark))) == sort(brute(*p) for p in ROWS)


def test_no_rows(spark):
    assert scan_licenses(none(spark)).count() == 0


def test_no_python_in_the_plan(spark):
    plan = scan_licenses(odd(spark))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan) and "Exchange" not in plan


def test_key_phrases_stand_in_their_templates():
    for t in TEMPLATES:
        assert t.words[t.key_at:t.key_at + len(t.key)] == t.key and len(set(t.key)) >= INDEX_WORDS
        assert words_of(t.text) == t.words
