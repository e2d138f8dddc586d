"""Licence scans by a positional rare-token index, in DataFrame functions only.

Every licence template has a mandatory key phrase. Over all files the document
frequency of the key phrases' words is counted; a template is filed under the
words of its key phrase with the highest IDF. A file's occurrences of those
index words are its postings; a template's postings are shifted by the word's
place in the key phrase and intersected by that relative position. What is
left are candidate starts: there the whole key phrase is verified, and the
share of the template's words that stand at their places is the score. No
rows are shuffled but the frequency counts.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii, text_of

#: Characters between words (the text is already lower-cased).
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Index words of a template whose postings are intersected.
INDEX_WORDS = 2


def words_of(text: str) -> list[str]:
    """Words of a template: as ``words_column`` has them."""
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered) if w]


def words_column(c):
    return F.array_remove(F.split(lower_ascii(c), BETWEEN), "")


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    key_phrase: str
    base: bool = False

    @property
    def words(self) -> list[str]:
        return words_of(self.text)

    @property
    def key(self) -> list[str]:
        return words_of(self.key_phrase)

    @property
    def key_at(self) -> int:
        """Where the key phrase stands in the template."""
        n = len(self.key)
        return next(i for i in range(len(self.words)) if self.words[i:i + n] == self.key)


# The base phrases with their labels, and opening or naming
# sentences of well-known licences with the words that must be there.
TEMPLATES = (
    Template("mit", "released under the mit license", "under the mit license", base=True),
    Template("apache-2", "licensed under the apache license version 2 0", "apache license version 2", base=True),
    Template("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc", base=True),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
             "associated documentation files", "permission is hereby granted free of charge to any person obtaining"),
    Template("apache-2", "you may not use this file except in compliance with the license",
             "may not use this file except in compliance with the license"),
    Template("gpl-3", "this work is licensed under the gnu general public license version 3",
             "gnu general public license version 3"),
    Template("gpl-2", "under the terms of the gnu general public license version 2",
             "gnu general public license version 2"),
    Template("lgpl", "under the terms of the gnu lesser general public license", "gnu lesser general public license"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
             "redistribution and use in source and binary forms"),
    Template("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0",
             "mozilla public license"),
    Template("unlicense", "this is free and unencumbered software released into the public domain",
             "free and unencumbered software"),
)


def document_frequency(words: DataFrame, vocabulary: list[str]) -> tuple[int, dict[str, int]]:
    """Rows, and rows that have each vocabulary word. At most one row per
    vocabulary word reaches the driver."""
    asked = F.array(*map(F.lit, vocabulary))
    marked = F.explode(F.array_append(F.array_intersect("w", asked), F.lit("")))
    counts = {r["word"]: r["count"] for r in words.select(marked.alias("word")).groupBy("word").count().collect()}
    return counts.pop("", 0), counts


def _literal(words: list[str]):
    return F.array(*map(F.lit, words))


def _shifted(word: str, key: list[str]):
    """A word's postings, less each of its places in the key phrase."""
    own = F.filter("postings", lambda p: p["word"] == word)
    moved = [F.transform(own, lambda p: p["i"] - i) for i, w in enumerate(key) if w == word]  # noqa: B023
    return F.flatten(F.array(*moved))


def _verified(t: Template, index: list[str]):
    """Starts of the key phrase: postings of its index words that meet at one
    relative position, and the whole phrase there."""
    starts = F.array_distinct(_shifted(index[0], t.key))
    for word in index[1:]:
        starts = F.array_intersect(starts, _shifted(word, t.key))
    whole = lambda s: (s >= 0) & (F.slice("w", F.greatest(s, F.lit(0)) + 1, F.lit(len(t.key)))
                                  == _literal(t.key))
    return F.when(F.size(F.array_intersect("has", _literal(index))) == len(index), F.filter(starts, whole))


def scan_licenses(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_base (places of base
    key phrases), first_word and last_word (smallest and largest start of
    them, else null), base_labels, labels (distinct, sorted, comma-joined;
    empty without any) and score (largest share of a template's words in place
    at a verified key phrase, else 0).

    A null or empty text has no words, empty labels and score 0. Repeated rows
    are scanned each by itself; ids may be null; other columns are not read;
    an empty frame gives no rows. Texts are scanned whole.
    """
    words = docs.select(F.col(id_col).alias("doc_id"), words_column(text_of(docs, text_col)).alias("w"))
    vocabulary = sorted({w for t in templates for w in t.key})
    rows, frequency = document_frequency(words, vocabulary)
    idf = {w: math.log((rows + 1) / (frequency.get(w, 0) + 1)) for w in vocabulary}
    chosen = {t: sorted(set(t.key), key=lambda w: (-idf[w], w))[:INDEX_WORDS] for t in templates}
    index = sorted({w for ws in chosen.values() for w in ws})

    found = words.withColumn("has", F.array_intersect("w", _literal(index)))
    at = F.filter(F.sequence(F.lit(0), F.size("w") - 1), lambda i: F.array_contains("has", F.get("w", i)))
    postings = F.when(F.size("has") > 0, F.transform(at, lambda i: F.struct(i.alias("i"), F.get("w", i).alias("word"))))
    posted = found.withColumn("postings", postings)

    checked = posted.withColumns({f"v{k}": _verified(t, chosen[t]) for k, t in enumerate(templates)})

    none = F.array().cast("array<int>")
    base = F.flatten(F.array(*(F.coalesce(f"v{k}", none) for k, t in enumerate(templates) if t.base)))

    def labels(only_base: bool):
        some = [F.when(F.size(f"v{k}") > 0, F.lit(t.label)) for k, t in enumerate(templates)
                if t.base or not only_base]
        return F.concat_ws(",", F.array_sort(F.array_distinct(F.array_compact(F.array(*some)))))

    def share(k: int, t: Template):
        in_place = lambda s: sum(
            (F.coalesce(F.get("w", F.when(s + (j - t.key_at) >= 0, s + (j - t.key_at))) == w, F.lit(False)).cast("int")
             for j, w in enumerate(t.words)), F.lit(0))
        best = F.array_max(F.transform(f"v{k}", in_place))
        return F.when(F.size(f"v{k}") > 0, best / F.lit(len(t.words)))

    scores = [share(k, t) for k, t in enumerate(templates)]
    return (checked.withColumn("b", base)
            .select("doc_id", F.size("w").cast("long").alias("n_words"), F.size("b").cast("long").alias("n_base"),
                    F.array_min("b").cast("long").alias("first_word"), F.array_max("b").cast("long").alias("last_word"),
                    labels(True).alias("base_labels"), labels(False).alias("labels"),
                    F.coalesce(F.greatest(*scores), F.lit(0.0)).alias("score")))
