import math
import random
import re
from collections import Counter

import pytest

from tests.llm.cases import CLASHING, ROWS, docs, none, odd, rows
from tidemark.llm import search as module
from tidemark.llm.search import TERM, search
from pyspark.sql import functions as F


def terms(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(TERM, low)


def brute(documents, items, top=10):
    bags = [(i, Counter(terms(t))) for i, t in documents]
    n_docs, n_terms = sum(bool(b) for _, b in bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scored = []
        for doc, bag in bags:
            n = sum(bag.values())
            score = 0
            for t in set(terms(text)) & set(bag):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * (1_000_000_000 * bag[t] // (1000 * bag[t] + 8 * (10 + 90 * n * n_docs // n_terms)))
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        out += [(item, k + 1, doc, -s) for k, (s, _, _, doc) in enumerate(sorted(scored, key=lambda x: x[:3])[:top])]
    return sorted(out, key=lambda r: tuple((x is not None, x) for x in r))


ITEMS = [(1, "one small Text, one"), (1, "end word"), (2, None), (3, "--- !"), (None, "no id"), (4, "東京 WÖRDS wörds x"),
         (5, "absent zebra")]


def test_odd_rows(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string").withColumns({c: F.lit(1) for c in CLASHING})
    got = search(odd(spark), items)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert rows(got) == brute(ROWS, ITEMS)


@pytest.mark.parametrize("owners,bundle,block,shard", [(1, 256, 200_000, 8 << 20), (4, 3, 200_000, 500), (3, 2, 40, 200)])
def test_pipeline_against_brute_force(spark, monkeypatch, owners, bundle, block, shard):
    monkeypatch.setattr(module, "BUNDLE_ITEMS", bundle)
    monkeypatch.setattr(module, "BLOCK_TERMS", block)
    monkeypatch.setattr(module, "SHARD_BYTES", shard)
    r = random.Random(owners)
    vocabulary = [f"w{int(r.paretovariate(0.5)) % 400}" for _ in range(3000)]
    texts = [" ".join(r.choices(vocabulary, k=r.randrange(1, 40))) for _ in range(400)]
    texts += [texts[0]] * 60 + ["w1 w2 w3"] * 50  # groups of copies: ties
    items = [(k, " ".join(r.choices(vocabulary, k=r.randrange(1, 15)))) for k in range(12)] + [(99, texts[0])]
    got = search(docs(spark, texts).repartition(5), spark.createDataFrame(items, "item_id long, text string"),
                 owners=owners, top=10)
    assert rows(got) == brute(list(enumerate(texts)), items)


def test_no_rows(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert search(none(spark), items).count() == 0
    assert search(odd(spark), items.limit(0)).count() == 0
    assert search(docs(spark, [None, "", "..."]), items).count() == 0
