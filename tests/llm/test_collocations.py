import random
import re
from collections import Counter, defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.cases import none, odd, rows
from tidemark.llm import collocations as module
from tidemark.llm.collocations import MisraGries, _spread, _squeeze, collocations
from pyspark.sql import functions as F


def brute(documents, threshold, top=2000):
    f, n, out = defaultdict(Counter), Counter(), []
    for lang, text in documents:
        lang = "und" if lang is None else lang
        low = (text or "").translate({c: c + 32 for c in range(65, 91)})
        for piece in re.split("[.,;:!?\n-\r]", low):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            f[lang].update(tuple(w[i:i + k]) for k in range(1, 6) for i in range(len(w) - k + 1))
    for lang, count in f.items():
        some = {p: a for p, a in count.items() if len(p) > 1 and a >= threshold}
        hidden = {q[i:i + m] for q, b in some.items() for m in range(2, len(q)) for i in range(len(q) - m + 1)
                  if b >= count[q[i:i + m]]}
        scored = []
        for p, a in some.items():
            if p not in hidden:
                s, k = min((1000 * a * n[lang] // (count[p[:k]] * count[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-s, -a, " ".join(p).encode(), count[p[:k]], count[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, x, y, n[lang], -s) for i, (s, a, p, x, y) in enumerate(sorted(scored)[:top])]
    return sorted(out)


def corpus(seed, size=300):
    r = random.Random(seed)
    words = ["The", "of", "ünï", "東京", "a", "A", "zoo", *(f"w{k}" for k in range(40))]
    made = []
    for _ in range(size):
        text = ""
        for _ in range(r.randrange(0, 30)):
            text += r.choice([*words, "of the zoo w1 w2", "a a a"]) + r.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r", "!"])
        made.append((r.choice(["en", "de", None, "und"]), text))
    return [*made, ("en", None), (None, ""), *[("en", "one very common passage of seven words here")] * 60]


def frame(spark, some):
    return spark.createDataFrame([(i, *x) for i, x in enumerate(some)], "doc_id long, lang string, text string")


def test_against_brute_force(spark, monkeypatch):
    some = corpus(1)
    for threshold, top, parts in ((3, 2000, 7), (25, 15, 2)):
        got = collocations(frame(spark, some).repartition(parts), threshold, top)
        assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
        want = brute(some, threshold, top)
        assert want and rows(got) == want


def test_a_full_filter_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(module, "FILTER_BITS", 64)
    some = corpus(2, 80)
    assert rows(collocations(frame(spark, some), 4)) == brute(some, 4)


def test_products_past_64_bits(spark):
    counts = spark.createDataFrame([("en", "x y", 2, 3 * 10 ** 12), ("en", "x", 1, 4 * 10 ** 12), ("en", "y", 1, 5 * 10 ** 12)],
                                   "lang string, phrase string, k int, f long")
    words = spark.createDataFrame([("en", 9 * 10 ** 13 + 7)], "lang string, n long")
    got = module.score_phrases(counts, words, 10).collect()
    assert [r["score"] for r in got] == [1000 * 3 * 10 ** 12 * (9 * 10 ** 13 + 7) // (20 * 10 ** 24)]


def test_odd_rows(spark):
    from tests.llm.cases import ROWS
    want = brute([(None, t) for _, t in ROWS], 2)
    assert rows(collocations(odd(spark).withColumn("lang", F.lit(None).cast("string")), 2)) == want
    # a language column of another type is taken as text
    assert {r["lang"] for r in collocations(odd(spark), 2).collect()} == {str(odd(spark).first()["lang"])}


def test_no_rows(spark):
    assert collocations(none(spark).withColumn("lang", F.lit("en"))).count() == 0


@settings(deadline=None)
@given(st.lists(st.lists(st.integers(0, 30), min_size=1, max_size=60), min_size=1, max_size=12), st.integers(1, 8))
def test_summaries_keep_every_frequent_code(runs, threshold):
    mass = sum(map(len, runs))
    summary = MisraGries(mass // threshold + 1)
    for run in runs:
        code, n = np.unique(np.array(run, np.uint32), return_counts=True)
        summary.merge([(code, n)])
        assert len(summary.codes) <= summary.capacity
    assert summary.taken < threshold
    count, kept = Counter(x for run in runs for x in run), dict(zip(summary.codes.tolist(), summary.counts.tolist()))
    for x, n in count.items():
        assert n - summary.taken <= kept.get(x, 0) <= n
        assert n < threshold or kept[x] + summary.taken >= threshold


@given(st.dictionaries(st.integers(0, 2 ** 32 - 1), st.integers(1, 10 ** 12)))
def test_blobs(counts):
    codes = np.array(sorted(counts), np.uint32)
    n = np.array([counts[c] for c in codes.tolist()], np.int64)
    got = _spread(_squeeze(codes, n))
    assert got[0].tolist() == codes.tolist() and got[1].tolist() == n.tolist()
