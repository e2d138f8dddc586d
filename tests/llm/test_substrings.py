import hashlib
import random
from collections import Counter

import numpy as np

from tests.llm.cases import ROWS, docs, none, odd
from tidemark.llm import substrings
from tidemark.llm.substrings import LENGTH, deep_shallow, remove_repeats


def brute(texts):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(t[i:i + LENGTH] for t in raw for i in range(len(t) - LENGTH + 1))
    out = []
    for t in raw:
        gone = bytearray(len(t))
        for i in range(len(t) - LENGTH + 1):
            if seen[t[i:i + LENGTH]] > 1:
                gone[i:i + LENGTH] = b"\1" * LENGTH
        kept = bytes(c for c, g in zip(t, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest(), kept))
    return out


def check(df, pairs):
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, bytes(r.kept))
           for r in remove_repeats(df, with_kept=True).collect()]
    want = [(i, *b) for (i, _), b in zip(pairs, brute([t for _, t in pairs]), strict=True)]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_sorting():
    r = np.random.default_rng(1)
    data = r.integers(97, 99, 4000).astype(np.uint8)
    data[1000:1600] = data[100:700]
    data[2000:2400] = 97
    starts = r.permutation(3700)
    group = r.integers(0, 3, len(starts))
    order, same = deep_shallow(data, starts, group)
    rows = [(int(group[k]), data[starts[k]:starts[k] + LENGTH].tobytes()) for k in order]
    assert rows == sorted(rows)
    assert same.tolist() == [False] + [a == b for a, b in zip(rows, rows[1:], strict=False)]


def texts(seed, n=120):
    """Unrelated texts with shared passages, some just long enough, copies,
    near copies, and runs of one byte."""
    r = random.Random(seed)
    word = lambda: "".join(r.choices("abcdé", k=r.randrange(1, 7)))
    prose = lambda k: " ".join(word() for _ in range(k))
    shared = [prose(80)[:size] for size in (150, 199, 200, 201, 260, 400)]
    out = []
    for _ in range(n):
        kind = r.randrange(8)
        if kind == 0 and out:
            out.append(r.choice(out))
        elif kind == 1 and out:
            t = list(r.choice(out))
            if t:
                t[r.randrange(len(t))] = "#"
            out.append("".join(t))
        elif kind == 2:
            out.append("x" * r.choice([0, 100, 199, 200, 201, 450]))
        else:
            out.append(prose(r.randrange(60)) + "".join(
                f" {r.choice(shared)} {prose(r.randrange(30))}" for _ in range(r.randrange(4))))
    return out


def test_against_brute_force(spark, monkeypatch):
    some = texts(1)
    monkeypatch.setattr(substrings, "SEGMENT_BYTES", 6_000)
    monkeypatch.setattr(substrings, "CHUNK", 700)
    check(docs(spark, some), list(enumerate(some)))


def test_crowded_anchors(spark, monkeypatch):
    """The digest way gives the same, whether a segment or a bucket is crowded."""
    some = texts(2)
    monkeypatch.setattr(substrings, "SEGMENT_BYTES", 6_000)
    for most in ({"CROWDED_IN_SEGMENT": 1}, {"CROWDED": 1}):
        with monkeypatch.context() as m:
            for k, v in most.items():
                m.setattr(substrings, k, v)
            check(docs(spark, some), list(enumerate(some)))


def test_odd_rows(spark):
    rows = [(i, t and t[:3000]) for i, t in ROWS]
    df = odd(spark)
    from pyspark.sql import functions as F
    check(df.withColumn("text", F.substring("text", 1, 3000)), rows)


def test_no_rows(spark):
    assert remove_repeats(none(spark)).count() == 0


def test_only_short_texts(spark):
    check(docs(spark, ["a", "a", ""]), list(enumerate(["a", "a", ""])))
