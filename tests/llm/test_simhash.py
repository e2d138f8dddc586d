import random

import numpy as np
import xxhash

from tests.llm.cases import ROWS, docs, none, odd
from tidemark.llm import simhash
from tidemark.llm.simhash import components, drop_near, fingerprint, linked_fingerprints, near_groups, trie_pairs


def plain(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", words) if w]
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def connected(nodes, bits):
    """Root by comparing all pairs."""
    root = list(range(len(nodes)))
    for i in range(len(nodes)):
        for j in range(i):
            if (nodes[i] ^ nodes[j]).bit_count() <= bits:
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    return root


def brute(pairs, bits=4):
    fps = [plain(t) for _, t in pairs]
    root = connected(fps, bits)
    out = []
    for (i, _), f, r in zip(pairs, fps, root, strict=True):
        ids = [p[0] for p, q in zip(pairs, root, strict=True) if q == r and p[0] is not None]
        out.append((i, f"{f:016x}", min(ids, default=None)))
    return sorted(out, key=str)


def check(df, pairs, bits=4):
    got = near_groups(df, max_bits=bits).select("doc_id", "fingerprint", "component_id")
    assert sorted(map(tuple, got.collect()), key=str) == brute(pairs, bits)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def near_fps(seed, n=400):
    r = random.Random(seed)
    out = {0, (1 << 64) - 1}
    while len(out) < n:
        x = r.choice(sorted(out)) if r.random() < 0.7 else r.getrandbits(64)
        for _ in range(r.randrange(7)):
            x ^= 1 << r.randrange(64)
        out.add(x)
    return sorted(out)


def test_fingerprints():
    import duckdb
    texts = [r[0] for r in duckdb.sql("SELECT text FROM '/root/testdata/sf0.001/documents.parquet' LIMIT 60").fetchall()]
    for t in [*texts, "", " ", "One", "a b c", "a b c d", "a b c d e", "É A\x0bB\x0cC D\xa0e F", "a " * 70_000]:
        assert fingerprint(t.encode()) == plain(t)


def test_trie_links_all_and_only_links():
    for seed in range(4):
        fps = near_fps(seed)
        for bits in (1, 4, 6):
            member, root = trie_pairs(np.zeros(len(fps), int), np.array(fps, np.uint64), 0, bits)
            own = list(range(len(fps)))
            for m, r in zip(member.tolist(), root.tolist(), strict=True):
                own[m] = r
            assert own == connected(fps, bits)


def test_dealt_tries(spark, monkeypatch):
    """The same components however the tries are dealt out, and when crowded
    tops are dealt again."""
    fps = near_fps(9, 500)
    frame = spark.createDataFrame([(signed(x),) for x in fps], "fp long")
    want = connected(fps, 4)
    for most, step in ((20_000, 100_000), (20_000, 50), (3, 100_000)):
        monkeypatch.setattr(simhash, "TOP_MOST", most)
        monkeypatch.setattr(simhash, "ROWS_A_STEP", step)
        stars = {r.node: r.root for r in components(linked_fingerprints(frame, 4)).collect()}
        groups = {}
        for x, r in zip(fps, want, strict=True):
            groups.setdefault(r, set()).add(stars.get(signed(x), signed(x)))
        assert all(len(g) == 1 for g in groups.values())
        assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (7, 7)], "a long, b long")
    assert {r.node: r.root for r in components(edges).collect()} == {**{i: 0 for i in range(1, 61)}, 101: 100}


def test_odd_rows(spark):
    check(odd(spark), ROWS)


def test_corpus(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    check(table, [(r.doc_id, r.text) for r in table.collect()])


def test_one_row_of_each_group_stays(spark):
    df = odd(spark)
    left = drop_near(df)
    assert left.columns == df.columns
    root = connected([plain(t) for _, t in ROWS], 4)
    least = {}
    for (i, _), r in zip(ROWS, root, strict=True):
        least[r] = min((x for x in (i, least.get(r)) if x is not None), default=None)
    assert sorted((r.doc_id for r in left.collect()), key=str) == sorted(least.values(), key=str)


def test_no_rows(spark):
    assert near_groups(none(spark)).count() == 0 and drop_near(docs(spark, ["a"]).limit(0)).count() == 0
