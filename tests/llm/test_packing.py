import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm.cases import ROWS, docs, none, odd
from tidemark.llm.packing import pack, plan_best_fit

WORDS = public_tokenizers.path("word_bpe_49k.json")


def check_slots(slots, counts, capacity):
    ranks, used = defaultdict(list), defaultdict(list)
    for length, rank, number, sequence, offset in slots:
        assert number > 0
        for k in range(number):
            ranks[length].append(rank + k)
            used[sequence + k].append((offset, length))
    assert {n: sorted(r) for n, r in ranks.items()} == {n: list(range(c)) for n, c in counts.items()}
    for places in used.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(used)


def best_fit(counts, capacity):
    """Best-fit decreasing, one item after the other."""
    rooms = []
    for length in sorted((n for n, c in counts.items() for _ in range(c)), reverse=True):
        fits = [k for k, room in enumerate(rooms) if room >= length]
        if fits:
            k = min(fits, key=lambda k: rooms[k])
            rooms[k] -= length
        else:
            rooms.append(capacity - length)
    return len(rooms)


@settings(deadline=None, max_examples=80)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 30), max_size=15))
def test_plan_is_best_fit(counts):
    assert check_slots(plan_best_fit(counts, 40), counts, 40) == best_fit(counts, 40)


def test_plan_is_small_for_many_documents():
    counts = {n: 10 ** 9 + n for n in range(1, 4097)}
    assert len(plan_best_fit(counts, 4096)) < 60_000


def brute(pairs, capacity):
    t = Tokenizer.from_file(WORDS)
    out = []
    for i, text in pairs:
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        out += [(i, k // capacity, k, len(ids[k:k + capacity]), zlib.crc32(ids[k:k + capacity].tobytes()))
                for k in range(0, len(ids), capacity)]
    return sorted(out, key=str)


def check(df, pairs, capacity):
    got = df.collect()
    assert df.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=str) == brute(pairs, capacity)
    places = defaultdict(list)
    for r in got:
        places[r.sequence_id].append((r.offset, r.length))
    for p in places.values():
        at = 0
        for offset, length in sorted(p):
            assert offset == at
            at += length
        assert at <= capacity
    counts = defaultdict(int)
    for r in got:
        counts[r.length] += 1
    assert len(places) == best_fit(counts, capacity)


def test_odd_rows(spark):
    check(pack(odd(spark), WORDS, "space_free", capacity=64), ROWS, 64)


def test_many_of_one_length_over_partitions(spark):
    r = random.Random(3)
    texts = ["same words here"] * 300 + [" ".join(r.choice(["a", "the", "Word's", "9x"]) for _ in range(r.randrange(90)))
                                         for _ in range(200)]
    check(pack(docs(spark, texts).repartition(9), WORDS, "space_free", capacity=50), list(enumerate(texts)), 50)


def test_no_rows(spark):
    assert pack(none(spark), WORDS, "space_free").count() == 0
