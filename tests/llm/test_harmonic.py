import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm.cases import ROWS, docs, none, odd
from tidemark.llm.harmonic import cuts, pack_harmonic

WORDS = public_tokenizers.path("word_bpe_49k.json")
COLUMNS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


@given(st.integers(1, 10 ** 6), st.integers(0, 13))
def test_cuts_are_the_fewest_of_reciprocal_lengths(length, k):
    got = cuts(length, 1 << k)
    assert sum(got) == length and got == sorted(got, reverse=True)
    assert all((1 << k) % x == 0 for x in got)
    assert all(n == 1 for x, n in Counter(got).items() if x < 1 << k)


def check(df, pairs, capacity):
    got = df.collect()
    assert df.columns == COLUMNS
    t = Tokenizer.from_file(WORDS)
    want = []
    for i, text in pairs:
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        at = 0
        for n in cuts(len(ids), capacity):
            want.append((i, at, n, zlib.crc32(ids[at:at + n].tobytes()), len(ids)))
            at += n
    assert sorted((tuple(r)[:5] for r in got), key=str) == sorted(want, key=str)
    places = defaultdict(list)
    for r in got:
        places[r.sequence_id].append((r.offset, r.length))
    for p in places.values():
        at = 0
        for offset, length in sorted(p):
            assert offset == at
            at += length
        assert at <= capacity and at & (at - 1) == 0  # no padding at all
        assert len({length for _, length in p}) == 1
    short = [sum(n for _, n in p) for p in places.values() if sum(n for _, n in p) < capacity]
    # of each class, at most one sequence of each power of two is short
    assert len(short) <= (capacity.bit_length()) ** 2
    return places


def test_odd_rows(spark):
    check(pack_harmonic(odd(spark), WORDS, "space_free", capacity=64), ROWS, 64)


def test_many_of_one_length_over_partitions(spark):
    r = random.Random(3)
    texts = ["same words here"] * 300 + [" ".join(r.choice(["a", "the", "Word's", "9x"]) for _ in range(r.randrange(90)))
                                         for _ in range(200)] + [None, ""]
    for parts in (1, 9):
        check(pack_harmonic(docs(spark, texts).repartition(parts), WORDS, "space_free", capacity=32),
              list(enumerate(texts)), 32)


def test_capacity_one(spark):
    texts = ["one two three", ""]
    check(pack_harmonic(docs(spark, texts), WORDS, "space_free", capacity=1), list(enumerate(texts)), 1)


def test_no_rows_and_bad_capacity(spark):
    assert pack_harmonic(none(spark), WORDS, "space_free").count() == 0
    with pytest.raises(ValueError):
        pack_harmonic(none(spark), WORDS, "space_free", capacity=100)
