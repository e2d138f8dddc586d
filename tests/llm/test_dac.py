import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm.cases import ROWS, none, odd
from tidemark.llm import dac
from tidemark.llm.dac import decode_levels, encode_levels, read_documents, token_in, tokens_at, write_tokens
from tidemark.llm.encoding import CachedEncoder
from tidemark.session import scratch_dir

BYTES = public_tokenizers.path("byte_bpe_50k.json")
KINDS = {BYTES: "space_led", public_tokenizers.path("word_bpe_49k.json"): "space_free"}


@settings(deadline=None, max_examples=60)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2 ** 32 - 1)), max_size=1500))
def test_codes_round_trip(ids):
    levels = encode_levels(np.array(ids, np.uint32))
    assert decode_levels(levels).tolist() == ids
    assert [token_in(levels, i) for i in range(0, len(ids), 7)] == ids[::7]


TRICKY = ["", " ", "a", " a", "a ", "a  b", "a\nb", "a \nb", "a\n\nb", "x\ty", "it's they'll 'tis 's", "é é", "a b",
          "a\x1cb", "<|endoftext|>", "say <|endoftext|> now", "12 345 6-7", "MIXED Case ǅ ΣΑΣ σ", "東京 は 日本",
          "é café ́x", "a\r\nb", "﻿bom", "\U0001f600 smile \U0001f600", "a​b", "tab\t\ttab"]


@pytest.mark.parametrize("path", KINDS)
def test_cached_encoding_is_the_librarys(path):
    plain, cached = Tokenizer.from_file(path), CachedEncoder(path, KINDS[path])
    import duckdb
    texts = [r[0] for r in duckdb.sql("SELECT text FROM '/root/testdata/sf0.001/documents.parquet'").fetchall()]
    for some in (TRICKY, texts, TRICKY[::-1]):
        want = [plain.encode(t, add_special_tokens=False).ids for t in some]
        assert [a.tolist() for a in cached.encode(some)] == want


@settings(deadline=None, max_examples=150)
@given(st.text(st.sampled_from("ab Z'st\n\t 9.,!é́Σ\x1c <|>"), max_size=30))
def test_cached_encoding_of_any_text(text):
    for path, kind in KINDS.items():
        e = _ENCODERS.setdefault(path, CachedEncoder(path, kind))
        assert e.encode([text])[0].tolist() == e._encode(text)


_ENCODERS: dict = {}


def whole(pairs):
    t, start, out = Tokenizer.from_file(BYTES), 0, []
    for i, text in pairs:
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        out.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(dac, "SEGMENT_TOKENS", 500)
    path = scratch_dir(spark, "dac-test")
    write_tokens(odd(spark), path, BYTES, "space_led", partitions=3)
    got = sorted(map(tuple, read_documents(spark, path).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == sorted((i for i, _ in ROWS), key=lambda i: (i is not None, i or 0))
    assert [r[1] for r in got] == [0, *np.cumsum([r[2] for r in got])[:-1].tolist()]
    key = lambda r: (r[0] is not None, r[0] or 0, r[2], r[3])
    assert sorted([(r[0], 0, *r[2:]) for r in got], key=key) == sorted([(r[0], 0, *r[2:]) for r in whole(ROWS)], key=key)


def test_whole_table_and_random_access(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    path = scratch_dir(spark, "dac-test")
    write_tokens(docs, path, BYTES, "space_led")
    want = whole(docs.orderBy("doc_id").select("doc_id", "text").collect())
    assert sorted(map(tuple, read_documents(spark, path).collect())) == want
    t = Tokenizer.from_file(BYTES)
    ids = [x for r in docs.orderBy("doc_id").collect() for x in [*t.encode(r.text, add_special_tokens=False).ids, 0]]
    asked = [0, 1, 17, 17, len(ids) // 2, len(ids) - 1, len(ids), -3, None]
    got = tokens_at(spark, path, spark.createDataFrame([(p,) for p in asked], "position long"))
    assert sorted(map(tuple, got.collect())) == [(p, ids[p]) for p in sorted({0, 1, 17, len(ids) // 2, len(ids) - 1})]


def test_no_rows(spark):
    path = scratch_dir(spark, "dac-test")
    write_tokens(none(spark), path, BYTES, "space_led")
    assert read_documents(spark, path).count() == 0
