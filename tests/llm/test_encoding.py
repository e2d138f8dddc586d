import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import encoding
from tidemark.llm.encoding import CachedEncoder

FILES = [("byte_bpe_50k.json", "space_led"), ("word_bpe_49k.json", "space_free")]
MADE = {f: (CachedEncoder(public_tokenizers.path(f), k), Tokenizer.from_file(public_tokenizers.path(f))) for f, k in FILES}
TEXT = st.lists(st.sampled_from(["word", "Über", "naïve", "İstanbul", "don't", "a.b", "x,y", ".", ",", "..", "東京", "ab12",
                                 "  ", "\n", "\t", "\x1c", "\0", "été", "ﬁn", "ǅ", "<|endoftext|>", "Ωmega", "слово", "!", "'s"]),
                max_size=12).flatmap(lambda w: st.sampled_from([" ".join(w), "".join(w), "\n".join(w), " ".join(w) + "."]))


@pytest.mark.parametrize("file", [f for f, _ in FILES])
@settings(deadline=None, max_examples=300)
@given(texts=st.lists(TEXT, max_size=4))
def test_ids_are_the_librarys(file, texts):
    cached, plain = MADE[file]
    assert [x.tolist() for x in cached.encode(texts)] == [plain.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("file,kind", FILES)
def test_cache_is_bounded(file, kind, monkeypatch):
    monkeypatch.setattr(encoding, "CACHE_BYTES", 40_000)
    e, plain = CachedEncoder(public_tokenizers.path(file), kind), MADE[file][1]
    for k in range(30):
        texts = [f"the common words and junk{k}x{i} zq{chr(97 + i)}{chr(97 + k % 26)}" for i in range(20)]
        assert [x.tolist() for x in e.encode(texts)] == [plain.encode(t, add_special_tokens=False).ids for t in texts]
        assert e.cache.held <= 20_300 and len(e.cache) + len(e.cache.old) < 40_000 // encoding.PIECE_BYTES + 3


@pytest.mark.parametrize("file,kind", FILES)
def test_new_pieces_are_asked_for_together(file, kind, monkeypatch):
    e, plain = CachedEncoder(public_tokenizers.path(file), kind), MADE[file][1]
    asked, learn = [], e.cache.learn
    monkeypatch.setattr(e.cache, "learn", lambda pieces: asked.append(pieces) or learn(pieces))
    words = [f"{a}{b}{end}" for a in ("Zqua", "été", "İst", "ǅ", "x9") for b in ("bel", "Nor", "ß", "vrk") for end in ("", "!", "'s")]
    texts = [" ".join(words[k:] + words[:k]) for k in range(0, len(words), 7)]
    assert [x.tolist() for x in e.encode(texts)] == [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert len(asked) == 1 and len(asked[0]) <= 2 * len(words)
    assert [x.tolist() for x in e.encode(texts)] == [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert len(asked) == 1


def test_case_of_ascii_takes_no_place_of_its_own():
    file, kind = FILES[1]
    e, plain = CachedEncoder(public_tokenizers.path(file), kind), MADE[file][1]
    texts = ["the Word", "THE wORD", "an <|ENDOFTEXT|> <|endoftext|>", "<|EndOfText|>", "É J̌ ǰ Ḱ Σ ΣΑΣ", "é ǰ ς"]
    assert [x.tolist() for x in e.encode(texts)] == [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert "word" in e.cache and "Word" not in e.cache and "wORD" not in e.cache


@pytest.mark.parametrize("file,kind", FILES)
def test_slice_larger_than_the_cache(file, kind, monkeypatch):
    monkeypatch.setattr(encoding, "CACHE_BYTES", 4_000)
    monkeypatch.setattr(encoding, "ASKED_AT_ONCE", 7)
    e, plain = CachedEncoder(public_tokenizers.path(file), kind), MADE[file][1]
    for _ in range(2):
        texts = [f"some words w{chr(97 + i)}q stay Z{chr(97 + i)} and, {i} go." for i in range(26)]
        assert [x.tolist() for x in e.encode(texts)] == [plain.encode(t, add_special_tokens=False).ids for t in texts]
        assert len(e.cache) + len(e.cache.old) < 4_000 // encoding.PIECE_BYTES + 3 and not e.cache.new


SIGNED = st.lists(st.sampled_from(["word", "Word", "É", "x²", "½", "ª", "naïve", "İ", "Σ", "ʹ", "$$$", "!!", "_", "'", "'s", "`", "\u0338", "\u0301", ".", ",",
                                   "\n", "\t", "\u00a0", "\u2028", "\u0085", "—", "7", "×", " ", " ", "  "]),
                  max_size=14).map("".join)


@pytest.mark.parametrize("file", [f for f, _ in FILES])
@settings(deadline=None, max_examples=600)
@given(texts=st.lists(SIGNED, max_size=4))
def test_ids_with_signs_and_unusual_spaces(file, texts):
    cached, plain = MADE[file]
    assert [x.tolist() for x in cached.encode(texts)] == [plain.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("file,kind", FILES)
def test_words_with_signs_need_no_library(file, kind, monkeypatch):
    """Words after line breaks and words with signs behind them are asked of
    the model alone; texts that are neither are not."""
    e, plain = CachedEncoder(public_tokenizers.path(file), kind), MADE[file][1]
    seen, shown = [], e._shown
    monkeypatch.setattr(e, "_shown", lambda piece: seen.append(piece) or shown(piece))
    texts = ["a Zqword$$$ and\nZqnext line%%% or", "the naïvq!! went_ on\nÉtqé x²"]
    assert [x.tolist() for x in e.encode(texts)] == [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert seen == ["x²"]


def test_pieces_of_white_space_keep_their_place():
    """Normalising a batch together must not shift pieces."""
    file, kind = FILES[1]
    e, plain = CachedEncoder(public_tokenizers.path(file), kind), MADE[file][1]
    texts = ["Éx \t éy\tzq", "vrö\t Bqé  \x1c\tÜ"]
    assert [x.tolist() for x in e.encode(texts)] == [plain.encode(t, add_special_tokens=False).ids for t in texts]


def test_letters_that_normalising_takes_a_mark_off():
    """The mark and a full stop behind it are one pre-token."""
    file, kind = FILES[1]
    e, plain = CachedEncoder(public_tokenizers.path(file), kind), MADE[file][1]
    texts = ["İ.", "word, İ, word", "\u0958.", "été."]
    assert [x.tolist() for x in e.encode(texts)] == [plain.encode(t, add_special_tokens=False).ids for t in texts]
