"""Whole texts to token ids with the ``tokenizers`` library.

Byte-pair merges never cross a pre-token, so a text's ids are its pre-tokens'
ids in a row. ``CachedEncoder`` cuts texts at places that are pre-token
borders for the given kind of tokenizer, looks each distinct piece of a few
texts up once, asks the library for those it does not hold, many in one call,
and joins the pieces' ids; natural text repeats nearly all of its words, so
most pieces are found in the cache. Texts in which the borders are not certain
(runs of white space, unusual spaces, special tokens) go to the library whole.

The cache is bounded in bytes. It has two generations: pieces that are asked
for enter the young one; when that is full it becomes the old one, and what the
old one held and nobody asked for again is gone.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator, Sequence
from itertools import batched, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes that a worker's cache of pieces takes at most: two generations of half of it.
CACHE_BYTES = 160 << 20

#: What a piece takes besides its characters and ids: two object headers, a dict
#: slot at the least load, and the allocator's rounding.
PIECE_BYTES = 190

#: Pieces that the library is asked for in one call.
ASKED_AT_ONCE = 1_000

#: A full stop or comma after a letter or digit begins a pre-token, so words
#: are found in the cache whatever follows them; not after any other sign.
BEFORE_STOP = re.compile(r"[^\x00-\x7F](?=[.,])")

#: White space other than a space or line break.
OTHER_SPACE = re.compile(r"[^\S \n]")

#: Letters below this code point are letters in every Unicode version in use,
#: so that Python and the tokenizer agree on them.
OLD_LETTERS = "\u0530"

#: What a byte of UTF-8 can mean for borders: a space or line break, a space that
#: leaves them uncertain, a full stop or comma, an ASCII sign, a letter or sign
#: beyond ASCII, the beginning of a character that may be a space.
BREAK, OTHER, STOP, SIGN, FOREIGN, DOUBT = 1, 2, 4, 8, 16, 32
_CLASSES = bytes([BREAK * (c in " \n") | OTHER * (c == "\0" or OTHER_SPACE.match(c) is not None)
                  | STOP * (c in ".,") | SIGN * (re.match(r"[\W_]", c) is not None) for c in map(chr, range(128))]
                 + [FOREIGN | DOUBT * (x == 0xC2 or x >= 0xE0) for x in range(128, 256)])

#: A word of letters with ASCII signs behind it, maybe after a line break; no
#: apostrophe, which may make one pre-token with letters.
SIGNS = r"[!-&(-/:-@\[-`{-~]"
WORD = re.compile(rf"(\n?)([^\W\d_]+)({SIGNS}*)")

_ENCODERS: dict[tuple[str, str], CachedEncoder] = {}


class CachedEncoder:
    """``kind`` says where pre-tokens end for certain:

    * ``space_led``: byte-level pre-tokens that take one leading space: before
      a single space or line break between two other characters;
    * ``space_free``: pre-tokens without white space: at each space and line
      break;
    * ``whole``: unknown; every text is encoded whole.
    """

    def __init__(self, path: str, kind: str = "whole"):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import Split

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.kind = kind
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.special = sorted(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        self.cache = _Cache(self._learn)
        self.letters, self.lowers, self.signs = self._letters(), self._lowers(), {}
        if self.letters:
            # the model alone: what is split at spaces are pre-tokens in the byte-level alphabet
            self.model = Tokenizer(self.tokenizer.model)
            self.model.pre_tokenizer = Split(" ", "removed")
        if kind == "space_led":
            self.break_ids = len(self._encode("\n")) * self.dtype.itemsize

    def _encode(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _pieces(self, texts: list[str]) -> list[str | None]:
        """Each text's pieces with a space between them, or None if its borders
        are not certain. In a ``space_led`` piece the leading space is left
        out; a piece that has none begins with a line break or, for stops and
        commas, with NUL."""
        if self.kind == "whole":
            return [None] * len(texts)
        uncertain, signs = self._looks(texts)
        return [None if un else self._cut(text, sign) for text, un, sign in zip(texts, uncertain, signs, strict=True)]

    def _looks(self, texts: list[str]) -> tuple[list[bool], list[bool]]:
        """Of each text: whether its borders are uncertain, and whether a stop
        or comma stands after a sign. Texts are looked at together, and alone
        where their bytes leave it open."""
        led = self.kind == "space_led"
        # what stands between texts is no white space; a space_led text begins behind a sign
        between, raw = b"!" if led else b"a", [text.encode() for text in texts]
        kinds = np.frombuffer((between + between.join(raw)).translate(_CLASSES), np.uint8)
        ends = np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)) + 1)
        before, after = kinds[:-1], kinds[1:]

        def those(places: np.ndarray) -> set[int]:
            return set(np.searchsorted(ends, np.flatnonzero(places) + 1, "right").tolist())

        signs = those((before // SIGN) & (after // STOP) & 1)
        for i in those((before // FOREIGN) & (after // STOP) & 1) - signs:
            if any(map(self._is_sign, set(BEFORE_STOP.findall(texts[i])))):
                signs.add(i)
        uncertain = {i for i, text in enumerate(texts) if any(s in text for s in self.special)}
        if led:
            uncertain |= those((after & OTHER) | (before & after & BREAK))
            uncertain.update(i for i in those(after & DOUBT) if OTHER_SPACE.search(texts[i]))
            uncertain.update(i for i, text in enumerate(texts) if not text or text[0] in " \n" or text[-1] in " \n")
        return [i in uncertain for i in range(len(texts))], [i in signs for i in range(len(texts))]

    def _is_sign(self, char: str) -> bool:
        """Whether a character ends in a sign, or in a mark that normalising
        takes off a letter."""
        if char not in self.signs:
            normal = self.tokenizer.normalizer
            made = normal.normalize_str(char) if normal else char
            self.signs[char] = re.search(r"[\W_]$", made) is not None or not made
        return self.signs[char]

    def _cut(self, text: str, sign: bool) -> str:
        if self.kind == "space_free":
            return (text if sign else text.replace(".", " .").replace(",", " ,")).replace("\n", " ")
        text = "\n" + text
        return (text if sign else text.replace(".", " \0.").replace(",", " \0,")).replace("\n", " \n")[1:]

    def _letters(self) -> dict[int, str] | None:
        """The byte-level alphabet, where a word of letters is one pre-token
        of a byte-pair model, and signs behind it and a line break before it
        are others, so that the model alone can be asked for them. ``marks``
        says which ids begin a piece (``space_led``: a space or line break is
        at the beginning of pieces only) or else end a pre-token (those with
        the model's suffix)."""
        made = json.loads(self.tokenizer.to_str())
        before = made["pre_tokenizer"] or {}
        last = (before.get("pretokenizers") or [before])[-1]
        if made["model"]["type"] != "BPE" or last.get("type") != "ByteLevel" or last["add_prefix_space"]:
            return None
        if self.kind == "whole" or any(re.fullmatch(rf"[^\W\d_]*{SIGNS}*", s) for s in self.special):
            return None
        led, suffix = self.kind == "space_led", made["model"]["end_of_word_suffix"]
        cuts = {" Word$%!": ["\u0120Word", "$%!"], "\nWord": ["\u010a", "Word"]} if led else {"word$%!": ["word", "$%!"]}
        if not (led or suffix) or any([p for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(t)] != c for t, c in cuts.items()):
            return None
        vocab = self.tokenizer.get_vocab(with_added_tokens=False)
        self.marks = np.zeros(max(vocab.values()) + 1, bool)
        self.marks[[i for t, i in vocab.items() if (t[:1] in "\u0120\u010a" if led else t.endswith(suffix))]] = True
        # bytes that can be seen stand for themselves, the others for the characters from 256 on, in order
        seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [x for x in range(256) if x not in seen]
        return {x: chr(x) for x in seen} | {x: chr(256 + i) for i, x in enumerate(rest)}

    def _lowers(self) -> bool:
        """Whether A-Z are lower-cased first, and nothing else is done to words
        of ASCII letters, which are no special tokens either."""
        first = json.loads(self.tokenizer.to_str())["normalizer"] or {}
        steps = first.get("normalizers") or [first]
        space = {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}
        return ({"type": "Lowercase"} in steps and all(s in ({"type": "NFC"}, {"type": "Lowercase"}, space) for s in steps)
                and not any(s.isalpha() for s in self.special))

    def _learn(self, pieces: Sequence[str]) -> list[bytes]:
        """Ids of pieces, in one call of the model alone for all words, at a
        fraction of the time, and one of the library for all others."""
        found = self._words(pieces) if self.letters else {}
        rest = [p for p in pieces if p not in found]
        if rest:
            made = self.tokenizer.encode_batch_fast([self._shown(p) for p in rest], add_special_tokens=False)
            found.update((p, np.array(m.ids, self.dtype).tobytes()) for p, m in zip(rest, made, strict=True))
        return [found[p] for p in pieces]

    def _words(self, pieces: Sequence[str]) -> dict[str, bytes]:
        """Ids of pieces that are words of letters, or such with signs."""
        if self.tokenizer.normalizer:
            pieces = [p for p in pieces if _word(p)]
        led, words, shown, counts = self.kind == "space_led", [], [], []
        for piece, plain in zip(pieces, self._normal(pieces), strict=True):
            word = _word(plain)
            if not word:
                continue
            line, letters, signs = word.groups()
            # bytes of ASCII letters and signs stand for themselves in the byte-level alphabet
            if not letters.isascii():
                letters = letters.encode().decode("latin-1").translate(self.letters)
            if led:
                letters = "\u010a " + letters if line else "\u0120" + letters
            elif line:
                continue
            words.append(piece)
            shown.append(f"{letters} {signs}" if signs else letters)
            counts.append(2 if signs and not led else 1)
        if not words:
            return {}
        ids = np.array(self.model.encode_batch_fast([" ".join(shown)], add_special_tokens=False)[0].ids, self.dtype)
        at = np.flatnonzero(self.marks[ids])
        if len(at) != sum(counts):
            return {}
        edges = [*at.tolist(), len(ids)] if led else [0, *(at[np.cumsum(counts) - 1] + 1).tolist()]
        raw, size = ids.tobytes(), ids.itemsize
        return {w: raw[a * size:b * size] for w, (a, b) in zip(words, pairwise(edges), strict=True)}

    def _normal(self, pieces: Sequence[str]) -> Sequence[str]:
        """Pieces without white space as normalising makes them; an empty one
        is not to be asked of the model alone."""
        if not self.tokenizer.normalizer:
            return pieces
        # words of ASCII letters are in lower case already
        other = [p for p in pieces if not (self.lowers and p.isascii() and p.isalpha())]
        made = self.tokenizer.normalizer.normalize_str(" ".join(other)).split(" ")
        made = iter(made if len(made) == len(other) else [""] * len(other))
        return [p if self.lowers and p.isascii() and p.isalpha() else next(made) for p in pieces]

    def _shown(self, piece: str) -> str:
        """A piece as it stands in the text."""
        if self.kind != "space_led" or piece[:1] == "\n":
            return piece
        return piece[1:] if piece[:1] == "\0" else " " + piece

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, in the encoder's ``dtype``."""
        cut = self._pieces(texts)
        joined = self._joined([pieces for pieces in cut if pieces is not None])
        return [np.array(self._encode(text), self.dtype) if pieces is None else np.frombuffer(next(joined), self.dtype)
                for text, pieces in zip(texts, cut, strict=True)]

    def _joined(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of texts that ``_pieces`` has cut."""
        if not texts:
            return
        lists = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        pieces = lists.values.dictionary_encode()
        distinct = pieces.dictionary.to_numpy(zero_copy_only=False).tolist()
        if self.lowers:
            distinct = [p.lower() if p.isascii() and p.isalpha() else p for p in distinct]
        found = np.empty(len(distinct), object)
        found[:] = self.cache.of(distinct)
        ids = found[pieces.indices.to_numpy()]
        for a, b in pairwise(lists.offsets.to_pylist()):
            joined = b"".join(ids[a:b].tolist())
            yield joined[self.break_ids:] if self.kind == "space_led" else joined


def _word(piece: str) -> re.Match | None:
    word = WORD.fullmatch(piece)
    return word if word and (piece.isascii() or max(piece) < OLD_LETTERS and word[2].isalpha()) else None


class _Cache(dict):
    """Ids of pieces: the young generation is the dict itself; pieces that it
    lacks are taken over from the old one, or learnt."""

    def __init__(self, learn):
        self.learn, self.old, self.held, self.new = learn, {}, 0, {}

    def of(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces; those that no generation has are learnt many at once."""
        out = list(map(self.get, pieces))
        lacking = list(dict.fromkeys(p for p, ids in zip(pieces, out, strict=True) if ids is None))
        self.new = dict(zip(lacking, map(self.old.get, lacking), strict=True))
        for some in batched([p for p, ids in self.new.items() if ids is None], ASKED_AT_ONCE):
            self.new.update(zip(some, self.learn(some), strict=True))
        out = [self.new[p] if ids is None else ids for p, ids in zip(pieces, out, strict=True)]
        self._keep()
        return out

    def _keep(self) -> None:
        """The pieces asked for enter the young generation, together if it has
        room for all of them."""
        # four bytes a character at the most
        sizes = [PIECE_BYTES + len(ids) + (len(p) if p.isascii() else 4 * len(p)) for p, ids in self.new.items()]
        if self.held + sum(sizes) <= CACHE_BYTES // 2:
            self.update(self.new)
            self.held += sum(sizes)
        else:
            for (piece, ids), size in zip(self.new.items(), sizes, strict=True):
                if self.held > CACHE_BYTES // 2:
                    self.old, self.held = dict(self), 0
                    self.clear()
                self[piece] = ids
                self.held += size
        self.new = {}


def encoder(path: str, kind: str) -> CachedEncoder:
    """The worker's encoder for this tokenizer file; kept between tasks."""
    if (path, kind) not in _ENCODERS:
        _ENCODERS[path, kind] = CachedEncoder(path, kind)
    return _ENCODERS[path, kind]
