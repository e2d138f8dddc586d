"""Removal of byte strings that repeat in the corpus, by suffix sorting.

A byte is removed if a string of ``LENGTH`` bytes that covers it starts
anywhere else too. The strings ("windows") are suffixes cut at that length;
two are equal when they stand side by side in the sorted suffix array with a
common prefix of the whole length. Suffixes are sorted deep-shallow: multikey
quicksort on 8-byte words down to a shallow depth, then blind tries for the
groups that still share a long prefix.

Sorting all suffixes of a corpus is not needed, so windows are screened first,
without loss. A window's *anchor* is the least hash among its ``GRAM``-byte
grams (the last of equals), so equal windows have equal anchors at equal
places. Neighbouring windows with one anchor form a *block*. Three exchanges
of packed arrays follow, each between segments of text and hash buckets:

1. every segment sends its distinct (anchor, block) hashes once. An anchor
   that occurs once rules out its windows; a block that occurs twice settles
   all of its windows;
2. blocks that share an anchor but not the whole block send their bytes to the
   anchor's bucket, where their windows are sorted. Equal windows meet there.
   An anchor with very many different blocks would crowd its bucket: such
   blocks send a digest per window instead, distinct ones once per segment,
   dealt by the digest itself;
3. the buckets answer with the windows found, and segments remove the bytes.

Segments are written to the shared folder once, so numbers within a segment
mean the same in every step, also when a task is run again elsewhere.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .common import arrow_rows, id_type, slices, stored, text_of

LENGTH = 200
#: Bytes of the grams that anchors are chosen from; a power of two plus one.
GRAM = 80
SEGMENT_BYTES = 4 << 20
#: Text bytes for which there is one bucket.
BUCKET_BYTES = 16 << 20
#: Window starts that are hashed together (their arrays stay in the cache).
CHUNK = 1 << 17
#: Blocks of one anchor in a segment, and in all, from which they send digests.
CROWDED_IN_SEGMENT = 16
CROWDED = 4096
#: Bytes that multikey quicksort compares before blind tries take over.
SHALLOW = 32

UNIQUE, WHOLE, SORTED, SENT, DIGESTED = 0, 1, 2, 3, 4


def _random_words(seed: int, count: int) -> np.ndarray:
    """Fixed pseudo-random 64-bit words (SplitMix64)."""
    with np.errstate(over="ignore"):
        z = np.uint64(seed) + np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


BYTE_WORDS = _random_words(1, 256)
STEP_WORDS = _random_words(2, 16) | np.uint64(1)
DIGEST_WORDS = _random_words(3, LENGTH // 8) | np.uint64(1)
MIX = np.uint64(0xFF51AFD7ED558CCD)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x * MIX
    x ^= x >> np.uint64(32)
    x *= STEP_WORDS[15]
    return x


def _hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the GRAM-byte and of the LENGTH-byte string at each place,
    by doubling: a string's hash comes from those of its two halves."""
    h, by_size, size, k = BYTE_WORDS[data], {}, 1, 0
    while size <= LENGTH:
        by_size[size] = h
        if 2 * size > LENGTH or len(h) <= size:
            break
        h = h[:-size] * STEP_WORDS[k] + h[size:]
        size, k = 2 * size, k + 1

    def joined(length: int) -> np.ndarray:
        out, at = None, 0
        for bit in reversed(range(length.bit_length())):
            if length >> bit & 1:
                part = by_size[1 << bit]
                n = len(data) - length + 1
                out = part[at:at + n].copy() if out is None else out * STEP_WORDS[8 + bit % 7] + part[at:at + n]
                at += 1 << bit
        return out

    return joined(GRAM), joined(LENGTH)


def _least_places(grams: np.ndarray, width: int) -> np.ndarray:
    """For each run of ``width`` grams the place of the least, the last of equals."""
    low = np.uint64((1 << 20) - 1)
    value = (_mixed(grams) & ~low) | (low - np.arange(len(grams), dtype=np.uint64))
    size = 1
    while 2 * size <= width:
        value = np.minimum(value[:-size], value[size:])
        size *= 2
    value = np.minimum(value[:len(grams) - width + 1], value[width - size:])
    return (low - (value & low)).astype(np.int64)


def blocks_of(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> dict[str, np.ndarray]:
    """Blocks of a segment whose documents lie at [begins, ends): anchor hash,
    block hash, lo and hi (first and last window start), at (anchor's place)."""
    found = {k: [] for k in ("anchor", "block", "lo", "hi", "at")}
    n = len(data)
    usable = np.zeros(n + 1, np.int32)
    long_enough = ends - begins >= LENGTH
    np.add.at(usable, begins[long_enough], 1)
    np.add.at(usable, ends[long_enough] - LENGTH + 1, -1)
    usable = np.cumsum(usable[:n]) > 0
    firsts = np.zeros(n, bool)
    firsts[begins[begins < n]] = True
    for c in range(0, max(n - LENGTH + 1, 0), CHUNK):
        part = data[c:c + CHUNK + LENGTH - 1]
        grams, windows = _hashes(part)
        at = _least_places(grams, LENGTH - GRAM + 1)
        ok = usable[c:c + len(at)]
        if not ok.any():
            continue
        new = np.r_[True, at[1:] != at[:-1]] | firsts[c:c + len(at)] | np.r_[True, ~ok[:-1]]
        lo = np.flatnonzero(new & ok)
        stop = np.flatnonzero((np.r_[new[1:], True] | np.r_[~ok[1:], True]) & ok)
        total = np.r_[np.uint64(0), np.cumsum(_mixed(windows))]
        found["anchor"].append(grams[at[lo]])
        found["block"].append(total[stop + 1] - total[lo])
        found["lo"].append(lo + c)
        found["hi"].append(stop + c)
        found["at"].append(at[lo] + c)
    return {k: np.concatenate(v) if v else np.zeros(0, np.uint64 if k in ("anchor", "block") else np.int64)
            for k, v in found.items()}


def distinct_blocks(blocks: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """The segment's distinct (anchor, block) in order: their hashes, times,
    a sample block of each, each block's number, and whether the segment has
    many blocks with that anchor."""
    order = np.lexsort((blocks["block"], blocks["anchor"]))
    a, h = blocks["anchor"][order], blocks["block"][order]
    first = np.r_[True, (a[1:] != a[:-1]) | (h[1:] != h[:-1])] if len(a) else np.zeros(0, bool)
    number = np.empty(len(a), np.int64)
    number[order] = np.cumsum(first) - 1
    starts = np.flatnonzero(first)
    a, h = a[starts], h[starts]
    group = np.cumsum(np.r_[True, a[1:] != a[:-1]]) - 1 if len(a) else np.zeros(0, np.int64)
    return {"anchor": a, "block": h, "times": np.diff(np.r_[starts, len(order)]), "sample": order[starts],
            "number": number, "group": group, "crowded": np.bincount(group, minlength=0)[group] > CROWDED_IN_SEGMENT}


def word_at(padded: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The eight bytes at each place, as a number that sorts like them."""
    view = np.ndarray((len(padded) - 7,), ">u8", padded, strides=(1,))
    return view[places].astype(np.uint64)


def deep_shallow(data: np.ndarray, starts: np.ndarray, group: np.ndarray, length: int = LENGTH
                 ) -> tuple[np.ndarray, np.ndarray]:
    """Sort the strings of ``length`` bytes (a multiple of 8) at ``starts``
    within ascending ``group``. Returns the order and, for each place in it,
    whether the string equals the one before in its group."""
    padded = np.r_[data, np.zeros(8, np.uint8)]
    order = np.argsort(group, kind="stable")
    same = np.zeros(len(order), bool)
    slots, ids = np.arange(len(order)), group[order]

    def split(ids: np.ndarray, slots: np.ndarray, *keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Order each group by the keys; groups are then split by them."""
        turn = np.lexsort((*reversed(keys), ids))
        order[slots] = order[slots][turn]
        moved = [k[turn] for k in keys]
        change = ids[1:] != ids[:-1]
        for k in moved:
            change = change | (k[1:] != k[:-1])
        return np.cumsum(np.r_[True, change]), turn

    def several(ids: np.ndarray) -> np.ndarray:
        edge = np.r_[True, ids[1:] != ids[:-1], True]
        return ~(edge[:-1] & edge[1:])

    keep = several(ids) if len(ids) else np.zeros(0, bool)
    slots, ids = slots[keep], ids[keep]
    for depth in range(0, min(SHALLOW, length), 8):  # multikey quicksort, a word at a time
        if not len(slots):
            return order, same
        ids, _ = split(ids, slots, word_at(padded, starts[order[slots]] + depth))
        keep = several(ids)
        slots, ids = slots[keep], ids[keep]
    if length <= SHALLOW:
        same[slots[1:][ids[1:] == ids[:-1]]] = True
        return order, same

    while len(slots):  # a blind trie for each group: branch at the common prefix with its middle string
        edge = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
        sizes = np.diff(np.r_[edge, len(ids)])
        own = starts[order[slots]]
        pivot = np.repeat(own[edge + sizes // 2], sizes)
        common = np.full(len(own), length)
        side, branch = np.ones(len(own), np.int64), np.zeros(len(own), np.int64)
        open_ = np.arange(len(own))
        for depth in range(SHALLOW, length, 8):
            x, y = word_at(padded, own[open_] + depth), word_at(padded, pivot[open_] + depth)
            apart = x != y
            if apart.any():
                who = open_[apart]
                bits = (x[apart] ^ y[apart])
                byte = np.zeros(len(who), np.int64)
                for k in range(1, 8):
                    byte += (bits >> np.uint64(64 - 8 * k) == 0)
                common[who] = depth + byte
                side[who] = np.where(x[apart] < y[apart], 0, 2)
                branch[who] = padded[own[who] + depth + byte]
                open_ = open_[~apart]
                if not len(open_):
                    break
        # Smaller strings stand before: those that part earlier first; larger ones the other way round.
        place = np.where(side == 0, common, np.where(side == 2, length - common, 0))
        ids, turn = split(ids, slots, side, place, branch)
        equal = side[turn] == 1
        same[slots[1:][equal[1:] & (ids[1:] == ids[:-1])]] = True
        keep = several(ids) & ~equal
        slots, ids = slots[keep], ids[keep]
    return order, same


# --- segments ---------------------------------------------------------------

def _write_segments(id_arrow: pa.DataType):
    fields = [pa.field("seg", pa.int64()), pa.field("n_bytes", pa.int64()), pa.field("doc_ids", pa.list_(id_arrow)),
              pa.field("sizes", pa.list_(pa.int64())), pa.field("data", pa.binary())]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        pack = zstandard.ZstdCompressor(level=3).compress
        first, number = TaskContext.get().partitionId() << 32, 0
        ids, texts, held = [], [], 0

        def close() -> pa.RecordBatch:
            return arrow_rows(fields, {"seg": [first + number], "n_bytes": [held], "doc_ids": [ids],
                                       "sizes": [[len(t) for t in texts]], "data": [pack(b"".join(texts))]})

        for batch in slices(batches, "text", SEGMENT_BYTES):
            rows = zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(),
                       strict=True)
            for doc_id, text in rows:
                if ids and held + len(text) > SEGMENT_BYTES:
                    yield close()
                    number += 1
                    ids, texts, held = [], [], 0
                ids.append(doc_id)
                texts.append(text)
                held += len(text)
        if ids:
            yield close()

    return run


def _opened(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(row["data"], max_output_size=max(row["n_bytes"], 1))
    ends = np.cumsum(np.array(row["sizes"], np.int64))
    return np.frombuffer(raw, np.uint8), ends - np.array(row["sizes"], np.int64), ends


RECORDS = "bucket long, seg long, kind int, payload binary"
ANSWERS = "seg long, kind int, payload binary"
RECORD_FIELDS = [pa.field("bucket", pa.int64()), pa.field("seg", pa.int64()), pa.field("kind", pa.int32()),
                 pa.field("payload", pa.binary())]
ANSWER_FIELDS = RECORD_FIELDS[1:]

ASK = np.dtype([("anchor", "<u8"), ("block", "<u8"), ("number", "<u4"), ("times", "u1")])
TOLD = np.dtype([("number", "<u4"), ("what", "u1")])
BYTES = np.dtype([("anchor", "<u8"), ("number", "<u4"), ("left", "<u2"), ("size", "<u2"), ("answer", "u1")])
DIGEST = np.dtype([("one", "<u8"), ("two", "<u8"), ("number", "<u4"), ("times", "u1")])
RUN = np.dtype([("number", "<u4"), ("first", "<u2"), ("last", "<u2")])
MANY = 255


def _dealt(seg: int, kind: int, rows: np.ndarray, hashed: np.ndarray, buckets: int, blob=None) -> Iterator[dict]:
    """One record for each bucket that gets rows."""
    bucket = ((hashed >> np.uint64(16)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    edges = np.flatnonzero(np.r_[True, bucket[order][1:] != bucket[order][:-1], True]) if len(order) else [0]
    for a, b in zip(edges, edges[1:], strict=False):
        own = order[a:b]
        payload = rows[own].tobytes()
        if blob is not None:
            payload = len(own).to_bytes(4, "little") + payload + b"".join(blob[i] for i in own.tolist())
        yield {"bucket": int(bucket[own[0]]), "seg": seg, "kind": kind, "payload": payload}


def _batch(fields: list[pa.Field], rows: list[dict]) -> pa.Table:
    return pa.Table.from_arrays([pa.array([r[f.name] for r in rows], f.type) for f in fields],
                                schema=pa.schema(fields))


def _ask(buckets: int):
    """Exchange 1: a segment's distinct blocks. Of a crowded anchor one row."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                own = distinct_blocks(blocks_of(*_opened(row)))
                rows = np.zeros(len(own["anchor"]), ASK)
                rows["anchor"], rows["block"] = own["anchor"], own["block"]
                rows["number"] = np.arange(len(rows))
                rows["times"] = np.where(own["crowded"], MANY, np.minimum(own["times"], 2))
                if len(rows):
                    rows = rows[~own["crowded"] | np.r_[True, own["group"][1:] != own["group"][:-1]]]
                records = list(_dealt(row["seg"], 0, rows, _mixed(rows["anchor"].copy()), buckets))
                for x in range(0, len(records), 10_000):
                    yield from _batch(RECORD_FIELDS, records[x:x + 10_000]).to_batches()

    return run


def _tell(table: pa.Table) -> pa.Table:
    """What becomes of each block that one bucket was asked about."""
    segs = np.array(table.column("seg"))
    parts = [np.frombuffer(p, ASK) for p in table.column("payload").to_pylist()]
    rows, seg = np.concatenate(parts), np.repeat(segs, [len(p) for p in parts])
    order = np.lexsort((seg, rows["block"], rows["anchor"]))
    rows, seg = rows[order], seg[order]
    a, h, times = rows["anchor"], rows["block"], rows["times"].astype(np.int64)
    new_a = np.r_[True, a[1:] != a[:-1]]
    new_h = new_a | np.r_[True, h[1:] != h[:-1]]
    ga, gh = np.cumsum(new_a) - 1, np.cumsum(new_h) - 1
    in_a, in_h = np.bincount(ga, times)[ga], np.bincount(gh, times)[gh]
    kinds = np.bincount(ga, new_h)[ga]
    crowded = (np.bincount(ga, times == MANY)[ga] > 0) | (kinds > CROWDED)
    what = np.where(in_a < 2, UNIQUE, np.where(crowded, DIGESTED, np.where(
        in_h < 2, SORTED, np.where((kinds > 1) & new_h, SENT, WHOLE))))
    answers = []
    told = np.zeros(len(rows), TOLD)
    told["number"], told["what"] = rows["number"], what
    shared = np.flatnonzero(what != UNIQUE)
    shared = shared[np.argsort(seg[shared], kind="stable")]
    edges = np.flatnonzero(np.r_[True, seg[shared][1:] != seg[shared][:-1], True]) if len(shared) else [0]
    for x, y in zip(edges, edges[1:], strict=False):
        answers.append({"seg": int(seg[shared[x]]), "kind": 0, "payload": told[shared[x:y]].tobytes()})
    return _batch(ANSWER_FIELDS, answers)


def _payloads(answers: pa.Table, kind: int, dtype: np.dtype) -> np.ndarray:
    rows = [np.frombuffer(p, dtype) for k, p in zip(answers.column("kind").to_pylist(),
                                                    answers.column("payload").to_pylist(), strict=True) if k == kind]
    return np.concatenate(rows) if rows else np.zeros(0, dtype)


class _Segment:
    """A segment with what exchange 1 told about its blocks."""

    def __init__(self, row: dict, answers: pa.Table):
        self.row = row
        self.data, self.begins, self.ends = _opened(row)
        self.blocks = blocks_of(self.data, self.begins, self.ends)
        self.own = own = distinct_blocks(self.blocks)
        told = _payloads(answers, 0, TOLD)
        self.what = np.zeros(len(own["anchor"]), np.uint8)
        self.what[told["number"]] = told["what"]
        if len(self.what):  # one answer speaks for all blocks of a crowded anchor
            self.what[(np.bincount(own["group"], self.what == DIGESTED)[own["group"]] > 0)] = DIGESTED

    def digests(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Windows of blocks whose anchor is crowded: start and both digests."""
        chosen = self.own["sample"][self.what == DIGESTED]
        lo, hi = self.blocks["lo"][chosen], self.blocks["hi"][chosen]
        starts = np.repeat(lo, hi - lo + 1) + _counted(hi - lo + 1)
        padded = np.r_[self.data, np.zeros(8, np.uint8)]
        one, two = np.zeros(len(starts), np.uint64), np.zeros(len(starts), np.uint64)
        for k in range(LENGTH // 8):
            word = word_at(padded, starts + 8 * k)
            one = _mixed(one + word * DIGEST_WORDS[k])
            two = _mixed((two ^ word) * DIGEST_WORDS[-1 - k])
        return starts, one, two

    def distinct_digests(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct digests with their times, and each window's start and number."""
        starts, one, two = self.digests()
        order = np.lexsort((two, one))
        a, b = one[order], two[order]
        first = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])] if len(a) else np.zeros(0, bool)
        at = np.flatnonzero(first)
        rows = np.zeros(len(at), DIGEST)
        rows["one"], rows["two"], rows["number"] = a[at], b[at], np.arange(len(at))
        rows["times"] = np.minimum(np.diff(np.r_[at, len(order)]), 2)
        return rows, starts[order], np.cumsum(first) - 1


def _counted(sizes: np.ndarray) -> np.ndarray:
    """0, 1, .. for each size, one after the other."""
    if not len(sizes):
        return np.zeros(0, np.int64)
    ends = np.cumsum(sizes)
    return np.arange(ends[-1]) - np.repeat(ends - sizes, sizes)


def _send(buckets: int):
    """Exchange 2: bytes of undecided blocks, digests where anchors are crowded."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        records = []
        if left.num_rows and right.num_rows:
            s = _Segment(left.to_pylist()[0], right)
            sent = np.flatnonzero((s.what == SORTED) | (s.what == SENT))
            chosen = s.own["sample"][sent]
            lo, hi, at = (s.blocks[k][chosen] for k in ("lo", "hi", "at"))
            rows = np.zeros(len(sent), BYTES)
            rows["anchor"], rows["number"], rows["left"] = s.own["anchor"][sent], sent, at - lo
            rows["size"], rows["answer"] = hi - lo + LENGTH, s.what[sent] == SORTED
            raw = s.data.tobytes()
            blob = [raw[x:y + LENGTH] for x, y in zip(lo.tolist(), hi.tolist(), strict=True)]
            seg = s.row["seg"]
            records += _dealt(seg, 0, rows, _mixed(rows["anchor"].copy()), buckets, blob)
            digests, _, _ = s.distinct_digests()
            records += _dealt(seg, 1, digests, digests["one"].copy(), buckets)
        return _batch(RECORD_FIELDS, records)

    return run


def _find(table: pa.Table) -> pa.Table:
    """Windows that repeat, among the blocks and digests of one bucket."""
    kinds, segs = np.array(table.column("kind")), np.array(table.column("seg"))
    payloads = table.column("payload").to_pylist()
    answers: list[dict] = []
    heads, blobs, seg = [], [], []
    for k in np.flatnonzero(kinds == 0).tolist():
        n = int.from_bytes(payloads[k][:4], "little")
        heads.append(np.frombuffer(payloads[k], BYTES, n, 4))
        blobs.append(np.frombuffer(payloads[k], np.uint8, offset=4 + n * BYTES.itemsize))
        seg += [segs[k]] * n
    if heads:
        rows, data, seg = np.concatenate(heads), np.concatenate(blobs), np.array(seg)
        size = rows["size"].astype(np.int64)
        windows = size - LENGTH + 1
        owner = np.repeat(np.arange(len(rows)), windows)
        offset = _counted(windows)
        starts = (np.cumsum(size) - size)[owner] + offset
        before = rows["left"][owner].astype(np.int64) - offset  # the anchor's place in the window
        key = np.lexsort((before, rows["anchor"][owner]))
        a, b = rows["anchor"][owner][key], before[key]
        group = np.empty(len(key), np.int64)
        group[key] = np.cumsum(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
        order, same = deep_shallow(data, starts, group)
        repeated = np.zeros(len(order), bool)
        repeated[order] = same | np.r_[same[1:], False]
        hit = np.flatnonzero(repeated & (rows["answer"][owner] == 1))
        if len(hit):  # runs of neighbouring windows
            new = np.r_[True, (owner[hit][1:] != owner[hit][:-1]) | (hit[1:] != hit[:-1] + 1)]
            x, y = hit[new], hit[np.r_[new[1:], True]]
            runs = np.zeros(len(x), RUN)
            runs["number"], runs["first"], runs["last"] = rows["number"][owner[x]], offset[x], offset[y]
            answers += _answered(seg[owner[x]], 1, runs)
    some = np.flatnonzero(kinds == 1).tolist()
    if some:
        parts = [np.frombuffer(payloads[k], DIGEST) for k in some]
        rows, seg = np.concatenate(parts), np.repeat(segs[some], [len(p) for p in parts])
        order = np.lexsort((rows["two"], rows["one"]))
        a, b = rows["one"][order], rows["two"][order]
        group = np.cumsum(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])]) - 1
        often = np.bincount(group, rows["times"][order])[group] >= 2
        answers += _answered(seg[order[often]], 2, rows["number"][order[often]])
    return _batch(ANSWER_FIELDS, answers)


def _answered(seg: np.ndarray, kind: int, rows: np.ndarray) -> Iterator[dict]:
    order = np.argsort(seg, kind="stable")
    edges = np.flatnonzero(np.r_[True, seg[order][1:] != seg[order][:-1], True]) if len(order) else [0]
    for a, b in zip(edges, edges[1:], strict=False):
        yield {"seg": int(seg[order[a]]), "kind": kind, "payload": rows[order[a:b]].tobytes()}


def _remove(id_arrow: pa.DataType, with_kept: bool):
    """Exchange 3's end: cut the bytes out of a segment's documents."""
    fields = [pa.field("doc_id", id_arrow), pa.field("n_bytes", pa.int64()), pa.field("n_removed", pa.int64()),
              pa.field("n_spans", pa.int64()), pa.field("kept_sha256", pa.string()),
              *([pa.field("kept", pa.binary())] if with_kept else [])]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {f.name: [] for f in fields}
        if left.num_rows:
            s = _Segment(left.to_pylist()[0], right)
            blocks, own = s.blocks, s.own
            change = np.zeros(len(s.data) + 1, np.int64)
            whole = (s.what == WHOLE) | (s.what == SENT) | (own["times"] > 1)
            every = whole[own["number"]] if len(own["number"]) else np.zeros(0, bool)
            np.add.at(change, blocks["lo"][every], 1)
            np.add.at(change, blocks["hi"][every] + LENGTH, -1)
            runs = _payloads(right, 1, RUN)
            lo = blocks["lo"][own["sample"][runs["number"]]] if len(runs) else np.zeros(0, np.int64)
            np.add.at(change, lo + runs["first"], 1)
            np.add.at(change, lo + runs["last"] + LENGTH, -1)
            if (s.what == DIGESTED).any():
                digests, starts, number = s.distinct_digests()
                often = digests["times"] > 1
                often[_payloads(right, 2, np.dtype("<u4"))] = True
                hit = starts[often[number]]
                np.add.at(change, hit, 1)
                np.add.at(change, hit + LENGTH, -1)
            gone = np.cumsum(change[:-1]) > 0
            kept_at = np.r_[0, np.cumsum(~gone)]
            kept = s.data[~gone].tobytes()
            spans = gone & ~np.r_[False, gone[:-1]]
            spans[s.begins[s.begins < len(gone)]] = gone[s.begins[s.begins < len(gone)]]
            spans = np.r_[0, np.cumsum(spans)]
            a, b = s.begins, s.ends
            out["doc_id"] = s.row["doc_ids"]
            out["n_bytes"] = (b - a).tolist()
            out["n_removed"] = (b - a - kept_at[b] + kept_at[a]).tolist()
            out["n_spans"] = (spans[b] - spans[a]).tolist()
            texts = [kept[x:y] for x, y in zip(kept_at[a].tolist(), kept_at[b].tolist(), strict=True)]
            out["kept_sha256"] = [hashlib.sha256(t).hexdigest() for t in texts]
            if with_kept:
                out["kept"] = texts
        return pa.Table.from_arrays([pa.array(out[f.name], f.type) for f in fields], schema=pa.schema(fields))

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_kept: bool = False
                   ) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans
    (maximal removed runs), kept_sha256 and, if asked for, kept (the bytes
    that stay, which may cut a character in two).

    Texts are UTF-8 bytes; null is empty. Windows do not cross documents, so a
    text shorter than ``LENGTH`` bytes stays whole. Copies, rows repeated with
    one id included, remove each other wholly. Ids may be null; only the id
    and text columns are read; an empty frame gives no rows.
    """
    kind = id_type(docs, id_col)
    id_arrow = to_arrow_type(kind)
    schema = T.StructType([T.StructField("seg", T.LongType()), T.StructField("n_bytes", T.LongType()),
                           T.StructField("doc_ids", T.ArrayType(kind)),
                           T.StructField("sizes", T.ArrayType(T.LongType())), T.StructField("data", T.BinaryType())])
    texts = docs.select(F.col(id_col).alias("doc_id"), text_of(docs, text_col).alias("text"))
    segments = stored(texts.mapInArrow(_write_segments(id_arrow), schema), "repeat-segments")
    total = segments.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    buckets = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // BUCKET_BYTES))

    asked = segments.mapInArrow(_ask(buckets), RECORDS)
    told = stored(asked.groupBy("bucket").applyInArrow(_tell, ANSWERS), "repeat-told")
    sent = segments.groupBy("seg").cogroup(told.groupBy("seg")).applyInArrow(_send(buckets), RECORDS)
    found = stored(sent.groupBy("bucket").applyInArrow(_find, ANSWERS), "repeat-found")
    out = T.StructType([T.StructField("doc_id", kind), T.StructField("n_bytes", T.LongType()),
                        T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType()),
                        T.StructField("kept_sha256", T.StringType()),
                        *([T.StructField("kept", T.BinaryType())] if with_kept else [])])
    answers = told.unionByName(found)
    return segments.groupBy("seg").cogroup(answers.groupBy("seg")).applyInArrow(_remove(id_arrow, with_kept), out)
