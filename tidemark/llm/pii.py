"""Format-preserving pseudonyms for personal numbers and dates.

Values are found by a pattern and validated (Luhn, mod 97, octets, calendar).
A validated value is a number below the size of its format's domain; a keyed
Feistel permutation of that domain gives another valid value of the same
format. Equal values get equal pseudonyms in every document, and the holder of
the key can invert them.
"""

from __future__ import annotations

import bisect
import datetime
import hashlib
import re
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .common import arrow_rows, id_type, slices, text_of

ROUNDS = 10
KINDS = ("email", "card", "iban", "ssn", "phone", "ip", "date")

FIRST_DAY = datetime.date(1900, 1, 1).toordinal()
LAST_DAY = datetime.date(2099, 12, 31).toordinal()

#: Phones: a country code and 3-3-4 digits; an area code in parentheses; a
#: country code and other groups, 8 to 15 digits in all (7 with a one-digit area
#: code in parentheses); 3-3-4 digits, also behind a 1.
PHONES = (r"\+\d{1,3}[ .-]?\(?\d{3}\)?[ .-]?\d{3}[ .-]?\d{4}(?!\d)|(?<![\d+])\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)"
          r"|\+[1-9]\d{0,2} ?\(\d{1,4}\)(?:[ ./-]?\d){5,8}(?!\d)|\+[1-9](?:[ ./-]?\d){7,14}(?!\d)"
          r"|(?<![\d+])(?<!\d[.-])(?:1[ .-])?\d{3}[ .-]\d{3}[ .-]\d{4}(?!\d)(?![.-]\d)")
PHONE = re.compile(PHONES, re.ASCII)
#: Country codes of one and two digits; all others have three.
SHORT_CODES = {"1", "7", *"20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64"
               " 65 66 81 82 84 86 90 91 92 93 94 95 98".split()}

#: Numbers and dates; which alternative matched tells the kind. The lookahead
#: passes over other characters quickly. A card is only begun here: its digits
#: are among the groups of the RUN that starts there.
PATTERN = re.compile(
    r"(?=[\d+(]|[A-Z]{2}\d)(?:"
    r"(?P<iban>\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b)"
    r"|(?P<date>(?<![\d./-])(?:\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}|\d{1,2}/\d{1,2}/\d{4}|\d{1,2}\.\d{1,2}\.\d{4})(?![\d/-]))"
    r"|(?P<ssn>(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-]))"
    r"|(?P<ip>(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\.?\d))"
    r"|(?P<card>(?<![\d-])(?=\d(?:[ -]?\d){12})\d+)"
    rf"|(?P<phone>{PHONES}))",
    re.ASCII)
RUN = re.compile(r"\d+(?:[ -]\d+)*", re.ASCII)
GROUP = re.compile(r"\d+", re.ASCII)
#: Groups that cards are written in; tried before other groups of a run.
CARD_SHAPES = {(4, 4, 4, 4), (4, 6, 5), (4, 6, 4)}
#: Rounds in search of a pseudonym that is read back as the same value, divided
#: by the square of the number of values in the run of digits.
WALKS = 200
EMAIL = re.compile(r"(?P<email>[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,})", re.ASCII)
#: Characters before an @ within which an address begins.
LOCAL_PART = 64


def _round(key: bytes, tweak: bytes, size: int, number: int, value: int) -> int:
    data = b"%b|%d|%d|%d" % (tweak, size, number, value)
    wide = 16 + size.bit_length() // 8
    digest = hashlib.shake_256(len(key).to_bytes(4, "big") + key + data).digest(wide)
    return int.from_bytes(digest, "big")


def permute(value: int, size: int, key: bytes, tweak: bytes, back: bool = False) -> int:
    """A keyed permutation of 0..size-1: a Feistel network over the smallest
    a x b rectangle that holds the domain, walked until it is back in it."""
    if size < 2:
        return value
    a = isqrt(size - 1) + 1
    b = -(-size // a)
    while True:
        left, right = divmod(value, b)
        for k in reversed(range(ROUNDS)) if back else range(ROUNDS):
            sign = -1 if back else 1
            if k % 2:
                right = (right + sign * _round(key, tweak, size, k, left)) % b
            else:
                left = (left + sign * _round(key, tweak, size, k, right)) % a
        value = left * b + right
        if value < size:
            return value


def luhn_digit(payload: str) -> str:
    total = 0
    for i, c in enumerate(reversed(payload)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 * (d > 9)
    return str(-total % 10)


def _into(shape: str, digits: str) -> str:
    """The digits in the places that the shape has digits in."""
    it = iter(digits)
    return "".join(next(it) if c.isdigit() else c for c in shape)


def _digits(text: str) -> str:
    return re.sub(r"\D", "", text)


def _mixed(text: str, move) -> str:
    """Letters and digits of a text as one number, each place in its class."""
    value, size, places = 0, 1, []
    for c in text:
        base = 10 if "0" <= c <= "9" else 26 if "a" <= c <= "z" or "A" <= c <= "Z" else 0
        first = "0" if base == 10 else "a" if c >= "a" else "A"
        if base:
            value, size = value * base + ord(c) - ord(first), size * base
        places.append((c, base, first))
    value, out = move(value, size), []
    for c, base, first in reversed(places):
        if base:
            value, d = divmod(value, base)
            c = chr(ord(first) + d)
        out.append(c)
    return "".join(reversed(out))


def _iban_check(country: str, rest: str) -> str:
    number = "".join(str(int(c, 36)) for c in rest + country + "00")
    return f"{98 - int(number) % 97:02d}"


def _order(sep: str, first: int) -> str:
    """Under a slash the month comes first unless it could not be one."""
    return "month" if sep == "/" and first <= 12 else "day"


def _date(text: str, move) -> str | None:
    """Dates move among the days that are written in the same shape: padded
    forms among all days (slashes: those with the same part first), forms
    with one-digit parts among days with parts of the same widths."""
    sep = re.search(r"\D", text)[0]
    parts = text.split(sep)
    one, two, three = map(int, parts)
    if len(parts[0]) == 4:
        shape, year, month, day = "year", one, two, three
    else:
        shape, year = _order(sep, one), three
        month, day = (one, two) if shape == "month" else (two, one)
    try:
        at = datetime.date(year, month, day).toordinal()
    except ValueError:
        return None
    if not FIRST_DAY <= at <= LAST_DAY:
        return None
    widths = (len(parts[0]), len(parts[1]))
    days = _days(sep, shape, widths)
    new = days[move(bisect.bisect_left(days, at), len(days))]
    return _written(new, sep, shape, widths)


def _written(day: int, sep: str, shape: str, widths: tuple[int, int]) -> str:
    d = datetime.date.fromordinal(day)
    if shape == "year":
        return f"{d.year:04d}{sep}{d.month:02d}{sep}{d.day:02d}"
    one, two = (d.month, d.day) if shape == "month" else (d.day, d.month)
    return f"{one:0{widths[0]}d}{sep}{two:0{widths[1]}d}{sep}{d.year:04d}"


@lru_cache(64)
def _days(sep: str, shape: str, widths: tuple[int, int]) -> Sequence[int]:
    """The days that this shape can write and that are read back from it."""
    days = range(FIRST_DAY, LAST_DAY + 1)
    if shape == "year" or sep != "/" and widths == (2, 2):
        return days

    def fits(n: int) -> bool:
        one, two, _ = _written(n, sep, shape, widths).split(sep)
        return (len(one), len(two)) == widths and _order(sep, int(one)) == shape

    return [n for n in days if fits(n)]


def pseudonym(kind: str, text: str, key: bytes, back: bool = False) -> str | None:
    """The value's pseudonym (``back``: its original); None if not valid."""
    tweak = {"email": f"email:{len(text)}", "iban": f"iban:{text[:2]}:{len(text) - text.count(' ')}"}.get(kind, kind).encode()
    move = lambda value, size: permute(value, size, key, tweak, back)
    if kind == "email":
        local, domain = text.split("@")
        return f"{_mixed(local, move)}@{domain}"
    if kind == "date":
        return _date(text, move)
    if kind == "ip":
        octets = [int(p) for p in text.split(".")]
        if max(octets) > 255 or any(len(p) > 1 and p[0] == "0" for p in text.split(".")):
            return None
        new = move(int.from_bytes(bytes(octets), "big"), 1 << 32)
        return ".".join(map(str, new.to_bytes(4, "big")))
    if kind == "iban":
        plain = text.replace(" ", "")
        country, rest = plain[:2], plain[4:]
        if not 15 <= len(plain) <= 34 or plain[2:4] != _iban_check(country, rest):
            return None
        rest = _mixed(rest, move)
        new = iter(country + _iban_check(country, rest) + rest)
        return "".join(c if c == " " else next(new) for c in text)
    digits = _digits(text)
    if kind == "card":
        if not _is_card(digits):
            return None
        n = len(digits) - 1
        new = f"{move(int(digits[:-1]), 10 ** n):0{n}d}"
        return _into(text, new + luhn_digit(new))
    if kind == "ssn":
        area, group, serial = (int(p) for p in text.split("-"))
        if area in (0, 666) or area > 899 or not group or not serial:
            return None
        areas = [n for n in range(1, 900) if n != 666]
        at = (areas.index(area) * 99 + group - 1) * 9999 + serial - 1
        at, serial = divmod(move(at, len(areas) * 99 * 9999), 9999)
        area, group = divmod(at, 99)
        return f"{areas[area]:03d}-{group + 1:02d}-{serial + 1:04d}"
    code = len(digits) - 10  # phone: the country code stays
    if text[0] == "+":
        code = next((n for n in (1, 2) if digits[:n] in SHORT_CODES), 3)
    n = len(digits) - code
    return _into(text, digits[:code] + f"{move(int(digits[code:]), 10 ** n):0{n}d}")


def _is_card(digits: str) -> bool:
    return luhn_digit(digits[:-1]) == digits[-1]


def _cards(text: str, start: int, end: int, mistyped: tuple[int, int]) -> list[tuple[int, int]]:
    """The cards in a run of digit groups: all 13 to 19 digits between group
    borders are tried, in the usual shapes first, then from the left, longer
    ones first. 17 or 18 digits that are all of an IBAN behind wrong check
    digits are no card."""
    groups, tries = [m.span() for m in GROUP.finditer(text, start, end)], []
    for i in range(len(groups)):
        shape = ()
        for j in range(i, len(groups)):
            shape += (groups[j][1] - groups[j][0],)
            if sum(shape) > 19:
                break
            if sum(shape) >= 13 and not (groups[j][1] == end and text[end:end + 1] == "-"):
                if sum(shape) not in (17, 18) or (groups[i][0], groups[j][1]) != mistyped:
                    tries.append((len(shape) > 1 and shape not in CARD_SHAPES, i, -j))
    taken, used = [], set()
    for _, i, j in sorted(tries):
        some = range(i, 1 - j)
        if used.isdisjoint(some) and _is_card(_digits(text[groups[i][0]:groups[-j][1]])):
            used.update(some)
            taken.append((groups[i][0], groups[-j][1]))
    return sorted(taken)


def _ibans(m: re.Match, key: bytes, back: bool) -> int | None:
    """Where the IBAN that starts a match ends: at its end or a space in it."""
    end = m.end()
    while end > m.start():
        if _cached("iban", m.string[m.start():end], key, back) is not None:
            return end
        end = m.string.rfind(" ", m.start(), end)
    return None


def _values(text: str, key: bytes, back: bool, at: int = 0) -> list[tuple[str, int, int, tuple[int, int] | None]]:
    """Kind, start and end of the valid values, and the range in which other
    places were tried for it (None: it could only be this one)."""
    found, cards, run, around, failed = [], [], (0, 0), (0, 0), (0, 0, 0)
    while True:
        m = PATTERN.search(text, at)
        if cards and (m is None or m.start() >= cards[0][0] or m.lastgroup != "card" and m.end() > cards[0][0]):
            start, at = cards.pop(0)
            shape = tuple(len(g) for g in GROUP.findall(text, start, at))
            alone = (start, at) == run and (len(shape) == 1 or shape in CARD_SHAPES)
            found.append(("card", start, at, None if alone and around == run else around))
            continue
        if m is None:
            return found
        kind, start, end = m.lastgroup, m.start(), m.end()
        if kind == "card":
            if start >= run[1]:
                run = RUN.match(text, start).span()
                around = (failed[0] if start < failed[2] else start, run[1])
                cards = _cards(text, *run, failed[1:])
                if cards and cards[0][0] == start:
                    continue
            phone = PHONE.match(text, start)
            if phone and not (cards and phone.end() > cards[0][0]):
                found.append(("phone", start, phone.end(), around))
                end = phone.end()
            at = end  # other values may begin at the next group
        elif kind == "iban":
            here = _ibans(m, key, back)
            if here is not None:
                found.append((kind, start, here, None if here == end else (start, end)))
            # else values may begin behind the first group
            space = text.find(" ", start, end)
            at = here if here is not None else end if space < 0 else space
            if here is None:
                failed = (failed[0] if start < failed[2] else start, at + 1, end)
        else:
            if _cached(kind, text[start:end], key, back) is not None:
                found.append((kind, start, end, around if start < run[1] else None))
            at = end


def _change_numbers(text: str, key: bytes, back: bool, counts: dict[str, int] | None) -> str:
    """Values whose place was chosen among several take the next pseudonyms
    of their cycle until the new text is read as the same values."""
    out, done, at, found = [], 0, 0, _values(text, key, back)
    while at < len(found):
        around, n = found[at][3], 1
        while around is not None and at + n < len(found) and found[at + n][3] == around:
            n += 1
        some, at = found[at:at + n], at + n
        if counts is not None:
            for kind, *_ in some:
                counts[kind] += 1
        low, high = some[0][1], some[-1][2]
        if around is not None:
            low, high = min(low, around[0]), max(high, around[1])
            high = min(high, found[at][1]) if at < len(found) else high
        low = max(low, done)
        values, first = [text[s:e] for _, s, e, _ in some], None
        for _ in range(max(1, WALKS // n ** 2)):
            values = [_cached(v[0], old, key, back) for v, old in zip(some, values)]
            body, want, k = text[max(low - 1, done):low], [], low
            start = len(body)
            for (kind, s, e, _), new in zip(some, values):
                body += text[k:s]
                want.append((kind, len(body), len(body) + len(new)))
                body, k = body + new, e
            body += text[k:high]
            first = first or body[start:]
            if around is None or [v[:3] for v in _values(body + text[high:high + 40], key, back, start)
                                  if v[1] < len(body)] == want:
                first = body[start:]
                break
        out += [text[done:low], first]
        done = high
    out.append(text[done:])
    return "".join(out)


def pseudonymise(text: str, key: bytes, counts: dict[str, int] | None = None, back: bool = False) -> str:
    """Values that stand alone have one pseudonym everywhere. One whose place
    among neighbouring digits or capitals is read from its check digits may
    have another there, so that it can be inverted; where ``WALKS`` rounds
    find none, it has its usual one and inversion may fail."""
    def change(m: re.Match) -> str:
        if counts is not None:
            counts["email"] += 1
        return _cached("email", m[0], key, back)

    done, out, at = 0, [], text.find("@")
    while at >= 0:  # addresses are rare: look only around each @
        m = EMAIL.search(text, max(done, at - LOCAL_PART))
        if m is None:
            break
        if m.end() > at:
            out += [_change_numbers(text[done:m.start()], key, back, counts), change(m)]
            done = m.end()
        at = text.find("@", max(at + 1, done))
    out.append(_change_numbers(text[done:], key, back, counts))
    return "".join(out)


_cached = lru_cache(100_000)(pseudonym)
#: Texts without any of these cannot match.
_MAYBE = re.compile(r"[0-9@]")


def pseudonymise_documents(docs: DataFrame, key: bytes, back: bool = False, id_col: str = "doc_id",
                           text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, text (null stays null) and the
    number of values replaced, in all (n_values) and of each kind (n_<kind>).

    Values that fail validation stay as they are. Rows are independent, so
    there is no shuffle; ids may be null or repeated; other columns are not
    read; an empty frame gives no rows.
    """
    kind_of_id = id_type(docs, id_col)
    counted = ["n_values", *(f"n_{k}" for k in KINDS)]
    schema = T.StructType([T.StructField("doc_id", kind_of_id), T.StructField("text", T.StringType()),
                           *(T.StructField(n, T.IntegerType()) for n in counted)])
    id_arrow = to_arrow_type(kind_of_id)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = [pa.field("doc_id", id_arrow), pa.field("text", pa.string()),
                  *(pa.field(n, pa.int32()) for n in counted)]
        for batch in slices(batches, "text"):
            out = {f.name: [] for f in fields}
            for text in batch.column("text").to_pylist():
                counts = dict.fromkeys(KINDS, 0)
                if text and _MAYBE.search(text):
                    text = pseudonymise(text, key, counts, back)
                out["text"].append(text)
                out["n_values"].append(sum(counts.values()))
                for k, n in counts.items():
                    out[f"n_{k}"].append(n)
            out["doc_id"] = batch.column("doc_id").to_pylist()
            yield arrow_rows(fields, out)

    return (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, schema))
