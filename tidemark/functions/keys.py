"""Row-key helpers: counter keys (FN-7), random codes (FN-4), key salting
(FN-5) and the region a key falls into on a pre-split table (FN-6)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.sources.common import col_of, day_string

# Fixed values that must equal the reference's: the six code alphabets
# (the mixed one leaves out lower-case l and o) and the key-spreading
# alphabet, whose characters are also the 15 split keys of a 16-region table.
ALPHABETS = {
    "ALL_CHAR": "0123456789abcdefghijkmnpqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "LETTER_CHAR": "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "LOWER_CHAR": "abcdefghijklmnopqrstuvwxyz",
    "NUMBER_CHAR": "0123456789",
    "UPPER_CHAR": "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "HBASE_CHAR": "123456789ABCDEF",
}
SALT_ALPHABET = ALPHABETS["HBASE_CHAR"]
SPLIT_KEYS = list(SALT_ALPHABET)


def day_of(ts) -> Column:
    """``yyyyMMdd`` of a timestamp; time-zone free for TIMESTAMP_NTZ."""
    return day_string(ts)


def counter_key(*parts) -> Column:
    """FN-7: ``day_category`` / ``day_search_category`` keys."""
    return F.concat_ws("_", *[col_of(p).cast("string") for p in parts])


def random_code(length: int, alphabet: str = "ALL_CHAR", seed: int | None = None) -> Column:
    """FN-4: ``length`` characters drawn uniformly, with replacement, from one
    of :data:`ALPHABETS`, fully JVM-side: one random number a row, hashed with
    each position (a transform's lambda can't draw for each element)."""
    chars = ALPHABETS.get(alphabet, alphabet)
    if length <= 0:
        return F.lit("")
    # one uniform draw per row (53 random bits), mixed with the position
    r = F.rand(seed) if seed is not None else F.rand()
    alpha = F.lit(chars)
    n = len(chars)

    def pick(i):
        # xxhash64 of (row draw, position) -> uniform index in [0, n)
        h = F.xxhash64(r, i)
        return F.substring(alpha, (F.pmod(h, F.lit(n)) + 1).cast("int"), 1)

    return F.array_join(F.transform(F.sequence(F.lit(1), F.lit(length)), pick), "")


def salt_prefix(key) -> Column:
    """FN-5: a deterministic one-character prefix from :data:`SALT_ALPHABET`,
    chosen by the first 32 bits of md5(key) so equal keys always land on the
    same prefix and distinct keys spread evenly over the 15 prefixes."""
    h = F.conv(F.substring(F.md5(col_of(key)), 1, 8), 16, 10).cast("bigint")
    return F.substring(F.lit(SALT_ALPHABET), (h % len(SALT_ALPHABET) + 1).cast("int"), 1)


def salted_key(key) -> Column:
    return F.concat(salt_prefix(key), F.lit("_"), col_of(key))


def unsalt(salted) -> Column:
    """The original key of a :func:`salted_key` (everything after the
    one-character prefix and its ``_``)."""
    return F.substr(col_of(salted), F.lit(3))


def region_of(key, split_keys: list[str] | None = None) -> Column:
    """FN-6: index of the region holding ``key`` on a table pre-split at
    ``split_keys`` (sorted): the number of split keys <= key, so region 0
    holds keys below the first split key."""
    splits = F.array(*[F.lit(s) for s in (split_keys or SPLIT_KEYS)])
    k = col_of(key)
    return F.size(F.filter(splits, lambda s: s <= k))
