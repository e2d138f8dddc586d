from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Keys that a scan compares one by one in a term (longer IN lists reach the
#: Parquet reader as their span only), and terms of a key list's filter.
TERM_KEYS = 10
KEY_TERMS = 128


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def key_list_frame(spark: SparkSession, keys: list, key: str = "rowkey") -> DataFrame:
    """(pos, key) rows for a driver-side key list. It is a local relation, whose
    size the planner knows: joins broadcast it below the session's threshold
    and sort-merge it above, without a hint."""
    if any(k is None for k in keys):
        raise ValueError("null row key in key list")
    return spark.createDataFrame(pa.table({"pos": pa.array(range(len(keys)), pa.int32()),
                                           key: pa.array(keys, pa.string())}))


def key_terms(keys: list[str], key: str = "rowkey") -> Column:
    """A filter that no asked key fails, for the scan: the sorted keys in runs,
    each run as a list of a few keys, or as its span where the list is so long
    that ``KEY_TERMS`` runs hold more. Statistics and Bloom filters skip the
    row groups of a key-sorted table that no run meets."""
    size = max(TERM_KEYS, -(-len(keys) // KEY_TERMS))
    runs = [keys[i:i + size] for i in range(0, len(keys), size)]
    terms = [F.col(key).isin(run) if size == TERM_KEYS else F.col(key).between(run[0], run[-1]) for run in runs]
    while len(terms) > 1:  # a balanced tree
        terms = [a | b for a, b in zip(terms[::2], terms[1::2])] + terms[len(terms) & ~1:]
    return terms[0]


def restrict_to_keys(df: DataFrame, keys: list, key: str = "rowkey") -> DataFrame:
    """Cut ``df`` to the rows of the asked keys before any other work. The
    keys' span and their terms are filters that reach the scan of a key-sorted
    table; a semi-join with the key frame does the rest. One plan for key
    lists of every length."""
    asked = sorted(set(keys))
    if not asked:
        return df.limit(0)
    kdf = df.sparkSession.createDataFrame(pa.table({key: pa.array(asked, pa.string())}))
    span = (F.col(key) >= F.lit(asked[0])) & (F.col(key) <= F.lit(asked[-1]))
    return df.filter(span & key_terms(asked, key)).join(kdf, key, "left_semi")


def epoch_millis(ts) -> Column:
    """Epoch milliseconds of a TIMESTAMP_NTZ, floored, with no session time
    zone involved: days since epoch plus the wall-clock time of day."""
    t = col_of(ts)
    sec = F.extract(F.lit("SECOND"), t)  # seconds with microsecond fraction
    return (F.unix_date(t.cast("date")).cast("bigint") * 86_400_000
            + F.hour(t).cast("bigint") * 3_600_000 + F.minute(t).cast("bigint") * 60_000
            + F.floor(sec * 1000).cast("bigint")).cast("bigint")


def wall_time(ts) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` of a TIMESTAMP_NTZ (time-zone free)."""
    return F.substring(col_of(ts).cast("string"), 1, 19)


def day_string(ts) -> Column:
    """``yyyyMMdd`` of a TIMESTAMP_NTZ / DATE (time-zone free: built from the
    date's fields, no cast through the session time zone)."""
    d = col_of(ts).cast("date")
    return F.format_string("%04d%02d%02d", F.year(d), F.month(d), F.dayofmonth(d))
