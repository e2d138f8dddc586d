import pytest
from pyspark.sql import functions as F

from tidemark.functions import (ALPHABETS, bytes_to_long, counter_key, decode_offsets, encode_offsets,
                                from_utf8, long_to_bytes, long_to_hex, random_code, region_of, salted_key,
                                to_utf8, unsalt)

MIN_LONG = -(2 ** 63)
MAX_LONG = 2 ** 63 - 1


def test_long_to_bytes_fixed_values(spark):
    df = spark.createDataFrame([(300,), (-2,), (MIN_LONG,)], "n bigint")
    got = [r[0] for r in df.select(long_to_hex("n")).collect()]
    assert got == ["000000000000012C", "FFFFFFFFFFFFFFFE", "8000000000000000"]
    raw = df.select(long_to_bytes("n").alias("b")).collect()
    assert [len(r.b) for r in raw] == [8, 8, 8]
    assert bytes(raw[0].b) == (300).to_bytes(8, "big")


def test_bytes_long_roundtrip(spark):
    vals = [0, 1, -1, 300, -2, MIN_LONG, MAX_LONG, 123456789012345, -987654321098765, 255, 256]
    df = spark.createDataFrame([(v,) for v in vals], "n bigint")
    got = [r[0] for r in df.select(bytes_to_long(long_to_bytes("n"))).collect()]
    assert got == vals


def test_text_in_counter_cell_not_decoded(spark):
    df = spark.createDataFrame([("100",)], "s string")
    r = df.select(bytes_to_long(to_utf8("s")).alias("v"), from_utf8(to_utf8("s")).alias("t")).first()
    assert r.v is None  # never 3223600
    assert r.t == "100"


def test_region_of(spark):
    df = spark.createDataFrame([("0x",), ("1x",), ("A",), ("Fz",), ("a",)], "k string")
    assert [r[0] for r in df.select(region_of("k")).collect()] == [0, 1, 10, 15, 15]


def test_salted_key_deterministic_and_spread(spark):
    df = spark.range(3000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("k"))
    a = df.select(salted_key("k").alias("s"))
    b = df.select(salted_key("k").alias("s"))
    assert a.exceptAll(b).count() == 0
    assert df.select(unsalt(salted_key("k")).alias("k")).exceptAll(df).count() == 0
    prefixes = {r[0] for r in a.select(F.substring("s", 1, 1)).distinct().collect()}
    assert prefixes == set(ALPHABETS["HBASE_CHAR"])
    per = a.groupBy(region_of("s").alias("r")).count().collect()
    counts = [r["count"] for r in per]
    assert len(counts) == 15 and min(counts) > 3000 / 15 * 0.6


def test_random_code(spark):
    df = spark.range(500).select(random_code(12, "NUMBER_CHAR", seed=1).alias("c"),
                                 random_code(6).alias("d"))
    rows = df.collect()
    assert all(len(r.c) == 12 and r.c.isdigit() for r in rows)
    assert all(len(r.d) == 6 and set(r.d) <= set(ALPHABETS["ALL_CHAR"]) for r in rows)
    assert len({r.c for r in rows}) > 490
    # positions draw independently
    assert len({r.c[0] for r in rows}) == 10 and len({r.c[5] for r in rows}) == 10


def test_counter_key(spark):
    df = spark.createDataFrame([("20171122", 1, "baidu")], "d string, c int, s string")
    r = df.select(counter_key("d", "c").alias("a"), counter_key("d", "s", "c").alias("b")).first()
    assert (r.a, r.b) == ("20171122_1", "20171122_baidu_1")


def test_encode_offsets_sorted_by_partition(spark):
    df = spark.createDataFrame([("t", 1, 15), ("t", 0, 12)], "topic string, partition int, until_offset bigint")
    assert encode_offsets(df, ["topic"]).first()["offsets"] == "0:12,1:15"


def test_decode_roundtrip(spark):
    df = spark.createDataFrame([("t", "0:12,1:15,7:900000000000")], "topic string, offsets string")
    got = sorted((r.partition, r.offset) for r in decode_offsets(df, keep=["topic"]).collect())
    assert got == [(0, 12), (1, 15), (7, 900000000000)]
    enc = encode_offsets(decode_offsets(df, keep=["topic"]), ["topic"], offset="offset")
    assert enc.first()["offsets"] == "0:12,1:15,7:900000000000"


@pytest.mark.parametrize("bad", ["0", ""])
def test_decode_malformed_raises(spark, bad):
    df = spark.createDataFrame([(bad,)], "offsets string")
    with pytest.raises(Exception):
        decode_offsets(df).collect()


def test_random_code_no_collisions(spark):
    df = spark.range(200_000).select(random_code(10, seed=3).alias("c"))
    assert df.distinct().count() == 200_000
