"""
all generated values at once, so examples stay cheap."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions import bytes_to_long, decode_offsets, encode_offsets, long_to_bytes
from tidemark.operators.counters import merge_increments
from tidemark.operators.paging import page_first, page_next, paginate

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
longs = st.integers(min_value=-(2 ** 63), max_value=2 ** 63 - 1)


@SETTINGS
@given(st.lists(longs, min_size=1, max_size=200))
def test_long_bytes_roundtrip(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, n bigint")
    got = [r[0] for r in df.orderBy("i").select(bytes_to_long(long_to_bytes("n"))).collect()]
    assert got == values


@SETTINGS
@given(st.dictionaries(st.integers(0, 5000), st.integers(0, 2 ** 62), min_size=1, max_size=60))
def test_offsets_encode_decode(spark, offsets):
    df = spark.createDataFrame([("t", p, o) for p, o in offsets.items()],
                               "topic string, partition int, until_offset bigint")
    enc = encode_offsets(df, ["topic"])
    s = enc.first()["offsets"]
    assert s == ",".join(f"{p}:{offsets[p]}" for p in sorted(offsets))
    back = {r.partition: r.offset for r in decode_offsets(enc, keep=["topic"]).collect()}
    assert back == offsets


@SETTINGS
@given(st.sets(st.text("abcxyz019", min_size=1, max_size=6), min_size=0, max_size=120),
       st.integers(1, 17))
def test_keyset_pages_union_is_table(spark, keys, size):
    df = spark.createDataFrame([(k,) for k in keys], "rowkey string").repartition(3)
    seen, last = [], None
    while True:
        page = page_first(df, size) if last is None else page_next(df, last, size)
        got = [r.rowkey for r in page.collect()]
        assert len(got) <= size
        if not got:
            break
        seen += got
        last = got[-1]
    assert seen == sorted(keys)


@SETTINGS
@given(st.lists(st.text("ab", min_size=1, max_size=4), min_size=1, max_size=150), st.integers(1, 9),
       st.integers(1, 5))
def test_paginate_equals_global_row_number(spark, keys, size, parts):
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "rowkey string, seq int")
    paged = paginate(df, size, partitions=parts, tiebreak=["seq"])
    got = sorted((r.row_num, r.rowkey, r.seq, r.page_index) for r in paged.collect())
    exp = sorted(zip(keys, range(len(keys))))
    assert [(g[1], g[2]) for g in got] == exp
    assert [g[0] for g in got] == list(range(1, len(keys) + 1))
    assert all(g[3] == (g[0] - 1) // size + 1 for g in got)


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c", "d"]), st.integers(0, 1000)), min_size=1, max_size=300))
def test_counter_sum_equals_rows_in(spark, incs):
    df = spark.createDataFrame(incs, "rowkey string, click_count bigint")
    merged = dict(merge_increments(df).collect())
    assert sum(merged.values()) == sum(v for _, v in incs)
    for k in merged:
        assert merged[k] == sum(v for kk, v in incs if kk == k)


def test_row_number_reference(spark):
    # sanity for the comparison used above
    df = spark.createDataFrame([("b",), ("a",)], "rowkey string")
    r = df.withColumn("rn", F.row_number().over(Window.orderBy("rowkey"))).orderBy("rn").collect()
    assert [x.rowkey for x in r] == ["a", "b"]


topic_rows = st.lists(st.tuples(st.integers(0, 4), st.integers(0, 60)), min_size=0, max_size=150, unique=True)
stored_map = st.dictionaries(st.integers(0, 5), st.integers(0, 70), max_size=6)


@SETTINGS
@given(topic_rows, stored_map)
def test_resume_matches_brute_force(spark, recs, stored):
    from tidemark.operators.offsets import resume_assign, resume_subscribe
    rec = spark.createDataFrame([("t", p, o) for p, o in recs], "topic string, partition int, offset bigint")
    st_df = spark.createDataFrame([("t", p, o) for p, o in stored.items()],
                                  "topic string, partition int, offset bigint")
    sub = sorted((r.partition, r.offset) for r in resume_subscribe(rec, st_df).collect())
    assert sub == sorted((p, o) for p, o in recs if p not in stored or o >= stored[p])
    asg = sorted((r.partition, r.offset) for r in resume_assign(rec, st_df).collect())
    assert asg == sorted((p, o) for p, o in recs if p in stored and o >= stored[p])


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 9), st.integers(0, 10 ** 6)), min_size=1, max_size=120))
def test_latest_offsets_match_brute_force(spark, writes):
    from tidemark.operators.offsets import latest_offsets
    # one log row per (partition, batch): the newest batch's until wins
    log = {}
    for p, b, u in writes:
        log[(p, b)] = u
    df = spark.createDataFrame([("g", "t", p, u, b) for (p, b), u in log.items()],
                               "group_id string, topic string, partition int, until_offset bigint, batch_id bigint")
    got = {r.partition: r.offset for r in latest_offsets(df, "g").collect()}
    exp = {}
    for (p, b), u in sorted(log.items()):
        exp[p] = u  # sorted by batch within partition: the last one stays
    assert got == exp


@SETTINGS
@given(topic_rows)
def test_offset_ranges_match_brute_force(spark, recs):
    from tidemark.operators.offsets import offset_ranges
    rec = spark.createDataFrame([("t", p, o) for p, o in recs], "topic string, partition int, offset bigint")
    got = {r.partition: (r.from_offset, r.until_offset, r.record_count) for r in offset_ranges(rec).collect()}
    exp = {}
    for p in {p for p, _ in recs}:
        offs = [o for q, o in recs if q == p]
        exp[p] = (min(offs), max(offs) + 1, len(offs))
    assert got == exp


@SETTINGS
@given(st.sets(st.text("abcdef", min_size=1, max_size=4), min_size=1, max_size=120), st.integers(1, 13),
       st.integers(1, 6))
def test_page_summary_matches_brute_force(spark, keys, size, parts):
    from tidemark.operators.paging import page_summary
    df = spark.createDataFrame([(k,) for k in keys], "rowkey string")
    summ = {r.page_index: r for r in page_summary(paginate(df, size, partitions=parts), size).collect()}
    ordered = sorted(keys)
    pages = [ordered[i:i + size] for i in range(0, len(ordered), size)]
    assert sorted(summ) == list(range(1, len(pages) + 1))
    total = 0
    for i, pg in enumerate(pages, start=1):
        r = summ[i]
        total += len(pg)
        assert (r.start_key, r.end_key, r.rows, r.total) == (pg[0], pg[-1], len(pg), total)
        assert r.first_row == (i - 1) * size + 1 and r.prev_page == max(i - 1, 1) and r.next_page == i + 1
        assert r.has_next == (len(pg) == size) and r.has_next_exact == (i < len(pages))


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(1, 50)), min_size=1, max_size=6),
                min_size=1, max_size=4),
       st.lists(st.integers(0, 3), max_size=3), st.booleans())
def test_counter_store_replays(spark, batches, replays, compact_midway):
    from tidemark.operators.counters import CounterStore
    from tidemark.session import scratch_dir
    st_ = CounterStore(spark, scratch_dir(spark, "prop-counters"), run_id="r")
    order = list(range(len(batches))) + [r for r in replays if r < len(batches)]
    for n, b in enumerate(order):
        st_.add(spark.createDataFrame(batches[b], "rowkey string, click_count bigint"), batch_id=b)
        if compact_midway and n == len(batches) // 2:
            st_.compact()
    exp = {}
    for rows in batches:
        for k, v in rows:
            exp[k] = exp.get(k, 0) + v
    assert dict(st_.read().collect()) == exp
