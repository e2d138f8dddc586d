from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators.paging import Pager, page_first, page_next, page_summary, paginate


def _keys(spark, n, parts=3):
    return spark.range(n).select(F.format_string("k%03d", "id").alias("rowkey")).repartition(parts)


def test_pager_25_rows(spark):
    p = Pager(_keys(spark, 25), page_size=10)
    sizes, flags = [], []
    for _ in range(3):
        sizes.append(p.next().count())
        flags.append(p.has_next)
    assert sizes == [10, 10, 5] and flags == [True, True, False]
    assert p.page_index == 3 and p.first_row == 21 and p.prev_page == 2 and p.next_page == 4
    assert p.query_total_count == 25 and p.page_end_key == "k024"
    assert p.page_count() == 3


def test_pager_exact_fit(spark):
    p = Pager(_keys(spark, 20), page_size=10)
    sizes, flags = [], []
    for _ in range(3):
        sizes.append(p.next().count())
        flags.append(p.has_next)
    assert sizes == [10, 10, 0] and flags == [True, True, False]
    assert p.page_index == 3  # index advances on an empty page


def test_keyset_pages_cover_table(spark):
    df = _keys(spark, 57)
    seen, last = [], None
    while True:
        page = page_first(df, 10) if last is None else page_next(df, last, 10)
        keys = [r.rowkey for r in page.collect()]
        if not keys:
            break
        seen += keys
        last = keys[-1]
    assert seen == sorted(r.rowkey for r in df.collect())


def test_paginate_matches_global_order(spark):
    df = spark.range(1000).select(F.format_string("%x", F.col("id") * 7919 % 1000).alias("rowkey"))
    paged = paginate(df, 30, partitions=7)
    ref = df.withColumn("rn", F.row_number().over(Window.orderBy("rowkey")))
    got = {r.rowkey: (r.row_num, r.page_index) for r in paged.collect()}
    exp = {r.rowkey: (r.rn, (r.rn - 1) // 30 + 1) for r in ref.collect()}
    assert got == exp
    summ = {r.page_index: r for r in page_summary(paged, 30).collect()}
    assert len(summ) == 34
    assert summ[34].rows == 10 and summ[34].total == 1000 and not summ[34].has_next
    assert summ[33].has_next and summ[33].has_next_exact and not summ[34].has_next_exact
    assert summ[1].prev_page == 1 and summ[2].first_row == 31


def test_summary_exact_fit_flags(spark):
    paged = paginate(_keys(spark, 20), 10, partitions=3)
    s = sorted((r.page_index, r.has_next, r.has_next_exact) for r in page_summary(paged, 10).collect())
    assert s == [(1, True, True), (2, True, False)]


def test_pager_by_row_over_cells(spark):
    from tidemark.operators.cells import make_put, scan_cells
    rows = [(f"r{i:02d}", "info", q, f"{i}{q}") for i in range(23) for q in ("a", "b", "c")]
    cells = make_put(spark, rows, ts=1)
    p = Pager(scan_cells(cells, start="r01", stop="r20", predicates=(F.col("qualifier") != "c",)),
              page_size=5, by_row=True)
    pages = []
    while True:
        page = p.next()
        if p.last_rows == 0:
            break
        pages.append(sorted({r.rowkey for r in page.collect()}))
        assert page.count() == 2 * p.last_rows  # two visible cells per row
    assert [len(x) for x in pages] == [5, 5, 5, 4]
    assert pages[0][0] == "r01" and pages[-1][-1] == "r19"
    assert p.query_total_count == 19 and not p.has_next


def test_default_page_sizes(spark):
    df = _keys(spark, 150)
    assert page_first(df).count() == 10  # no page model: 10 rows
    assert page_next(df, "k009").count() == 10
    p = Pager(df)
    assert p.next().count() == 100  # page model default


def test_repeated_keys_number_the_same_rows_each_time(spark):
    df = spark.range(2000).selectExpr("if(id % 3 = 0, 'hot', concat('k', id % 50)) AS rowkey", "id")
    numbers = [sorted((r.id, r.row_num) for r in paginate(df.repartition(n), 100, partitions=8).collect())
               for n in (2, 5)]
    assert numbers[0] == numbers[1] and sorted(n for _, n in numbers[0]) == list(range(1, 2001))
