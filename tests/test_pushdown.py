"""Key lookups on a stored cell table reach the parquet scan."""

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidemark.operators.cells import get_row, get_rows, latest_cells, range_scan
from tidemark.sources.cells import cells_from_events, read_cells, write_cells


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_point_and_range_lookups_push_down(spark, tmp_root):
    src = cells_from_events(spark, SF_SMALL)
    write_cells(src, f"{tmp_root}/cells", files=4)
    cells = read_cells(spark, f"{tmp_root}/cells")
    row = get_row(cells, "u5")
    plan = _plan(row)
    assert "PushedFilters: [IsNotNull(rowkey), EqualTo(rowkey,u5)]" in plan
    assert row.count() == latest_cells(src.filter("rowkey = 'u5'")).count() > 0
    rng = range_scan(cells, "u1", "u2")
    assert "GreaterThanOrEqual(rowkey,u1)" in _plan(rng) and "LessThan(rowkey,u2)" in _plan(rng)
    rows = get_rows(cells, ["u5", "u1"])
    assert "GreaterThanOrEqual(rowkey,u1), LessThanOrEqual(rowkey,u5)" in _plan(rows)
    # column pruning: a two-column projection reads two columns
    narrow = cells.filter(F.col("rowkey") == "u5").select("rowkey", "ts")
    assert "ReadSchema: struct<rowkey:string,ts:bigint>" in _plan(narrow)
