"""tidemark: click counting, resumable topic processing and sorted cell-table
lookups, written as DataFrame / Structured Streaming jobs on Spark."""

__version__ = "0.1.0"

from tidemark.operators.cells import (BucketedCellTable, CellTable, cell_versions, delete_rows,  # noqa: E402
                                      filter_scan, first_cell_row, first_row, format_cells, get_row,
                                      get_rows, latest_cells, page_rows, range_scan, scan_cells)
from tidemark.operators.counters import (CounterStore, clicks_per_day_category,  # noqa: E402
                                         clicks_per_day_search_category, lookup_counters, merge_increments)
from tidemark.operators.offsets import (OffsetLog, add_new_partitions, clamp_to_earliest,  # noqa: E402
                                        latest_offsets, offset_ranges, resume_assign, resume_from_positions,
                                        resume_subscribe)
from tidemark.operators.paging import Pager, page_first, page_next, page_summary, paginate  # noqa: E402
from tidemark.operators.snapshots import SnapshotStore  # noqa: E402
from tidemark.streaming.topic_stream import TopicJob, stop_on_marker, write_file_topic  # noqa: E402

__all__ = [
    "BucketedCellTable", "CellTable", "CounterStore", "OffsetLog", "Pager", "SnapshotStore", "TopicJob",
    "add_new_partitions", "cell_versions", "clamp_to_earliest", "clicks_per_day_category",
    "clicks_per_day_search_category", "delete_rows", "filter_scan", "first_cell_row", "first_row",
    "format_cells", "get_row", "get_rows", "latest_cells", "latest_offsets", "lookup_counters",
    "merge_increments", "offset_ranges", "page_first", "page_next", "page_rows", "page_summary", "paginate",
    "range_scan", "resume_assign", "resume_from_positions", "resume_subscribe", "scan_cells",
    "stop_on_marker", "write_file_topic",
]
