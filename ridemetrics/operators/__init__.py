from ridemetrics.operators.fill import fill_ordered, forward_fill
from ridemetrics.operators.frames import dense_index, order_rows, rolling_sum, tumbling_day
from ridemetrics.operators.ranges import range_sum
from ridemetrics.operators.scan import totals_ahead
from ridemetrics.operators.storage import new_folder, scratch, store, write_result
from ridemetrics.operators.topk import bottom_rows, top_rows

__all__ = [
    "bottom_rows",
    "dense_index",
    "fill_ordered",
    "forward_fill",
    "new_folder",
    "order_rows",
    "range_sum",
    "rolling_sum",
    "scratch",
    "store",
    "top_rows",
    "totals_ahead",
    "tumbling_day",
    "write_result",
]
