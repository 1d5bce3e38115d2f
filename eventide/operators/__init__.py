from eventide.operators.cdc import fold_changes, live_rows, normalize_changes
from eventide.operators.counting import token_count, word_count
from eventide.operators.filters import filter_rows, live_clicks
from eventide.operators.lateral import SplitDict, explode_json, lateral_split_dict, register_split_dict
from eventide.operators.timeutil import duration_micros, with_event_time
from eventide.operators.topn import rank_counts, running_topn, top_n, topn_json, window_topn
from eventide.operators.windows import (Agg, avg_, count_, hop_agg, max_, min_, session_agg, sum_,
                                        tumble_agg)

__all__ = ["fold_changes", "live_rows", "normalize_changes", "token_count", "word_count", "filter_rows", "live_clicks",
           "SplitDict", "explode_json", "lateral_split_dict", "register_split_dict", "duration_micros", "with_event_time",
           "rank_counts", "running_topn", "top_n", "topn_json", "window_topn", "Agg", "avg_", "count_",
           "hop_agg", "max_", "min_", "session_agg", "sum_", "tumble_agg"]
