from clickstream.operators.windows import window_agg, window_count, window_top_n, top_n, floor_div

__all__ = ["window_count", "window_agg", "window_top_n", "top_n", "floor_div"]
