from lakestrata.streaming.incremental import raw_stream, standardize_stream

__all__ = ["raw_stream", "standardize_stream"]
