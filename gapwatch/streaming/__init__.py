from gapwatch.streaming.hourly import hourly_summary, stream_feed
from gapwatch.streaming.incremental import BlockStore, merge_stream, merged_blocks

__all__ = ["BlockStore", "hourly_summary", "merge_stream", "merged_blocks", "stream_feed"]
