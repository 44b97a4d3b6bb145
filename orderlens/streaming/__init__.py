from orderlens.streaming.events import hourly_counts, read_hourly_counts, stream_hourly_counts
from orderlens.streaming.incremental import incremental_refresh
from orderlens.streaming.refresh import stream_refresh

__all__ = ["hourly_counts", "incremental_refresh", "read_hourly_counts", "stream_hourly_counts", "stream_refresh"]
