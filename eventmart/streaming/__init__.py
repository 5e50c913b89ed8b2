"""Following raw logs as they arrive."""

from eventmart.streaming.arrivals import follow_raw_logs

__all__ = ["follow_raw_logs"]
