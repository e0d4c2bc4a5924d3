"""slotwise: interval-reading analytics, column profiling and per-batch word
counts expressed as Spark DataFrame / SQL / Structured Streaming plans."""

__version__ = "0.1.0"
