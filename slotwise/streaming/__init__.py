"""Structured Streaming jobs: per-batch word counts and totals."""

from slotwise.streaming.words import batch_words, process_batch, start_word_counts  # noqa: F401
