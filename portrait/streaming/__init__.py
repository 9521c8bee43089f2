"""Incremental daily runs.

The reference has no stream processing: freshness comes from re-running a
daily job for a ``stat_date`` and overwriting that partition.  This package
drives exactly that with Structured Streaming's file source, so newly landed
date partitions are picked up (and only they are recomputed)."""
