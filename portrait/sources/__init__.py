"""Scans (daily / ranged / hourly partitions, text files) and sinks."""
