"""Snapshot sources: raw landing tables → normalized snapshot rows, and a
Python Data Source that scans a landing folder in id-chunk partitions."""
