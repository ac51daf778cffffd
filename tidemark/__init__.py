"""Snapshot parsing, cleaning, rollups and idempotent loads as PySpark DataFrame transformations."""
