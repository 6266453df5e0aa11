"""Time buckets. The session time zone is UTC."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Bucket name to the length of one bucket.
BUCKETS = {"day": "1 day", "week": "7 days", "month": "1 month", "quarter": "3 months"}


def _known(bucket: str) -> None:
    if bucket not in BUCKETS:
        raise ValueError(f"bucket must be one of: {', '.join(BUCKETS)}")


def bucket_start(ts: Column, bucket: str) -> Column:
    """Start of the UTC day, Monday week, month or quarter."""
    _known(bucket)
    return F.date_trunc(bucket, ts)


def bucket_end(start: Column, bucket: str) -> Column:
    """First moment after the bucket."""
    _known(bucket)
    return start + F.expr(f"interval {BUCKETS[bucket]}")


def parse_offset_time(text: Column) -> Column:
    """ISO text with an offset to a point in time; NULL when unreadable."""
    return F.try_to_timestamp(text)
