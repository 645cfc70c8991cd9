"""Time without a zone, as microseconds and epoch seconds.

The difference of two zone-less timestamps does not depend on the session time zone.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def micros(ts: str) -> Column:
    since = f"cast(cast({ts} - {_EPOCH} as interval second) as decimal(20, 6))"
    return F.expr(f"cast({since} * 1000000 as bigint)")


def epoch_seconds(ts: str) -> Column:
    return micros(ts) / F.lit(1e6)


def from_epoch_seconds(seconds: str) -> Column:
    return F.expr(f"timestampadd(MICROSECOND, cast(round({seconds} * 1e6) as bigint), {_EPOCH})")


def elapsed_seconds(ts: str, as_of: str) -> Column:
    """Whole seconds from ``ts`` to ``as_of``."""
    return F.expr(f"cast(cast({as_of} - {ts} as interval second) as decimal(20, 6))").cast("bigint")
