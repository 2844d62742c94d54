"""Event dedup on a stream.

``row_number`` is not allowed on a streaming DataFrame.  Two streaming forms of
the event-identity dedup keep state per event until the event-time
watermark passes it, so state stays bounded:

* ``dedup_stream`` gives the *first* delivery at once
  (``dropDuplicatesWithinWatermark``).  It equals the batch rule (latest
  delivery) where redeliveries are identical copies;
* ``latest_stream`` gives the *latest* delivery, once, when the watermark has
  passed the event: the batch rule for all deliveries that arrive in time.  A later, differing
  redelivery replaces the one held.  It is a streaming aggregate whose
  keys contain the event time, so Spark emits and forgets a group when the watermark passes it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.operators.dedup import EVENT_KEYS, EVENT_RANK


def dedup_stream(
    stream: DataFrame, keys: Sequence[str] = EVENT_KEYS, ts_col: str = "event_ts", delay: str = "1 hour"
) -> DataFrame:
    """Drop redelivered events whose copies arrive within ``delay`` of event time."""
    return stream.withWatermark(ts_col, delay).dropDuplicatesWithinWatermark(list(keys))


def latest_stream(
    stream: DataFrame,
    keys: Sequence[str] = EVENT_KEYS,
    rank: Sequence[str] = EVENT_RANK,
    ts_col: str = "event_ts",
    delay: str = "1 hour",
) -> DataFrame:
    """The delivery of each event that ranks highest among those within ``delay`` of event time (append mode).

    ``keys`` contain ``ts_col``.  NULLs rank lowest, as in the batch rule.  A
    delivery after the watermark has passed its event is dropped.  Rows without an
    event time have no point at which they are final: they are left to the
    batch refresh and do not come through here.
    """
    if ts_col not in keys:
        raise ValueError(f"the keys must contain {ts_col}: only then can a group be final")
    timed = stream.filter(F.col(ts_col).isNotNull()).withWatermark(ts_col, delay)
    rest = [c for c in stream.columns if c not in keys]
    best = timed.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*rank)).alias("_r"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_r.{c}").alias(c) for c in stream.columns])
