"""Copies of messages left out of a stream by state of bounded size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HORIZON = "1 hour"
_ARRIVED, _TOLD = "__arrived", "__told"


def drop_recent_copies(messages: DataFrame, horizon: str = HORIZON, text: str = "value") -> DataFrame:
    """Messages whose text did not come within ``horizon`` before, in any micro-batch.

    The state holds a 256-bit hash of each text for the horizon and then lets go of it,
    so it grows with the messages of that time, not with the topic. It is part of the
    checkpoint and outlives restarts. Time is that of arrival, the batch's own: it never
    runs back, so no message counts as late and none but copies are dropped. A missing
    text is a copy of an empty one. Copies of a text that cannot be decoded are dropped
    too, so it is one dead letter per horizon.

    Only equal texts are copies here. Other values under a known id, and copies
    from before the horizon, go on to the table's key, which decides for good; so a
    sink behind this holds what it would hold without, as long as one micro-batch does
    not bring a text, another text of the same id, and the first text again.
    """
    told = F.sha2(F.coalesce(F.col(text), F.lit("")), 256)
    return (
        messages.withColumns({_ARRIVED: F.current_timestamp(), _TOLD: F.unhex(told)})
        .withWatermark(_ARRIVED, horizon)
        .dropDuplicatesWithinWatermark([_TOLD])
        .drop(_ARRIVED, _TOLD)
    )
