"""Poll for new transfers and send them on as messages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from logtide.constants import POLL_LIMIT
from logtide.sources.files import block_of_row, encode_messages
from logtide.plans.incremental import newer_than


def produce(
    events: DataFrame,
    send: Callable[[DataFrame], None],
    last_block: int | None = None,
    limit: int = POLL_LIMIT,
    polls: int | None = None,
) -> int | None:
    """Send what is newer than ``last_block``, poll by poll; the last block sent.

    ``send`` gets the keyed messages of one poll, for example
    ``KafkaSettings.send``. Polls end at block boundaries. They go on until
    nothing is new, or for ``polls`` rounds; start the next call at the block
    that this one returned.
    """
    done = 0
    while polls is None or done < polls:
        newer = newer_than(events, last_block)
        cut = block_of_row(newer, limit)
        if cut is None:
            break
        send(encode_messages(newer.where(newer["block_number"] <= cut)))
        last_block, done = cut, done + 1
    return last_block
