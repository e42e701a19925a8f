"""Drop redelivered messages from a stream."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

#: Keys that a task remembers at once; beyond them it begins anew, and copies are left to the state.
TASK_KEYS = 100_000


def _one_per_task(key: str, ts: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Drops rows whose key came in the same task with the same or a later event time."""

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        latest: dict = {}
        for batch in batches:
            keep = []
            for k, at in zip(batch.column(key).to_pylist(), batch.column(ts).cast(pa.int64()).to_pylist()):
                before = latest.get(k)
                keep.append(at is None or before is None or at > before)
                if keep[-1] and at is not None:
                    latest[k] = at
            yield batch.filter(pa.array(keep, pa.bool_()))
            if len(latest) > TASK_KEYS:
                latest = {}

    return kept


def stream_dedup(
    df: DataFrame, delay: str, key: str = "msg_id", ts: str = "timestamp", spread: int | None = None
) -> DataFrame:
    """One row per ``key`` among copies whose event times are at most ``delay`` apart.

    Copies of one message may be a third of the stream, and a stateful operator has no partial
    aggregation. So copies are first dropped within each task of the input, without a shuffle, which leaves a
    hot key with about one row per task; those are dropped per key. A copy that is kept is never
    older than one that it stands for, so it is not late where that one was not. ``spread=1``
    saves the first step where copies are rare.
    """
    if spread is None or spread > 1:
        df = df.mapInArrow(_one_per_task(key, ts), df.schema)
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])
