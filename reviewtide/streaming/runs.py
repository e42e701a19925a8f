"""Streams whose batches know which query they belong to."""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery


def start_run(
    writer: DataStreamWriter, write: Callable[[DataFrame, str, int], None]
) -> StreamingQuery:
    """Start a query that calls ``write(batch, run, batch_id)``.

    ``run`` is the query's id. It lives in the checkpoint, so a restart keeps it and a query with
    another checkpoint has another. The first batch waits until the id is known.
    """
    started, run = threading.Event(), []

    def each(batch: DataFrame, batch_id: int) -> None:
        started.wait()
        write(batch, run[0], batch_id)

    query = writer.foreachBatch(each).start()
    run.append(query.id)
    started.set()
    return query
