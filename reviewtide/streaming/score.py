"""Message stream to results table."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from reviewtide.operators.quality import check_quality
from reviewtide.plans.storage import scratch
from reviewtide.plans.training import score_messages
from reviewtide.sources.messages import (
    decode_messages,
    normalise_types,
    read_messages,
    with_msg_id,
)
from reviewtide.sources.store import append_rejects, append_scored, not_yet_rejected, not_yet_stored
from reviewtide.streaming.dedup import stream_dedup
from reviewtide.streaming.runs import start_run


#: Redelivery that is recognised, and files in one batch, unless the caller says otherwise.
DEDUP_DELAY = "1 day"
MAX_FILES = 1000


def message_records(messages: DataFrame) -> DataFrame:
    """Decode, identify and type a batch or stream of raw messages."""
    return normalise_types(with_msg_id(decode_messages(messages)))


def scored_stream(messages: DataFrame, model: PipelineModel) -> DataFrame:
    """Decode, identify, type and score a batch or stream of raw messages. No shuffle."""
    return score_messages(model, message_records(messages))


def _known(batch: DataFrame, rules: dict[str, Column]) -> bool:
    """Whether the rules need nothing that only a scored row has."""
    try:
        return bool(batch.select(*[violated.alias(name) for name, violated in rules.items()]).columns)
    except AnalysisException:
        return False


def stream_score(
    spark: SparkSession,
    src: str | DataFrame,
    model: PipelineModel,
    sink: str,
    checkpoint: str,
    rules: dict[str, Column] | None = None,
    rejects: str | None = None,
    dedup_delay: str | None = DEDUP_DELAY,
    max_files: int | None = MAX_FILES,
    once: bool = True,
) -> StreamingQuery:
    """Score all messages that have arrived, append them to ``sink``, then stop.

    Input counts as read only when the checkpoint records the batch after its write, and a
    replayed batch overwrites its own folder, so no row is lost or stored twice. With ``rules``
    the rows that violate one go to ``rejects``, which is then required, as JSON lines instead.
    Redelivered messages are dropped before they are scored: in the stream while they arrive within
    ``dedup_delay`` of each other (None keeps them), and, with ``once``, whenever ``sink`` (or
    ``rejects``) has their ``msg_id`` already, whichever checkpoint stored it. Streams into
    one sink must then follow each other. A batch holds ``max_files`` files.
    """
    if rules is not None and rejects is None:
        raise ValueError("rules need a place for the rejects")
    stream = read_messages(spark, src, max_files=max_files) if isinstance(src, str) else src
    records = message_records(stream)
    if dedup_delay is not None:
        # Redelivery is a matter of arrival, and a review's own date may be missing.
        arrived = records.withColumn("arrived", F.current_timestamp())
        records = stream_dedup(arrived, dedup_delay, ts="arrived").drop("arrived")

    def write(batch: DataFrame, run: str, batch_id: int) -> None:
        with scratch(spark, "batch") as keep:
            if once:
                batch = not_yet_stored(keep(batch), sink, run, batch_id)
            if rules is None:
                append_scored(score_messages(model, batch), sink, run, batch_id)
                return
            if not once:
                batch = keep(batch)
            if _known(batch, rules):  # then each row is scored once, and only if it will be written
                valid, rejected = check_quality(batch, rules)
                if once:
                    rejected = not_yet_rejected(rejected, rejects, run, batch_id)
                valid, rejected = score_messages(model, valid), score_messages(model, rejected)
            else:
                valid, rejected = check_quality(keep(score_messages(model, batch)), rules)
                if once:
                    rejected = not_yet_rejected(rejected, rejects, run, batch_id)
            append_scored(valid, sink, run, batch_id)
            append_rejects(rejected, rejects, run, batch_id, once=False)

    writer = records.writeStream.option("checkpointLocation", checkpoint)
    return start_run(writer.trigger(availableNow=True), write)
