"""The batch scoring plan on a stream. It keeps no state: a reading needs nothing but itself."""

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from frostline.operators.contracts import quarantined_rows, validate_ranges
from frostline.operators.scoring import score_or_quarantine, score_shipments


def score_stream(stream: DataFrame, threshold: float, sink: str, checkpoint: str, risk_model=None, classifier=None,
                 trigger: dict | None = None) -> StreamingQuery:
    """Score a streaming table into a parquet folder, exactly once through the checkpoint.

    The default trigger works through what is there and stops; pass for example
    `{"processingTime": "1 minute"}` to keep running. Rows outside the allowed ranges are for `quarantine_stream`.
    """
    return _append(score_shipments(stream, threshold, risk_model, classifier), sink, checkpoint, trigger)


def quarantine_stream(stream: DataFrame, sink: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """The rows that `score_stream` leaves out, with their `violations`, into a folder of their own, exactly once."""
    return _append(quarantined_rows(validate_ranges(stream)), sink, checkpoint, trigger)


def score_stream_or_quarantine(stream: DataFrame, threshold: float, scored_sink: str, held_sink: str, checkpoint: str, risk_model=None,
                               classifier=None, trigger: dict | None = None) -> StreamingQuery:
    """One pass over the source into both sinks: each micro-batch is read once and written below its number.

    A batch that broke off between the two writes is repeated under the same number and overwrites what it had written,
    so every row is in one of the sinks exactly once. Both tables have a column `batch`.
    """
    def write(rows: DataFrame, number: int) -> None:
        rows = rows.persist()
        try:
            for part, sink in zip(score_or_quarantine(rows, threshold, risk_model, classifier), (scored_sink, held_sink)):
                part.write.mode("overwrite").parquet(f"{sink}/batch={number}")
        finally:
            rows.unpersist()

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def _append(rows: DataFrame, sink: str, checkpoint: str, trigger: dict | None) -> StreamingQuery:
    return (
        rows.writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", checkpoint).option("path", sink)
        .trigger(**(trigger or {"availableNow": True})).start()
    )
