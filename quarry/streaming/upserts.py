"""Continuous ingest: micro-batches of versioned documents into a document store."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from quarry.operators.ingest import latest
from quarry.sources.store import DocumentStore


def upsert_stream(
    stream: DataFrame, store: DocumentStore, checkpoint: str, deletes: str | None = None
) -> StreamingQuery:
    """Start upserting; documents become visible when their micro-batch is written.

    Each micro-batch keeps the last version per key and is stored under its batch
    number, so a replay after a failure replaces it. ``deletes`` names a boolean
    column that marks deletions. Processes what is available, then stops.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = latest(batch, store.keys, store.seq)
        if deletes is None:
            store.write(rows, batch_id)
        else:
            store.append(rows.withColumnRenamed(deletes, "deleted"), batch_id)

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
