"""Fold snapshots into a history as they arrive, each once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from rosterkeep.plans import runs
from rosterkeep.sources.store import RECORD, Store


def fold_new_snapshots(store: Store, config: runs.RunConfig, kind: str, checkpoint: str) -> StreamingQuery:
    """Start a query that folds the snapshots finished since its last run into the history of a kind, then stops.

    The stream is of the store's records of finished writings, so a writing that is not finished is never seen. Each
    batch of records folds the dates before the run date that are not in the history, each by its newest writing, in
    one pass; a date that is written again before it is folded counts once, as it is then. A batch that is run again
    after a failure finds nothing left to fold. Batch folds of the same kind may come in between.
    """
    path = store.commits_path(f"snapshots-{kind}")
    arrived = store.spark.readStream.schema(RECORD).json(path)

    def take(batch: DataFrame, _number: int) -> None:
        if not batch.isEmpty():
            runs.fold_history(store, config, kind)

    return (
        arrived.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
