"""Checking every micro-batch before it is loaded."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tradewind.operators.quality import Check, evaluate, failures_of
from tradewind.sources.sinks import replace_partition

BATCH = "batch_id"


def gated_batch(suite: str, checks: Sequence[Check], target: str, quarantine: str,
                parents: Mapping[str, DataFrame] | None = None) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: good batches go to ``target``, others to ``quarantine``.

    Both are partitioned by batch number and a batch replaces its own partition, in the other table
    with an empty one, so a batch that is run again is not stored twice, not even if it is judged
    differently.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)  # checked and written: read the source once
        try:
            failed = bool(checks) and failures_of(evaluate(batch, suite, checks, parents))
            replace_partition(batch.limit(0), target if failed else quarantine, BATCH, batch_id)
            replace_partition(batch, quarantine if failed else target, BATCH, batch_id)
        finally:
            batch.unpersist()

    return write


def land_gated(rows: DataFrame, checkpoint: str, write: Callable[[DataFrame, int], None],
               trigger: Mapping | None = None) -> StreamingQuery:
    return (
        rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )
