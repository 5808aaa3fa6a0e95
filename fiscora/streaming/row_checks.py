"""Row checks on a stream of candidate rows, batch by batch.

The checks themselves are those of tables: each micro-batch is reconciled and its blocking rows are appended as Parquet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators.reconcile import compare


def reconcile_stream(candidates: DataFrame, reference: DataFrame, keys: list[str], left_value: str, right_value: str, output: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Keys of a batch that differ from the reference or lack there; keys that only the reference has say nothing here.

    A batch that is written again after a failure overwrites its own folder, so no row comes twice.
    """

    def check(batch: DataFrame, number: int) -> None:
        found = compare(batch, reference.join(batch.select(*keys).distinct(), keys, "left_semi"), keys, left_value, right_value)
        found.filter("status <> 'MATCH'").write.mode("overwrite").parquet(f"{output}/batch={number}")

    writer = candidates.writeStream.foreachBatch(check).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
