"""Linkage of query records as they arrive: micro-batches against a fixed table of targets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from weftline.operators import blocking


def link_stream(queries: DataFrame, targets: DataFrame, folder: str, config: blocking.BlockingConfig = blocking.BlockingConfig()) -> StreamingQuery:
    """Write the candidates of each micro-batch of source 1 records as a partition of `folder`/candidates.

    A batch that is run again after a failure replaces its own partition, so results are there exactly once; the
    stream's offsets are kept in `folder`/offsets. Targets should be stored: every batch reads them.
    """

    def each(batch: DataFrame, number: int) -> None:
        records = batch.withColumn("src", F.lit(1)).unionByName(targets, allowMissingColumns=True)
        found = blocking.candidates(records, config).withColumn("batch", F.lit(number))
        found.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(f"{folder}/candidates")

    return queries.writeStream.foreachBatch(each).option("checkpointLocation", f"{folder}/offsets").trigger(availableNow=True).start()
