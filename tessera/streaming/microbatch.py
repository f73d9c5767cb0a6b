"""Batch operators applied per micro-batch of a stream.

The reference has no streams; this only shows that the evaluation operators
are plain DataFrame functions: a prediction stream can be scored batch by
batch with ``foreachBatch`` and the metric rows appended to the per-label log
(A17). The append is a plain one: a batch that is retried after its append
is logged twice, so readers of the log take the rows of a batch id once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.metrics import classification_report
from tessera.sources.writers import append_metrics


def score_stream(spark: SparkSession, source: str, schema: str, sink: str, checkpoint: str,
                 glob: str = "*.parquet", y: str = "y_true", p: str = "y_pred"):
    """Start a stream over parquet predictions (columns ``y`` / ``p``); each
    micro-batch appends its classification report rows with the batch id."""
    stream = spark.readStream.schema(schema).option("pathGlobFilter", glob).parquet(source)

    def per_batch(df: DataFrame, batch_id: int) -> None:
        if df.isEmpty():
            return
        rep = classification_report(df, y, p).withColumn("batch", F.lit(batch_id))
        append_metrics(rep, sink, "label")

    return (stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
