"""Streaming scoring and alerts: the batch transform, applied to a stream.

``score_stream`` applies a stateless ``transform(df) -> df`` to a file
stream. With ``per_batch=True`` the transform runs inside ``foreachBatch`` on
each micro-batch as an ordinary DataFrame (needed when the transform holds
batch-only steps such as row-order features); each batch is written to its
own ``batch_id=<n>`` folder with overwrite, so a replayed batch after a
failure replaces its own output (idempotent sink).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def file_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet",
                max_files_per_trigger: int | None = None, **options) -> DataFrame:
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    for k, v in options.items():
        r = r.option(k, v)
    return r.load(path)


def start(stream: DataFrame, sink: str, checkpoint: str, transform: Callable | None = None,
          per_batch: bool = False, fmt: str = "parquet", output_mode: str = "append",
          available_now: bool = True) -> StreamingQuery:
    if per_batch:
        def run(batch: DataFrame, batch_id: int):
            out = transform(batch) if transform else batch
            out.write.mode("overwrite").format(fmt).save(f"{sink}/batch_id={batch_id}")
        w = stream.writeStream.foreachBatch(run).outputMode(output_mode)
    else:
        out = transform(stream) if transform else stream
        w = out.writeStream.format(fmt).option("path", sink).outputMode(output_mode)
    w = w.option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def score_stream(spark: SparkSession, source: str, schema, transform: Callable, sink: str,
                 checkpoint: str, per_batch: bool = False, fmt: str = "parquet",
                 max_files_per_trigger: int | None = None, wait: bool = True) -> StreamingQuery:
    s = file_stream(spark, source, schema, fmt, max_files_per_trigger)
    q = start(s, sink, checkpoint, transform, per_batch)
    if wait:
        q.awaitTermination()
    return q
