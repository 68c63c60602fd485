"""The scoring job (L9) in micro-batch form.

The source only appends finite flight files (no event-time state, watermarks or late-data
rules exist in the published behaviour), so the stream is a file source + ``foreachBatch``
running the batch scoring plan on each new set of files. Each micro-batch overwrites its own
``batch_id=<n>`` folder, so a retried batch replaces its output instead of duplicating it;
progress lives in the checkpoint location on shared storage. With ``history=None`` the rolling
rates come from the airport-day table saved with the featurizer, so no batch aggregates past
flights again.
"""

from __future__ import annotations

import os

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ontime_spark.operators import featurizer as FP
from ontime_spark.plans.score import score_job
from ontime_spark.session import scratch_path


def start_scoring_stream(spark: SparkSession, source_path: str, schema: T.StructType,
                         featurizer: FP.FlightFeaturizerModel, history: DataFrame | None,
                         model: PipelineModel, sink_path: str, model_type: str = "lr",
                         top_n: int = 8, checkpoint_location: str | None = None,
                         available_now: bool = False, keep: tuple[str, ...] = (),
                         max_files_per_trigger: int | None = None) -> StreamingQuery:
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(source_path)

    def score_batch(batch: DataFrame, batch_id: int) -> None:
        out = score_job(batch, featurizer, history, model, model_type, top_n, keep)
        out.write.mode("overwrite").parquet(os.path.join(sink_path, f"batch_id={batch_id}"))

    w = (stream.writeStream.foreachBatch(score_batch)
         .option("checkpointLocation", checkpoint_location or scratch_path(spark, "scoring-stream")))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
