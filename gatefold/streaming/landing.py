"""Newly landed samples as a stream: each micro-batch goes through the batch operators.  An addition of this library."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from gatefold.operators import conformance, populations


def stream_samples(spark: SparkSession, path: str, schema: StructType, files_per_trigger: int = 8) -> DataFrame:
    """Parquet events that land in a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def score_stream(events: DataFrame, thresholds: DataFrame, spec: dict, parent: str, sink: Callable[[DataFrame, int], None], checkpoint: str, baseline: DataFrame | None = None) -> StreamingQuery:
    """Frequencies of each micro-batch's samples, with their conformance to a baseline, given to sink(df, epoch).

    A sample must land whole: its events are counted in the batch that brings them.
    """

    def one(batch: DataFrame, epoch: int) -> None:
        scored = populations.score(batch, thresholds, spec, parent)
        freq = populations.frequencies(scored, list(spec), parent)
        if baseline is not None:
            v = conformance.population_conformance(freq, baseline).select("population", "robust_z", "verdict")
            freq = freq.join(v, "population", "left")
        sink(freq, epoch)

    return events.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
