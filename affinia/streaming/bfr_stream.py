"""BFR clustering of a stream of files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from affinia.operators.bfr import Bfr, BfrSettings
from affinia.session import scratch_path

POINTS = "id long, features array<double>"


def read_points(spark: SparkSession, path: str, files_per_chunk: int = 1) -> DataFrame:
    """Point files as they arrive, a fixed number per micro-batch."""
    return (
        spark.readStream.schema(POINTS)
        .option("maxFilesPerTrigger", files_per_chunk)
        .parquet(path)
    )


def start(points: DataFrame, bfr: Bfr, checkpoint: str | None = None) -> StreamingQuery:
    """Feed each micro-batch to `Bfr.update` under its batch id.

    A replayed batch finds its version complete and is skipped, so the clusters count
    every point once.
    """
    checkpoint = checkpoint or scratch_path(points.sparkSession, "bfr-stream")
    return (
        points.writeStream.foreachBatch(lambda chunk, version: bfr.update(chunk, version))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def cluster_stream(
    spark: SparkSession,
    path: str,
    settings: BfrSettings = BfrSettings(),
    files_per_chunk: int = 1,
    state: str | None = None,
    checkpoint: str | None = None,
) -> tuple[Bfr, int | None]:
    """Cluster all files that are there now; returns the state and its last version.

    With the `state` and `checkpoint` folders of an earlier call the stream goes on where that
    one ended. Without new files nothing changes; the version is null before the first file.
    """
    bfr = Bfr(spark, state, settings)
    query = start(read_points(spark, path, files_per_chunk), bfr, checkpoint)
    query.awaitTermination()
    return bfr, bfr.last_version()
