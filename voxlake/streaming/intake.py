"""Incremental intake of new subjects' embeddings, each exactly once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from voxlake.operators.embeddings import ROI
from voxlake.operators.projection import project

#: Where the state of subjects seen is kept: on disk, not in the memory of executors.
STATE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def write_batch(rows: DataFrame, sink: str, batch: int) -> None:
    """Writes a batch in the place of what an earlier attempt at it has left; other batches stay as they are."""
    rows.write.mode("overwrite").partitionBy(*ROI).parquet(f"{sink}/batch={batch}")


def read_intake(spark: SparkSession, sink: str) -> DataFrame:
    """(region, hemi, subject_id, u, v) of all batches; filters on region and hemi reach the folders."""
    return spark.read.schema("subject_id string, u double, v double, batch long, region string, hemi string").parquet(sink).select(*ROI, "subject_id", "u", "v")


def project_new_files(spark: SparkSession, schema: str, source: str, model: DataFrame, sink: str, checkpoint: str, files_a_batch: int | None = None) -> None:
    """Projects the embeddings of files that arrived in `source` since the last call and adds them to `sink`; a subject of a region is taken once.

    The subjects seen are the stream's state, so no batch reads the sink. A batch that failed after it was written, but before it was counted as done, sees the
    state of before it and replaces what it wrote.
    """
    before = spark.conf.get(STATE[0], None)
    spark.conf.set(*STATE)
    try:
        stream = spark.readStream.schema(schema)
        stream = stream.option("maxFilesPerTrigger", files_a_batch) if files_a_batch else stream
        once = stream.parquet(source).dropDuplicates([*ROI, "subject_id"])
        taken = once.writeStream.foreachBatch(lambda batch, i: write_batch(project(batch, model), sink, i))
        taken.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.unset(STATE[0]) if before is None else spark.conf.set(STATE[0], before)
