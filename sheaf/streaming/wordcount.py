"""Word counts over a growing folder of text files (rows S1, P1, F1, A1 run as a stream).

Each new file is read once; the per-word totals live in the streaming aggregate's state
store (one row per distinct word, partitioned by word) and are written to the checkpoint
location, so a restarted query or a lost executor resumes from the last committed batch.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from sheaf.operators.wordcount import word_count
from sheaf.session import checkpoint_dir


def word_count_stream(spark: SparkSession, folder: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The batch ``word_count`` applied to a streaming text source."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return word_count(reader.load(folder), "value")


def start_word_count(
    spark: SparkSession,
    folder: str,
    query_name: str,
    output_path: str,
    sink: str = "parquet",
    checkpoint_location: str | None = None,
) -> StreamingQuery:
    """Start the stream. Each batch writes one row per word whose count changed in it
    (update mode, via foreachBatch) to ``output_path/batch_id=<n>``, rewritten if the batch
    runs again. The checkpoint goes under the session's shared checkpoint folder unless
    given."""
    location = checkpoint_location or os.path.join(checkpoint_dir(spark), "streams", query_name)
    counts = word_count_stream(spark, folder)
    writer = counts.writeStream.queryName(query_name).option("checkpointLocation", location)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        # One folder per batch, overwritten: a batch re-run after a failure replaces its
        # own output instead of adding a second copy (the folders read back as a table
        # partitioned by batch_id).
        batch.write.mode("overwrite").format(sink).save(os.path.join(output_path, f"batch_id={batch_id}"))

    return writer.outputMode("update").foreachBatch(write_batch).start()
