"""New season files -> appended appearance rows, or the state that the career relations start from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stintwise.operators import careers
from stintwise.session import materialize
from stintwise.sources.documents import ITEM_MARK, season_rows


def _season_appearances(spark: SparkSession, root: str, pattern: str, max_files: int | None) -> DataFrame:
    """Flattened entries of new season files, each file cut at the items of its list."""
    reader = spark.readStream.format("text").option("lineSep", "\n" + ITEM_MARK)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    files = reader.load(f"{root.rstrip('/')}/{pattern}").select(
        F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_start"),
        F.col("value").alias("_text"))
    return season_rows(files, mark=ITEM_MARK)


def _started(writer, checkpoint_location: str, available_now: bool) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint_location)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def season_stream(spark: SparkSession, root: str, sink_path: str, checkpoint_location: str,
                  pattern: str = "*/entrants.yml", available_now: bool = False,
                  max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start a stream that appends the flattened entries of every new season file.

    The sink has the fact-table layout (parquet partitioned by year), so
    ``sources.tables.read_fact_table`` reads it.

    ``checkpoint_location`` must be on shared storage; a restarted query
    continues where it stopped and never appends a file twice.
    """
    writer = (_season_appearances(spark, root, pattern, max_files_per_trigger).writeStream.format("parquet")
              .outputMode("append").partitionBy("year").option("path", sink_path))
    return _started(writer, checkpoint_location, available_now)


def career_stream(spark: SparkSession, root: str, state_path: str, checkpoint_location: str,
                  pattern: str = "*/entrants.yml", available_now: bool = False,
                  max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Keep the state of the career relations up to date with every new season file.

    Each micro-batch adds its counted (driver, constructor, year, tookPart) rows to the state
    as a folder of its own; counts of different batches add up, so no earlier folder is
    read or rewritten.  A batch that runs again after a failure replaces its own folder.
    ``read_career_state`` gives what Q-1 to Q-7 start from.
    """
    def add(batch: DataFrame, batch_id: int) -> None:
        careers.count_entries(batch).write.mode("overwrite").parquet(f"{state_path.rstrip('/')}/batch={batch_id}")

    writer = _season_appearances(spark, root, pattern, max_files_per_trigger).writeStream.foreachBatch(add)
    return _started(writer, checkpoint_location, available_now)


def read_career_state(spark: SparkSession, state_path: str) -> DataFrame:
    """The merged state, written once: ``careers.yearly_entries`` of all seasons streamed so far.

    ``careers.shared_spans``, ``debuts``, ``retirements`` and ``retirements_announced`` take it in place of the
    fact table; the transfers take its spans.
    """
    state = spark.read.parquet(f"{state_path.rstrip('/')}/batch=*")
    merged = state.groupBy(careers.D, careers.C, careers.Y, "tookPart").agg(F.sum(careers.N).alias(careers.N))
    return materialize(merged, "yearly-entries")
