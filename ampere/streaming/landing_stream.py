"""Incremental staging from the landing folder with Structured Streaming.

The batch pipeline handles late and revised data by re-landing the last months
and upserting them. As a stream: a file source over the landing folder picks up
each newly landed month file once (the checkpoint remembers which), and every
micro-batch is one load: one ``ingested_at`` (the batch's ``current_timestamp``),
staged and upserted into the month-partitioned staging table by ``foreachBatch``.
A re-landed month arrives as new files, so revisions flow through the same MERGE.
A cut-off array fails the batch, as it fails the batch reader.
A retried micro-batch re-applies the same rows, which the upsert absorbs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ampere.plans.runs import COLUMNS, KEYS, STAGE, Layout, upsert_table
from ampere.session import configure
from ampere.sources.landing import dataset_path, parsed_lines


def landing_records(spark: SparkSession, layout: Layout, dataset: str,
                    max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming raw rows (payload, source_file, ingested_at) of one dataset."""
    configure(spark)
    path = dataset_path(layout.landing, dataset)
    reader = spark.readStream.format("text").option("basePath", path)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    lines = reader.load(path)
    return (lines.select(F.explode(parsed_lines(F.col("value"))).alias("payload"),
                         F.regexp_extract(F.input_file_name(), r"(raw/.*)$", 1).alias("source_file"))
                 .filter(F.col("payload").isNotNull() & (F.length("payload") > 0))
                 .withColumn("ingested_at", F.current_timestamp().cast("timestamp_ntz")))


def start_staging_stream(spark: SparkSession, layout: Layout, dataset: str, checkpoint: str,
                         available_now: bool = True,
                         processing_time: str | None = None) -> StreamingQuery:
    """Upsert every newly landed file of ``dataset`` into its staging table."""
    target = layout.staging(dataset)

    def apply(batch: DataFrame, batch_id: int) -> None:
        upsert_table(batch.sparkSession, target, STAGE[dataset](batch), KEYS[dataset],
                     COLUMNS[dataset])

    writer = (landing_records(spark, layout, dataset).writeStream
              .foreachBatch(apply).option("checkpointLocation", checkpoint)
              .queryName(f"staging_{dataset}"))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
