"""Incremental ingest of landed files: a stream that picks up new files only, whatever their headers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from folioforge.operators.bronze import align, with_control_columns
from folioforge.sources.landing import LINE_OPTIONS, parse_lines, with_lineage

#: Names the stream and the micro-batch that wrote a row.
BATCH = "ingest_batch"


def ingest_stream(
    spark: SparkSession,
    path: str,
    declared: T.StructType,
    table_path: str,
    checkpoint: str,
    grain: str,
    load_id: str,
    ingestion_ts: str,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Append what is new since the last run, then stop. A rerun from the same checkpoint adds nothing.

    The stream carries lines; each micro-batch parses them by the headers of its own files, with the rules of
    the batch reader: new columns are kept as text, missing ones are null. A micro-batch owns the
    partitions with its name, which holds the id in the checkpoint, and replaces them if it has to run again,
    so each file counts once even after a failure between writing and recording progress.
    """
    reader = spark.readStream.options(**LINE_OPTIONS)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def write(lines: DataFrame, number: int) -> None:
        landed = parse_lines(lines, declared)
        if landed is None:
            return
        stream = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        raw = with_control_columns(align(landed, declared), grain, load_id, ingestion_ts)
        (
            raw.withColumn(BATCH, F.lit(f"{stream}-{number:010d}"))
            .hint("rebalance", "source_yyyymm")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(BATCH, "source_yyyymm")
            .parquet(table_path)
        )

    return (
        with_lineage(reader.text(path))
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_ingested(spark: SparkSession, table_path: str) -> DataFrame:
    """What the stream has written, with the columns of all its batches."""
    return spark.read.option("mergeSchema", "true").parquet(table_path)
