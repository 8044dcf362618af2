"""The per-document operators on a stream of text files (Structured Streaming).

Each new file is one document (whole-text file source); Markdown (A4) and
chapter validation (H7) are narrow per-row steps, so they run unchanged on a
stream.  The Parquet sink with a checkpoint location gives exactly-once output
and lets a restarted query resume after executor or driver loss.  Assembly and
window operators need every page of a document and stay batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import text as T
from ..operators import markdown as MD


def read_text_stream(spark: SparkSession, directory: str, max_files: int | None = None) -> DataFrame:
    """(path, name, text) per new file; CR and CRLF become LF as in text-mode reads."""
    reader = spark.readStream.format("text").option("wholetext", "true")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    raw = reader.load(directory)
    return raw.select(F.col("_metadata.file_path").alias("path"),
                      T.file_name(F.col("_metadata.file_path")).alias("name"),
                      F.regexp_replace("value", "\r\n?", "\n").alias("text"))


def markdown_stream(files: DataFrame) -> DataFrame:
    """(path, name, md) for each document of a stream (A4)."""
    return MD.text_to_markdown(files.withColumn("title", F.lit(None).cast("string"))
                               .withColumn("author", F.lit(None).cast("string"))
                               ).select("path", "name", "md")


def start_markdown_stream(spark: SparkSession, in_dir: str, out_dir: str, checkpoint: str,
                          available_now: bool = True) -> StreamingQuery:
    """Convert every file arriving in ``in_dir`` to Markdown rows in Parquet at ``out_dir``."""
    writer = (markdown_stream(read_text_stream(spark, in_dir))
              .writeStream.format("parquet")
              .option("path", out_dir)
              .option("checkpointLocation", checkpoint)
              .outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()


def validation_stream(files: DataFrame, level: int = 1) -> DataFrame:
    """(path, ok, reason) for each Markdown file of a stream (H7): empty files and
    files without a chapter heading are reported, never fail the query."""
    from ..operators import chapters as CH
    return CH.validate_markdown(files.withColumnRenamed("text", "md"), key="path", level=level)
