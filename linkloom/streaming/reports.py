"""The report log as a stream: landing, redelivery, newest report per session."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from linkloom.operators.reshape import filter_known_condition, parsed_reports, time_of_report
from linkloom.schemas import RAW_STREAM
from linkloom.sources.reports import LOG_RECORD, STREAM_FILE, prepare_lines, redelivery_key


def stream_land(
    spark: SparkSession, folder: str, ingested_at: str, max_files: int = 1000
) -> DataFrame:
    """Lines of the files arriving in a folder, prepared as the batch landing does.

    ``arrived`` is the time of the micro-batch, which is logged and so the same
    after a restart. It only grows: no line is ever late, whatever its own clock or
    its file's says. A stream cannot number rows, so the lines of one block are placed
    by their text: of reports with equal times the same one always wins.
    """
    lines = spark.readStream.option("maxFilesPerTrigger", max_files).text(folder)
    placed = lines.select(
        F.col("value").alias("payload"),
        F.lit(STREAM_FILE).alias("source_file"),
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.xxhash64("value").alias("row"),
        ).alias("line"),
        F.current_timestamp().alias("arrived"),
    )
    return prepare_lines(placed, ingested_at, keep=["arrived"])


def land_log(records: DataFrame, ingested_at: str) -> DataFrame:
    """Records of a keyed log, batch or stream, prepared as lines: key, value, partition, offset (and topic, if there).

    This is what a broker's source gives, and what ``publish_log`` writes. All records of
    a key lie in one partition, and the offset is their order there, so the last of
    equal reports is the one with the later offset, whatever batches they come in.
    """
    topic = F.coalesce(F.col("topic").cast("string"), F.lit("")) if "topic" in records.columns else F.lit("")
    placed = records.select(
        F.col("value").cast("string").alias("payload"),
        F.lit(STREAM_FILE).alias("source_file"),
        F.struct(
            topic.alias("file"), F.col("partition").cast("bigint").alias("block"), F.col("offset").cast("bigint").alias("row"),
        ).alias("line"),
        F.current_timestamp().alias("arrived"),
    )
    return prepare_lines(placed, ingested_at, keep=["arrived"])


def read_log(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    """The log ``publish_log`` keeps at a path, as a stream of its records."""
    return spark.readStream.schema(LOG_RECORD).option("maxFilesPerTrigger", max_files).parquet(path)


def stream_dedup(lines: DataFrame, watermark: str = "10 minutes", time: str = "arrived") -> DataFrame:
    """Drop redelivered reports, remembering each for the watermark.

    Time is arrival by default, so no report is too old to be kept, and the state
    holds only the keys of the last ``watermark``. A copy that comes later than
    that is left to the batch form.
    """
    keyed = lines.select("*", *redelivery_key())
    timed = keyed.withWatermark(time, watermark)
    return timed.dropDuplicatesWithinWatermark(["_report", "_text"]).drop("_report", "_text")


def stream_latest_report(lines: DataFrame) -> DataFrame:
    """Newest report per (condition, session), for update or complete output.

    State holds one report per session ever seen; ``stream_newest_by_span`` bounds it.
    """
    return parsed_reports(lines)


def stream_newest_by_span(lines: DataFrame, span: str = "1 day", watermark: str = "10 minutes") -> DataFrame:
    """Newest line per (condition, session) and span of arrival, appended when the span closes.

    State holds the sessions of the open span only. The newest of the appended
    lines is the newest of all, so ``parsed_reports`` over that much smaller table
    gives the exact result.
    """
    newest = F.max_by(F.struct(*RAW_STREAM.names), F.struct(time_of_report(), F.col("line")))
    spans = F.window("arrived", span)
    timed = filter_known_condition(lines).withWatermark("arrived", watermark)
    return timed.groupBy(spans, "cond", "sid").agg(newest.alias("_line")).select("_line.*")


def land_to(lines: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append to a table path; offsets and output commit together, so a restart adds nothing twice."""
    return (
        lines.writeStream.format("parquet").option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )
