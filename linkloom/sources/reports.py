"""The append-only report log: at-least-once lines, keyed events."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType
from pyspark.sql.utils import AnalysisException

from linkloom import schemas
from linkloom.functions.scalars import record_type

STREAM_FILE = "wsn-remote-reports.jsonl"


def skip_blank_lines(df: DataFrame, column: str = "payload") -> DataFrame:
    return df.where(F.col(column).rlike(r"\S"))


def probe_json_paths(df: DataFrame, paths: dict[str, str], column: str = "payload") -> DataFrame:
    """Pull single fields out of raw JSON text as strings.

    Fields at the top level come from one parse of the line that skips the rest;
    deeper paths are looked up one by one.
    """
    flat = {n: p[2:] for n, p in paths.items() if re.fullmatch(r"\$\.\w+", p)}
    deep = {n: F.get_json_object(column, p) for n, p in paths.items() if n not in flat}
    if flat:
        schema = ", ".join(f"`{field}` string" for field in dict.fromkeys(flat.values()))
        df = df.withColumn("_probe", F.from_json(column, schema))
    found = {n: F.col("_probe").getField(field) for n, field in flat.items()}
    return df.withColumns({**found, **deep}).drop("_probe")


# The key of lines that name neither a session nor a condition.
UNKEYED = "unknown"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with the position that orders them: file, block, row inside the block.

    Rows of one block are read by one task in file order, so the triple is a total
    order even when a large file is split.
    """
    return spark.read.text(path).select(
        F.col("value").alias("payload"),
        F.col("_metadata.file_name").alias("source_file"),
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        ).alias("line"),
    )


def redelivery_key() -> list[Column]:
    """What makes two lines the same report: its keys if it has them, else its text."""
    keyed = F.col("sid").isNotNull() & F.col("ts").isNotNull()
    return [
        F.when(keyed, F.struct("cond", "sid", "ts")).alias("_report"),
        F.when(~keyed, F.col("payload")).alias("_text"),
    ]


def drop_redelivered(df: DataFrame) -> DataFrame:
    """Keep the last line of every report. Aggregated before the shuffle, so copies of
    one report collapse where they are read."""
    kept = F.max_by(F.struct(*df.columns), F.col("line"))
    return df.groupBy(*redelivery_key()).agg(kept.alias("_kept")).select("_kept.*")


def prepare_lines(lines: DataFrame, ingested_at: str, keep: list[str] | None = None) -> DataFrame:
    probed = probe_json_paths(
        skip_blank_lines(lines), {"cond": "$.cond", "sid": "$.sid", "ts": "$.ts"}
    )
    return probed.withColumns(
        {"record_type": record_type("source_file"), "ingested_at": F.lit(ingested_at)}
    ).select(*schemas.RAW_STREAM.names, *(keep or []))


def land_jsonl_stream(spark: SparkSession, path: str, ingested_at: str) -> DataFrame:
    """One row per distinct report; an empty frame if the log is not there yet."""
    try:
        lines = read_lines(spark, path)
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return spark.createDataFrame([], schemas.RAW_STREAM)
    return drop_redelivered(prepare_lines(lines, ingested_at))


def frame_events(df: DataFrame) -> DataFrame:
    """Key each line for an ordered log: session, else condition, else 'unknown'."""
    probed = probe_json_paths(skip_blank_lines(df), {"sid": "$.sid", "cond": "$.cond", "ts": "$.ts"})
    named = lambda c: F.nullif(F.col(c), F.lit(""))
    return probed.select(
        F.coalesce(named("sid"), named("cond"), F.lit(UNKEYED)).alias("partition_key"),
        F.trim("payload").alias("body"),
        F.coalesce(F.col("ts").try_cast("bigint"), F.lit(0)).alias("ts"),
    )


def per_session_order(events: DataFrame) -> DataFrame:
    """All events ordered by key and time.

    Range partitions, not hash ones: a busy key spreads over neighbouring
    partitions and still reads in order across them.
    """
    return events.repartitionByRange("partition_key", "ts").sortWithinPartitions(
        "partition_key", "ts"
    )


def publish_keyed_events(
    events: DataFrame, sink: str, options: dict[str, str] | None = None
) -> None:
    """Ship framed events in per-key order: a broker topic, or ordered files at a path.

    Files read in order across tasks. A topic does not: it keeps the order in which
    a key's events arrive, so there one task sends all of a key, streaming its
    sorted rows without holding them. Lines without a key have no order to keep and
    are sent from everywhere.
    """
    writer_options = options or {}
    if sink == "kafka":
        loose = F.when(F.col("partition_key") == UNKEYED, F.xxhash64("body"))
        ordered = events.repartition("partition_key", loose).sortWithinPartitions("partition_key", "ts")
        message = ordered.selectExpr("partition_key AS key", "body AS value")
        message.write.format("kafka").options(**writer_options).save()
    else:
        ordered = per_session_order(events).select("partition_key", "body")
        ordered.write.mode("overwrite").options(**writer_options).json(sink)


LOG_RECORD = "key string, value string, partition int, offset bigint"


def publish_log(events: DataFrame, path: str, partitions: int = 64) -> None:
    """Append framed events to a keyed log of files: key, value, partition, offset.

    A key's events share a partition, and offsets grow with time in it. Range
    partitions write neighbouring stretches of the log, so a busy key is written by
    many tasks; offsets have gaps between them. Each call starts a new stretch behind
    the last one's offsets.
    """
    spark = events.sparkSession
    try:
        first = spark.read.schema(LOG_RECORD).parquet(path).agg(F.max("offset")).first()[0]
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        first = None
    placed = events.withColumn("partition", F.pmod(F.xxhash64("partition_key"), F.lit(partitions)).cast("int"))
    by = ["partition", "ts", "partition_key"]
    ordered = placed.repartitionByRange(*by).sortWithinPartitions(*by)
    offset = F.monotonically_increasing_id() + F.lit(0 if first is None else first + 1)
    ordered.select(F.col("partition_key").alias("key"), F.col("body").alias("value"), "partition", offset.alias("offset")).write.mode("append").parquet(path)


def quarantine_malformed(df: DataFrame, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """Split into parsed rows (column ``r``) and bad ones with the reason and where they came from.

    A type that does not fit fails the row instead of turning into a silent NULL;
    fields the schema does not know are ignored.
    """
    wide = StructType([*schema.fields, StructField("_corrupt", StringType())])
    parsed = df.withColumn(
        "r", F.from_json("payload", wide, {"columnNameOfCorruptRecord": "_corrupt"})
    )
    broken = F.col("r").isNull() | F.col("r._corrupt").isNotNull()
    good = parsed.where(~broken).withColumn("r", F.col("r").dropFields("_corrupt"))
    shape = F.when(F.try_parse_json("payload").isNull(), "not json").otherwise("type mismatch")
    origin = [c for c in ("record_type", "source_file") if c in df.columns]
    return good, parsed.where(broken).select("payload", shape.alias("reason"), *origin)
