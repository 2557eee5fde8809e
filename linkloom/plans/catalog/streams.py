"""Structured Streaming twins, fed from files that Spark writes from the given tables."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.operators.reshape import parsed_reports
from linkloom.plans import stand_ins as T
from linkloom.plans.catalog import ingest, ordered, query, shapes
from linkloom.sources.reports import frame_events, publish_log
from linkloom.streaming import machines, reports, tables, timers

with_sql = T.with_sql


def arriving(spark: SparkSession, df: DataFrame) -> DataFrame:
    """A frame as a stream of its files, a bounded number of them per micro-batch."""
    folder = ingest.scratch(spark)
    df.write.parquet(folder)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 64).parquet(folder)


def settled(stream: DataFrame) -> DataFrame:
    """Run a stream over all that has arrived and read what it wrote."""
    folder = ingest.scratch(stream.sparkSession)
    reports.land_to(stream, folder + "/table", folder + "/offsets").awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(folder + "/table")


def log_folder(spark, sf_dir) -> str:
    folder = ingest.scratch(spark)
    T.report_payloads(spark, sf_dir, copies=True).select(F.col("payload").alias("value")).write.text(folder)
    return folder


@query("stream_land", with_sql("ev", "rep", body="SELECT cond, sid, CAST(ts AS VARCHAR) AS ts, 1 + k % 3 AS n FROM rep").replace("1 + k % 3 AS n", "(1 + k % 3)::BIGINT AS n"))
def stream_land(spark, sf_dir):
    got = settled(reports.stream_land(spark, log_folder(spark, sf_dir), T.AT))
    return got.groupBy("cond", "sid", "ts").agg(F.count(F.lit(1)).alias("n"))


@query("stream_dedup", ingest.LANDED)
def stream_dedup(spark, sf_dir):
    got = settled(reports.stream_dedup(reports.stream_land(spark, log_folder(spark, sf_dir), T.AT)))
    return got.groupBy("cond", "sid", "ts").agg(F.count(F.lit(1)).alias("n"))


@query("stream_latest_report", shapes.LATEST)
def stream_latest_report(spark, sf_dir):
    latest = reports.stream_latest_report(reports.stream_land(spark, log_folder(spark, sf_dir), T.AT))
    folder = ingest.scratch(spark)
    query_ = (
        latest.writeStream.outputMode("complete").trigger(availableNow=True)
        .option("checkpointLocation", folder + "/offsets")
        .foreachBatch(lambda df, _: df.write.mode("overwrite").parquet(folder + "/table"))
        .start()
    )
    query_.awaitTermination()
    return spark.read.parquet(folder + "/table").select("cond", "sid", "ts", "r.peers")


@query("stream_upsert_latest", shapes.LATEST)
def stream_upsert_latest(spark, sf_dir):
    """The same by merging each micro-batch into the slots it touches."""
    folder = ingest.scratch(spark)
    lines = reports.stream_land(spark, log_folder(spark, sf_dir), T.AT, max_files=4)
    tables.stream_upsert_latest(lines, folder + "/table", folder + "/offsets", slots=8).awaitTermination()
    return parsed_reports(tables.latest_lines(spark, folder + "/table")).select("cond", "sid", "ts", "r.peers")


@query("stream_newest_by_span", shapes.LATEST)
def stream_newest_by_span(spark, sf_dir):
    """Newest lines per closed span of arrival, reduced once more: one mark behind the log closes its last span."""
    folder = ingest.scratch(spark)
    log = log_folder(spark, sf_dir)
    spans = lambda: reports.stream_newest_by_span(reports.stream_land(spark, log, T.AT), "1 second", "1 second")
    reports.land_to(spans(), folder + "/table", folder + "/offsets").awaitTermination()
    time.sleep(3)
    spark.range(1).select(F.lit('{"cond": "end", "sid": "end", "ts": 0}').alias("value")).write.mode("append").text(log)
    reports.land_to(spans(), folder + "/table", folder + "/offsets").awaitTermination()
    return parsed_reports(spark.read.parquet(folder + "/table")).select("cond", "sid", "ts", "r.peers")


@query("stream_land_log", ingest.LANDED)
def stream_land_log(spark, sf_dir):
    """The report log published by key, streamed back by offset, and landed once each."""
    folder = ingest.scratch(spark)
    lines = T.report_payloads(spark, sf_dir, copies=True)
    publish_log(frame_events(lines.select("payload")), folder + "/log", partitions=8)
    arrived = reports.land_log(reports.read_log(spark, folder + "/log", max_files=4), T.AT)
    tables.stream_land_once(arrived, folder + "/table", folder + "/offsets", parts=4).awaitTermination()
    got = tables.LandedOnce(spark, folder + "/table", 4).read()
    return got.groupBy("cond", "sid", "ts").agg(F.count(F.lit(1)).alias("n"))


@query("stream_link_lifecycle", ordered.LIFECYCLE)
def stream_link_lifecycle(spark, sf_dir):
    """The stream tells every change of a record; the last per incarnation stands."""
    changes = settled(machines.stream_link_lifecycle(arriving(spark, T.link_states(spark, sf_dir))))
    stage = F.struct(F.col("connected_ms") >= 0, "failed")
    fields = ["detected_ms", "connected_ms", "setup_ms", "failed"]
    final = changes.groupBy("session", "peer", "incarnation").agg(F.max_by(F.struct(*fields), stage).alias("r"))
    return final.select("session", "peer", "incarnation", *[f"r.{f}" for f in fields])


@query("stream_vad_edges", ordered.EDGES)
def stream_vad_edges(spark, sf_dir):
    return settled(machines.stream_vad_edges(arriving(spark, T.levels(spark, sf_dir)), hang_ms=100))


@query("stream_event_suppression", ordered.DECIDED)
def stream_event_suppression(spark, sf_dir):
    limits = machines.Thresholds(heartbeat_ms=ordered.QUIET)
    return settled(machines.stream_event_suppression(arriving(spark, T.node_samples(spark, sf_dir)), limits))


@query("stream_grace_window", f"SELECT * FROM ({ordered.GRACE}) WHERE end_ms IS NOT NULL")
def stream_grace_window(spark, sf_dir):
    """Links that have ended; the batch form also lists those still held."""
    return settled(machines.stream_grace_window(arriving(spark, T.ranges(spark, sf_dir)), ordered.HELD))


@query("stream_never_connected_timeout", with_sql("ev", "acts", body=ordered.WATCHED))
def stream_never_connected_timeout(spark, sf_dir):
    return settled(machines.stream_never_connected_timeout(arriving(spark, ordered.watch_ticks(spark, sf_dir))))


@query("stream_never_connected_deadlines", ordered.DEADLINES)
def stream_never_connected_deadlines(spark, sf_dir):
    return settled(timers.stream_never_connected_deadlines(arriving(spark, ordered.late_ticks(spark, sf_dir))))
