import json
import time

from pyspark.sql import functions as F

from linkloom.operators import reshape
from linkloom.sources import reports
from linkloom.streaming import reports as streams

AT = "2026-01-01T00:00:00Z"


def write(folder, name, *bodies):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(b) for b in bodies) + "\n \n")


def body(sid, ts, peers=0, cond="c"):
    return {"cond": cond, "sid": sid, "ts": ts, "peers": peers}


def test_stream_equals_batch(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    write(source, "a.jsonl", body("x", 1), body("y", 5, 1), body("x", 1))
    write(source, "b.jsonl", body("x", 2, 9), body("y", 5, 1), {"nokeys": 1}, body("z", 1, cond=""))
    lines = streams.stream_dedup(streams.stream_land(spark, str(source), AT, max_files=1))
    streams.land_to(lines, out, str(tmp_path / "cp")).awaitTermination()
    landed = spark.read.parquet(out)
    batch = reports.drop_redelivered(reports.prepare_lines(reports.read_lines(spark, str(source)), AT))
    key = ["cond", "sid", "ts"]
    assert sorted(map(tuple, landed.select(*key).collect()), key=repr) == sorted(map(tuple, batch.select(*key).collect()), key=repr)

    # A restart finds nothing new.
    streams.land_to(lines, out, str(tmp_path / "cp")).awaitTermination()
    assert spark.read.parquet(out).count() == landed.count()


def test_stream_latest(spark, tmp_path):
    source = tmp_path / "in"
    write(source, "a.jsonl", body("x", 1), body("y", 5, 1))
    write(source, "b.jsonl", body("x", 2, 9), body("y", 4, 7), body("z", 1, cond=""))
    latest = streams.stream_latest_report(streams.stream_land(spark, str(source), AT, max_files=1))
    query = latest.writeStream.format("memory").queryName("latest").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination()
    got = spark.table("latest").select("sid", F.col("r.peers")).collect()
    batch = reshape.parsed_reports(reports.prepare_lines(reports.read_lines(spark, str(source)), AT))
    assert sorted(map(tuple, got)) == sorted(map(tuple, batch.select("sid", "r.peers").collect())) == [("x", 9), ("y", 1)]


def test_newest_by_span_is_exact_after_all(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    write(source, "a.jsonl", body("x", 1), body("y", 5, 1))
    write(source, "b.jsonl", body("x", 2, 9), body("y", 4, 7), body("z", 1, cond=""))
    lines = streams.stream_land(spark, str(source), AT, max_files=1)
    spans = streams.stream_newest_by_span(lines, "1 second", "1 second")
    streams.land_to(spans, out, str(tmp_path / "cp")).awaitTermination()
    time.sleep(3)  # a later arrival closes the spans before it
    write(source, "c.jsonl", body("late", 1))
    streams.land_to(spans, out, str(tmp_path / "cp")).awaitTermination()
    got = reshape.parsed_reports(spark.read.parquet(out)).select("sid", "r.peers").collect()
    assert sorted(map(tuple, got)) == [("x", 9), ("y", 1)]
