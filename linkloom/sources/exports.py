"""Whole-file JSON exports: discovery, landing, trial files."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom import schemas
from linkloom.functions.scalars import TRIAL_PATTERN, peer_count, record_type, regex_extract

EXPORT_GLOB = "wsn-*.json"


def classify_record_type(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split by filename into typed rows and rejected rows; nothing is dropped unseen."""
    typed = files.withColumn("record_type", record_type("source_file"))
    known = typed.where(F.col("record_type").isNotNull())
    return known, typed.where(F.col("record_type").isNull()).drop("record_type")


def keep_exports(files: DataFrame) -> DataFrame:
    """Rows whose ``source_file`` is a per-run JSON export of a known type."""
    return classify_record_type(files.where(F.col("source_file").endswith(".json")))[0].drop(
        "record_type"
    )


def stamp_provenance(df: DataFrame, ingested_at: str) -> DataFrame:
    """Where a row came from. The ingest time is an argument, so a rerun lands the same rows."""
    return df.withColumns(
        {
            "record_type": record_type("source_file"),
            "peer_count": peer_count("source_file"),
            "ingested_at": F.lit(ingested_at),
        }
    )


# Folders that written exports are spread over, so that they are listed by as many tasks.
FOLDERS = 1024
# Bytes of payloads a reading task hands over at once.
BATCH_BYTES = 16 << 20


def _store(root: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(root) if "://" in root or root.startswith("file:") else (fs.LocalFileSystem(), root)


def _local(spark: SparkSession, root: str) -> str | None:
    """The folder, if the root names one that tasks reach as a plain path; other stores are left to Spark's readers."""
    if any(c in root for c in "*?[]{}"):
        return None
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    uri = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toUri()
    return uri.getPath() if uri.getScheme() == "file" else None


def _names(spark: SparkSession, root: str, glob: str) -> DataFrame:
    """Exports under a folder: path and source_file. Tasks list the folders, so the driver holds no names.

    As Spark's own readers do, files lie in the root itself or in folders named
    ``key=value``; names that begin with ``_`` or ``.`` and empty files are left out.
    """

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = fs.LocalFileSystem()
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                found = [
                    (e.path, e.type == fs.FileType.File) for e in store.get_file_info(fs.FileSelector(folder))
                    if e.base_name[:1] not in ("_", ".") and e.size != 0
                ]
                yield pa.RecordBatch.from_pydict({
                    "path": pa.array([f for f, _ in found], pa.string()), "is_file": pa.array([kind for _, kind in found], pa.bool_()),
                })

    entry = "path string, is_file boolean"
    top = spark.range(1).select(F.lit(root).alias("path")).mapInArrow(listed, entry)
    name = F.element_at(F.split("path", "/"), -1)
    folders = top.where(~F.col("is_file") & name.contains("=")).select("path").repartition(spark.sparkContext.defaultParallelism)
    files = top.unionByName(folders.mapInArrow(listed, entry)).where("is_file")
    pattern = spark._jvm.org.apache.hadoop.fs.GlobPattern(glob).compiled().pattern()
    return files.select("path", name.alias("source_file")).where(F.col("source_file").rlike(f"^(?:{pattern})$"))


def _files(spark: SparkSession, root: str, glob: str) -> DataFrame:
    """Payload and name of every export, each file read by the task its name was dealt to."""
    folder = _local(spark, root)
    if folder is None:
        return (
            spark.read.option("pathGlobFilter", glob)
            .text(root, wholetext=True)
            .select(F.col("value").alias("payload"), F.col("_metadata.file_name").alias("source_file"))
        )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = fs.LocalFileSystem()
        made = lambda: pa.RecordBatch.from_pydict({"payload": pa.array(payloads, pa.binary()), "source_file": pa.array(names, pa.string())})
        for batch in batches:
            payloads, names, size = [], [], 0
            for path, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with store.open_input_stream(path, compression=None) as source:
                    payloads.append(source.read())
                names.append(name)
                size += len(payloads[-1])
                if size > BATCH_BYTES:
                    yield made()
                    payloads, names, size = [], [], 0
            yield made()

    dealt = _names(spark, folder, glob).repartition(spark.sparkContext.defaultParallelism)
    return dealt.mapInArrow(read, "payload binary, source_file string").select(F.col("payload").cast("string").alias("payload"), "source_file")


def write_exports(files: DataFrame, root: str) -> int:
    """Write rows (source_file, payload) as one file each under a root that every executor reaches; returns their number.

    A file costs far more than its row, so rows are dealt to all cores however few splits
    they come in. Files lie in ``FOLDERS`` folders by a hash of their name. They are written
    under a name of the attempt's own and renamed, so a task that runs twice leaves whole
    files only. A name that repeats keeps one of its payloads.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = _store(root)
        own = f"_{TaskContext.get().taskAttemptId()}.tmp"
        store.create_dir(path, recursive=True)
        written, made = 0, set()
        for batch in batches:
            for name, payload, folder in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if folder not in made:
                    store.create_dir(f"{path}/part={folder}", recursive=True)
                    made.add(folder)
                with store.open_output_stream(f"{path}/{own}", compression=None) as out:
                    out.write((payload or "").encode())
                store.move(f"{path}/{own}", f"{path}/part={folder}/{name}")
                written += 1
        yield pa.RecordBatch.from_pydict({"n": pa.array([written], pa.int64())})

    folder = F.pmod(F.xxhash64("source_file"), F.lit(FOLDERS)).alias("folder")
    dealt = files.select("source_file", "payload", folder).repartition(files.sparkSession.sparkContext.defaultParallelism)
    return dealt.mapInArrow(write, "n long").agg(F.sum("n")).first()[0] or 0


def discover_exports(spark: SparkSession, root: str, glob: str = EXPORT_GLOB) -> DataFrame:
    """Names of the exports under a root, sorted. Only names are read, not contents."""
    folder = _local(spark, root)
    if folder is None:
        listed = (
            spark.read.format("binaryFile").option("pathGlobFilter", glob).load(root)
            .select(F.element_at(F.split("path", "/"), -1).alias("source_file"))
        )
    else:
        listed = _names(spark, folder, glob).select("source_file")
    return keep_exports(listed).orderBy("source_file")


def land_json_exports(
    spark: SparkSession, root: str, ingested_at: str, glob: str = EXPORT_GLOB
) -> DataFrame:
    """One row per export: the payload verbatim plus provenance, in a single scan."""
    landed = stamp_provenance(_files(spark, root, glob), ingested_at)
    return landed.where(F.col("record_type").isNotNull()).select(*schemas.RAW_JSON.names)


def parse_trials(files: DataFrame) -> DataFrame:
    """Per-condition trial exports. The KPIs may be nested or be the whole body."""
    tagged = files.withColumn("condition", regex_extract("source_file", TRIAL_PATTERN)).where(
        F.col("condition").isNotNull()
    )
    nested = F.from_json("payload", schemas.payload("trial"))
    whole = F.from_json("payload", schemas.payload("kpis"))
    return tagged.withColumn("r", nested).select(
        "source_file",
        "condition",
        F.coalesce("r.kpis", whole).alias("kpis"),
        F.col("r.links").alias("links"),
    )


def read_trial_exports(spark: SparkSession, root: str) -> DataFrame:
    return parse_trials(_files(spark, root, "wsn-voice-*trial*.json"))
