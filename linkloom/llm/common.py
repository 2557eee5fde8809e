"""Helpers the training-data operators share: scratch tables, shared files, words."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from linkloom import session as settings

# A-Z to a-z and nothing else; in UTF-8 these bytes never occur inside another character.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

_FOLDERS: list[str] = []


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the checkpoint folder, which the driver and all executors reach."""
    settings.use_checkpoints(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
    _FOLDERS.append(folder)
    return folder


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    Cuts lineage like a checkpoint, but columnar, so later steps read only the
    columns they use, and the rows outlive any executor.
    """
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_scratch(spark: SparkSession) -> None:
    """Delete what this session's operators left in the shared folder; call once results are written."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    while _FOLDERS:
        path = jvm.org.apache.hadoop.fs.Path(_FOLDERS.pop())
        path.getFileSystem(conf).delete(path, True)


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a location in the shared folder."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), re.sub("^file:/+", "/", uri)
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def write_file(uri: str, parts: Iterator[bytes] | list[bytes]) -> int:
    """Write a file whole: under a name of its own first, then renamed.

    Callers put the attempt's id into the name, and a manifest row names the file, so
    of a task that ran twice only the files of the attempt Spark took are ever read.
    """
    store, path = filesystem(uri)
    store.create_dir(os.path.dirname(path), recursive=True)
    context = TaskContext.get()
    own = f"{path}.{context.taskAttemptId() if context else 0}.tmp"
    size = 0
    with store.open_output_stream(own, compression=None) as out:
        for part in parts:
            out.write(part)
            size += len(part)
    store.move(own, path)
    return size


def read_file(uri: str) -> pa.Buffer:
    store, path = filesystem(uri)
    with store.open_input_file(path) as source:
        return source.read_buffer()


def words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z folded: bytes.split cuts at exactly these characters."""
    return text.encode("utf-8", "surrogatepass").translate(LOWER).split() if text else []


def batches(rows: Iterator[dict], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches."""
    held: list[dict] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def partitions_for(spark: SparkSession, minimum: int = 1) -> int:
    """Partitions of a costly step: what the session sets for shuffles, at least a core each."""
    return max(minimum, int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def hashes(found: list[bytes]) -> np.ndarray:
    """64-bit hashes of words; two of n different words share one with a chance below n^2 / 2^65."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))


def mix(values: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values: a bijection, so it adds no collisions."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def windows(found: np.ndarray, size: int) -> np.ndarray:
    """A hash per window of ``size`` consecutive word hashes."""
    n = len(found) - size + 1
    total = found[:n].copy()
    for k in range(1, size):
        total = mix(total + np.uint64(0x9E3779B97F4A7C15)) + found[k:k + n]
    return mix(total)
