"""Named tables under a layer root, marts, and the two CSV formats."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from linkloom import schemas


def _path(root: str, name: str) -> str:
    return root.rstrip("/") + "/" + name


def read_layer(spark: SparkSession, root: str, name: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(_path(root, name))


def write_layer(
    df: DataFrame,
    root: str,
    name: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partition_by: str | None = None,
) -> None:
    writer = df.write.format(fmt).mode(mode)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.save(_path(root, name))


def write_layers(tables: dict[str, DataFrame], root: str) -> None:
    """Independent tables, written at once: what one leaves idle at its end the others use."""
    if not tables:
        return
    spark = next(iter(tables.values())).sparkSession
    with ThreadPoolExecutor(len(tables)) as pool:
        writes = [
            pool.submit(inheritable_thread_target(spark)(write_layer), df, root, name)
            for name, df in tables.items()
        ]
    for write in writes:
        write.result()


def read_mart(
    spark: SparkSession, root: str, name: str, order_by: list[str] | str | None = None
) -> DataFrame:
    """Order belongs to the read: files have none that lasts."""
    mart = read_layer(spark, root, name)
    return order_mart(mart, order_by) if order_by else mart


def order_mart(mart: DataFrame, keys: list[str] | str) -> DataFrame:
    return mart.orderBy(*([keys] if isinstance(keys, str) else keys))


def read_device_energy(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, schema=schemas.ENERGY_READING, header=True)


def write_burst_csv(bursts: DataFrame, path: str) -> None:
    """Per-burst rows as CSV part files."""
    bursts.write.mode("overwrite").option("header", True).csv(path)
