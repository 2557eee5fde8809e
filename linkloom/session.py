"""Session settings the operators rely on."""

from __future__ import annotations

import io
import pathlib
import tempfile
import zipfile
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

# Rows of one key that a single task may walk in order. Keys above it are cut
# into range chunks (see operators/history.py).
HOT_ROWS_CONF = "spark.linkloom.hotRows"
DEFAULT_HOT_ROWS = 2_000_000

# Largest side that is broadcast by hand; anything bigger is left to a shuffle.
BROADCAST_ROWS_CONF = "spark.linkloom.broadcastRows"
DEFAULT_BROADCAST_ROWS = 200_000


def local_session(app: str = "linkloom", cores: str = "*", **conf: str) -> SparkSession:
    """A session for tests, benches and single-machine use. Clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per session; without it their Python workers cannot load it.

    The archive holds source files only and lies in the shared folder, so nothing needs to
    be installed on the cluster and a query may be started from any folder.
    """
    context = spark.sparkContext
    if getattr(context, "_linkloom_shipped", False):
        return
    package = pathlib.Path(__file__).resolve().parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as archive:
        for source in sorted(package.rglob("*.py")):
            archive.write(source, source.relative_to(package.parent))
    use_checkpoints(spark)
    path = spark._jvm.org.apache.hadoop.fs.Path(context.getCheckpointDir() + "/linkloom.zip")
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
    out.write(packed.getvalue())
    out.close()
    context.addPyFile(path.toString())
    context._linkloom_shipped = True


def hot_rows(spark: SparkSession) -> int:
    return int(spark.conf.get(HOT_ROWS_CONF, str(DEFAULT_HOT_ROWS)))


def broadcast_rows(spark: SparkSession) -> int:
    return int(spark.conf.get(BROADCAST_ROWS_CONF, str(DEFAULT_BROADCAST_ROWS)))


def use_checkpoints(spark: SparkSession) -> None:
    """Point reliable checkpoints at the folder the cluster names.

    Executors must all reach the folder, so a machine-local one is only taken
    when the master itself is local and nothing else is set.
    """
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        context.setCheckpointDir(folder)
    elif context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="linkloom-checkpoint-"))
    else:
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")


def at_once(spark: SparkSession, steps: dict[str, Callable[[], DataFrame]]) -> dict[str, DataFrame]:
    """Independent steps that run jobs, side by side: cores that one leaves idle at its end serve the others."""
    use_checkpoints(spark)
    with ThreadPoolExecutor(len(steps)) as pool:
        running = {name: pool.submit(inheritable_thread_target(spark)(step)) for name, step in steps.items()}
    return {name: step.result() for name, step in running.items()}


def fill_cores(df: DataFrame) -> DataFrame:
    """Spread a scan that has fewer splits than there are cores, ahead of costly row work.

    Only the number of splits is asked for, nothing is read; a table large enough
    to keep the cluster busy passes through without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
