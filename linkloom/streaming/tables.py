"""Tables that micro-batches change in place: newest rows by key, and landing that remembers all it landed.

Both stand on ``Slots``: a table cut in slots, each slot's rows in the folder of the batch
that wrote it last. A batch writes the slots it touches anew and then, in one small file,
which batch every slot stands in. That file is the commit: a batch that fails before it
leaves nothing readers see, a batch that is replayed finds its own and does nothing.
Readers of an older commit keep their files until ``vacuum``.
"""

from __future__ import annotations

import json
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType

from linkloom.operators.reshape import filter_known_condition, latest_report_per_session, time_of_report
from linkloom.schemas import RAW_STREAM
from linkloom.sources.reports import redelivery_key

# Slots of a table of newest rows: a batch of few keys touches few of them.
SLOTS = 256
# Bits of a slot's first filter. A filter takes a key for every KEY_BITS of its bits, which keeps false answers below one
# in a thousand; then a larger one is begun, with room for as many keys as the slot has, so a slot has few of them.
FILTER_BITS = 1 << 20
KEY_BITS = 16
MOST_BITS = 1 << 30
PROBES = 7
FILTERS = "slot string, bits binary, held long"


class Slots:
    """A table of rows with a string column ``slot``, replaced slot by slot."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._at = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._at(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _commits(self) -> list[int]:
        folder = self._at(f"{self.path}/commits")
        if not self._fs.exists(folder):
            return []
        names = [status.getPath().getName() for status in self._fs.listStatus(folder)]
        return sorted(int(name) for name in names if name.isdigit())

    def _commit(self, batch: int) -> dict:
        source = self._fs.open(self._at(f"{self.path}/commits/{batch:020d}"))
        try:
            return json.loads(bytes(source.readAllBytes()).decode())
        finally:
            source.close()

    def state(self) -> tuple[int, dict[str, int], StructType | None]:
        """The last commit: its batch, the batch that wrote each slot, and the rows' schema."""
        commits = self._commits()
        if not commits:
            return -1, {}, None
        found = self._commit(commits[-1])
        return commits[-1], found["slots"], StructType.fromJson(found["schema"])

    def done(self, batch: int) -> bool:
        return self.state()[0] >= batch

    def read(self, only: Callable[[str], bool] | None = None) -> DataFrame | None:
        """Rows of all slots, or of those ``only`` names; None if there are none."""
        _, slots, schema = self.state()
        wanted = {slot: batch for slot, batch in slots.items() if only is None or only(slot)}
        if not wanted:
            return None
        paths = [f"{self.path}/batch={batch}/slot={slot}" for slot, batch in sorted(wanted.items())]
        whole = StructType([*schema.fields, StructField("batch", LongType()), StructField("slot", StringType())])
        return self.spark.read.schema(whole).option("basePath", self.path).parquet(*paths).drop("batch")

    def replace(self, rows: DataFrame, batch: int) -> set[str]:
        """Write the slots in ``rows`` anew as of ``batch`` and commit; the others stay. Returns the slots written."""
        last, slots, _ = self.state()
        if last >= batch:
            return set()
        folder = f"{self.path}/batch={batch}"
        rows.write.mode("overwrite").partitionBy("slot").parquet(folder)
        made = {
            s.getPath().getName().removeprefix("slot=") for s in self._fs.listStatus(self._at(folder)) if s.getPath().getName().startswith("slot=")
        }
        schema = StructType([f for f in rows.schema.fields if f.name != "slot"])
        body = json.dumps({"slots": slots | dict.fromkeys(made, batch), "schema": json.loads(schema.json())})
        target = self._at(f"{self.path}/commits/{batch:020d}")
        own = self._at(f"{self.path}/commits/_{batch}")
        out = self._fs.create(own, True)
        out.write(bytearray(body.encode()))
        out.close()
        self._fs.rename(own, target)
        return made

    def vacuum(self, keep: int = 2) -> None:
        """Delete what none of the last ``keep`` commits reads, older commits too."""
        commits = self._commits()
        old, kept = commits[:-keep], commits[-keep:]
        needed = {(slot, batch) for c in kept for slot, batch in self._commit(c)["slots"].items()}
        known = {(slot, batch) for c in old for slot, batch in self._commit(c)["slots"].items()}
        for slot, batch in known - needed:
            self._fs.delete(self._at(f"{self.path}/batch={batch}/slot={slot}"), True)
        for c in old:
            self._fs.delete(self._at(f"{self.path}/commits/{c:020d}"), False)


# Newest report per session


def _slot(keys: list[str], slots: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(slots)).cast("string").alias("slot")


def _newest(lines: DataFrame) -> DataFrame:
    timed = lines.withColumn("_time", time_of_report())
    return latest_report_per_session(timed, ["cond", "sid"], "_time", ["line"]).drop("_time")


def upsert_newest(lines: DataFrame, batch: int, table: Slots, slots: int = SLOTS) -> set[str]:
    """Merge a micro-batch's newest line of each (condition, session) into the table; returns the slots rewritten.

    The batch is reduced first, so a slot receives a row per session. Slots no session of
    the batch lies in are neither read nor written.
    """
    if table.done(batch):
        return set()
    came = _newest(filter_known_condition(lines).select(*RAW_STREAM.names)).select("*", _slot(["cond", "sid"], slots))
    came = came.persist()
    try:
        touched = {r["slot"] for r in came.select("slot").distinct().collect()}  # SLOTS at most
        if not touched:
            return set()
        held = table.read(touched.__contains__)
        merged = came if held is None else _newest(came.unionByName(held))
        return table.replace(merged.repartition("slot"), batch)
    finally:
        came.unpersist()


def stream_upsert_latest(lines: DataFrame, path: str, checkpoint: str, slots: int = SLOTS) -> StreamingQuery:
    """Keep the newest line per session of a stream in the table at ``path`` (read it with ``latest_lines``)."""

    def merge(df: DataFrame, batch: int) -> None:
        upsert_newest(df, batch, Slots(df.sparkSession, path), slots)

    return lines.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(merge).start()


def latest_lines(spark: SparkSession, path: str) -> DataFrame:
    """Newest lines by session; empty before the first batch."""
    rows = Slots(spark, path).read()
    return spark.createDataFrame([], RAW_STREAM) if rows is None else rows.drop("slot")


# Landing once, however late a copy comes


def _place(hashed: np.ndarray, probe: int, bits: int) -> np.ndarray:
    """A bit a key sets: steps of its second half from its first."""
    first, second = hashed & np.uint64(0xFFFFFFFF), (hashed >> np.uint64(32)) | np.uint64(1)
    return ((first + second * np.uint64(probe)) % np.uint64(bits)).astype(np.int64)


def _probe(keys: pa.Table, filters: pa.Table) -> pa.Table:
    """Keys that one of the filters may hold."""
    hashed = keys.column("_hash").to_numpy().view(np.uint64)
    maybe = np.zeros(len(hashed), bool)
    for bits in filters.column("bits"):
        held = np.frombuffer(bits.as_buffer(), np.uint8)
        left = np.flatnonzero(~maybe)
        for probe in range(PROBES):
            place = _place(hashed[left], probe, 8 * len(held))
            left = left[(held[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1]
        maybe[left] = True
    return keys.filter(pa.array(maybe))


def _filled(keys: pa.Table, filters: pa.Table) -> pa.Table:
    """The slot's filters with the keys added to one that has room for them, else to a new one."""
    made = [np.frombuffer(bits.as_buffer(), np.uint8) for bits in filters.column("bits")]
    rooms = [8 * len(bits) // KEY_BITS for bits in made]
    held = [room if n is None else n for n, room in zip(filters.column("held").to_pylist(), rooms, strict=True)]
    at = next((k for k, room in enumerate(rooms) if held[k] + len(keys) <= room), len(made))
    if at == len(made):
        wanted = 1 << (KEY_BITS * (sum(held) + len(keys)) - 1).bit_length()
        made.append(np.zeros(min(max(wanted, FILTER_BITS), MOST_BITS) // 8, np.uint8))
        held.append(0)
    made[at], held[at] = made[at].copy(), held[at] + len(keys)
    hashed = keys.column("_hash").to_numpy().view(np.uint64)
    for probe in range(PROBES):
        place = _place(hashed, probe, 8 * len(made[at]))
        np.bitwise_or.at(made[at], place >> 3, np.uint8(1) << (place & 7).astype(np.uint8))
    slot = keys.column("slot")[0].as_py()
    return pa.table({"slot": pa.array([slot] * len(made), pa.string()), "bits": pa.array([b.tobytes() for b in made], pa.binary()), "held": pa.array(held, pa.int64())})


class LandedOnce:
    """A landing table at ``path`` that takes each report once, whatever time lies between its copies.

    Beside the rows (``rows/batch=…``) lie the keys of all that was landed, by day of
    arrival and part (``keys``), and Bloom filters for each day and part, as large as its keys need. A batch is
    probed against the filters of its parts, of all days; only keys a filter may hold
    are compared to the keys themselves, in those parts alone. So a report that comes
    for the first time costs a look into filters, and nothing is dropped on a guess.
    """

    def __init__(self, spark: SparkSession, path: str, parts: int = 16):
        self.spark, self.path, self.parts = spark, path.rstrip("/"), parts
        self.filters = Slots(spark, f"{self.path}/filters")

    def _of_parts(self, parts: set[int]) -> Callable[[str], bool]:
        return lambda slot: int(slot.rsplit("-", 1)[1]) in parts

    def land(self, lines: DataFrame, batch: int) -> None:
        """Land a micro-batch's new reports; a batch that was landed before is left alone."""
        if self.filters.done(batch):
            return
        key = F.sha2(F.to_json(F.struct(*redelivery_key())), 256)
        keyed = lines.select("*", key.alias("_key"), F.xxhash64(key).alias("_hash")).withColumn("_part", F.pmod("_hash", F.lit(self.parts)).cast("int"))
        kept = F.max_by(F.struct(*lines.columns), F.col("line"))
        fresh = keyed.groupBy("_key", "_hash", "_part").agg(F.max("arrived").alias("_arrived"), kept.alias("_kept")).persist()
        try:
            met = {r["_part"] for r in fresh.select("_part").distinct().collect()}
            new = fresh.join(self._seen(fresh, met), "_key", "left_anti")
            day = F.date_format("_arrived", "yyyyMMdd")
            new = new.withColumn("slot", F.concat_ws("-", day, F.col("_part").cast("string"))).persist()
            try:
                new.select("_kept.*").write.mode("overwrite").parquet(f"{self.path}/rows/batch={batch}")
                new.select("_key", "_hash", "_part").write.mode("overwrite").partitionBy("_part").parquet(f"{self.path}/keys/batch={batch}")
                # the commit of the filters is the commit of the batch
                self.filters.replace(self._filters(new), batch)
            finally:
                new.unpersist()
        finally:
            fresh.unpersist()

    def _seen(self, fresh: DataFrame, met: set[int]) -> DataFrame:
        """Keys of the batch that were landed before."""
        filters = self.filters.read(self._of_parts(met))
        if filters is None:
            return fresh.select("_key").limit(0)
        held = filters.select(F.substring_index("slot", "-", -1).cast("int").alias("_part"), "bits")
        narrow = fresh.select("_key", "_hash", "_part")
        maybe = narrow.groupBy("_part").cogroup(held.groupBy("_part")).applyInArrow(_probe, "_key string, _hash long, _part int").persist()
        parts = [r["_part"] for r in maybe.select("_part").distinct().collect()]
        if not parts:
            return fresh.select("_key").limit(0)
        last = self.filters.state()[0]
        known = self.spark.read.schema("_key string, _hash long, _part int, batch long").parquet(f"{self.path}/keys")
        known = known.where(F.col("_part").isin(parts) & (F.col("batch") <= last))
        return maybe.select("_key").join(known.select("_key"), "_key", "left_semi")

    def _filters(self, new: DataFrame) -> DataFrame:
        days = {r["slot"] for r in new.select("slot").distinct().collect()}
        held = self.filters.read(days.__contains__)
        if held is None:
            held = self.spark.createDataFrame([], FILTERS)
        if "held" not in held.columns:  # written when a slot had one filter, which counts as full
            held = held.withColumn("held", F.lit(None).cast("long"))
        held = held.select("slot", "bits", "held")
        return new.select("slot", "_hash").groupBy("slot").cogroup(held.groupBy("slot")).applyInArrow(_filled, FILTERS)

    def read(self) -> DataFrame | None:
        """All rows landed by committed batches; None before the first."""
        last, _, _ = self.filters.state()
        if last < 0:
            return None
        rows = self.spark.read.option("basePath", f"{self.path}/rows").parquet(f"{self.path}/rows")
        return rows.where(F.col("batch") <= last).drop("batch")


def stream_land_once(lines: DataFrame, path: str, checkpoint: str, parts: int = 16) -> StreamingQuery:
    """Land a stream's reports once each, copies of any age left out (read them with ``LandedOnce.read``)."""

    def land(df: DataFrame, batch: int) -> None:
        LandedOnce(df.sparkSession, path, parts).land(df, batch)

    return lines.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(land).start()
