"""Explicit read schemas of the raw exports and reports, and the conformed fact grain.

Numbers a producer may emit as fractions are read as double: an int schema would
turn 24.75 into NULL without a trace.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

CANDIDATE_MIX = "struct<host:int, srflx:int, relay:int>"

KPI_FIELDS = (
    "links:int, iceAttempts:int, iceSuccessPct:double, setupMedianMs:double,"
    " setupP95Ms:double, relayPct:double, candidateMix:" + CANDIDATE_MIX + ","
    " latRawMedianMs:double, latRawP95Ms:double, latCalMedianMs:double,"
    " latCalP95Ms:double, glareTotal:int"
)
KPI = "struct<" + KPI_FIELDS + ">"

LINK = (
    "struct<index:int, detectedMs:double, connectedMs:double, setupMs:double, failed:boolean,"
    " candidateType:string, rttMs:double, latRawMs:double, latCalMs:double, glare:int>"
)

LINK_READING = (
    "struct<index:int, state:string, rttMs:int, jitterMs:int, lossPct:double, upKbps:int>"
)

SENSE_REPORT = (
    "struct<t:bigint, kind:string, pos:struct<x:int,y:int>, neighbors:int,"
    " links:array<" + LINK_READING + ">, energy:double, note:string>"
)

SERIES_POINT = "struct<t:bigint, pkts:bigint, samples:bigint, level:double>"

SENSE = "struct<samples:int, reports:int, suppressedPct:double>"

PAYLOADS = {
    "voice": (
        "exportedAt string, N int, holdMs int, perClient array<struct<client:string,"
        " pos:struct<x:int,y:int>, peers:int, kpis:" + KPI + ", meanUpKbps:double,"
        " energy:double, sense:" + SENSE + ">>"
    ),
    "realnet": (
        "cond string, sid string, ts bigint, peers int, kpis " + KPI + ","
        " links array<" + LINK + ">, sense " + SENSE
    ),
    "mobility": (
        "phases struct<initialForm:struct<ms:int>, teardown:struct<ms:int>,"
        " reconnect:struct<ms:int>>"
    ),
    "audiogap": (
        "valid boolean, audioStopAfterOutMs int, reconnectAudioGapMs int, totalSilenceMs int,"
        " awayTiles int, awayMs int, series array<" + SERIES_POINT + ">"
    ),
    "gracegap": (
        "absenceMs int, graceMs int, reconnectGapMs int, holdKbps double, stopAfterOutMs int,"
        " series array<" + SERIES_POINT + ">"
    ),
    "dtx": "source string, dtx boolean, uplinkKbps double, holdSec int, bytes bigint",
    "sensing": (
        "scenario string, holdMs int, kindCounts map<string,int>, clients map<string,"
        " struct<stats:" + SENSE + ", scenarioReports:int, reports:array<" + SENSE_REPORT + ">>>"
    ),
    "trial": "kpis " + KPI + ", links array<" + LINK + ">",
    "kpis": KPI_FIELDS,
}


def payload(record_type: str) -> StructType:
    """Read schema of one record type; needs a running session to be parsed."""
    return StructType.fromDDL(PAYLOADS[record_type])


def _table(**columns: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


_text, _int, _long, _double = StringType(), IntegerType(), LongType(), DoubleType()

RAW_JSON = _table(
    payload=_text, source_file=_text, record_type=_text, peer_count=_int, ingested_at=_text
)

# ``line`` is where a report stood in its log, in reading order.
RAW_STREAM = _table(
    payload=_text, cond=_text, sid=_text, ts=_text,
    line=_table(file=_text, block=_long, row=_long),
    source_file=_text, record_type=_text, ingested_at=_text,
)

LINK_FACT = _table(
    record_type=_text, source_file=_text, condition=_text, session_id=_text, n_peers=_int,
    client=_text, link_index=_int, setup_ms=_double, rtt_ms=_double, candidate_type=_text,
    lat_raw_ms=_double, glare=_int, ingested_at=_text,
)

ENERGY_READING = _table(
    device=_text, metric=_text, unit=_text, baseline=_double, with_voice=_double
)
