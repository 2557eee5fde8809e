"""The chunked way must equal the plain way, whatever the chunk size."""

import random

import pytest
from pyspark.sql import functions as F

from linkloom.operators.chains import FRESH, chunk_entries
from linkloom.operators.history import History, first_at_or_after, join_hot_safe
from linkloom.session import BROADCAST_ROWS_CONF


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(7)
    data = [("hot", t, rng.choice([None, rng.randint(0, 50)])) for t in range(200)]
    data += [(k, t, rng.randint(0, 9)) for k in ("a", "b", None) for t in range(9)]
    rng.shuffle(data)
    return spark.createDataFrame(data, "k string, t int, v int").repartition(4).cache()


def plain_and_chunked(rows, build):
    out = []
    for limit in (10**6, 13):
        history = History(rows, ["k"], ["t"], limit=limit)
        assert history.chunked == (limit == 13)
        out.append(sorted(map(tuple, build(history).rows().collect()), key=repr))
    return out


def test_previous_is_equal_across_chunks(rows):
    plain, chunked = plain_and_chunked(
        rows, lambda h: h.previous(pv=F.col("v"), pt=F.col("t")).previous(ppt=F.col("pt"))
    )
    assert plain == chunked


def test_running_is_equal_across_chunks(rows):
    plain, chunked = plain_and_chunked(
        rows,
        lambda h: h.running(
            s=("sum", F.col("v")),
            hi=("max", F.col("v"), False),
            lo=("min", F.col("v")),
            seen=("last", F.col("v"), False),
            n=("sum", F.lit(1)),
        ),
    )
    assert plain == chunked


def test_ties_do_not_depend_on_arrival_or_chunks(spark):
    rng = random.Random(9)
    data = [(k, t // 4, rng.randint(0, 9)) for k in ("hot", "hot", "a") for t in range(60)]
    build = lambda h: h.previous(pv=F.col("v")).running(s=("sum", F.col("v")), seen=("last", F.col("v"), False))
    out = [plain_and_chunked(spark.createDataFrame(some, "k string, t int, v int").repartition(3), build) for some in (data, data[::-1])]
    assert out[0][0] == out[0][1] == out[1][0] == out[1][1]


def test_only_hot_keys_are_chunked(spark):
    data = [("hot", t) for t in range(50)] + [(k, t) for k in ("a", None) for t in range(9)]
    chunks = History(spark.createDataFrame(data, "k string, t int"), ["k"], ["t"], limit=13).df.select("k", "_chunk").distinct().collect()
    assert {r._chunk for r in chunks if r.k != "hot"} == {-1} and sum(r.k == "hot" for r in chunks) >= 4


@pytest.mark.parametrize("limit", [10**6, 5])
def test_first_at_or_after(spark, limit):
    left = spark.createDataFrame([("a", 5), ("a", 6), ("a", 99), ("b", 1)], "k string, at int")
    right = spark.createDataFrame(
        [("a", t) for t in (1, 6, 8, 9, 10, 11, 12)] + [("c", 3)], "k string, t int"
    )
    got = first_at_or_after(left, right, ["k"], "at", "t", "hit", limit=limit)
    assert sorted(map(tuple, got.collect())) == [
        ("a", 5, 6), ("a", 6, 6), ("a", 99, None), ("b", 1, None),
    ]


@pytest.mark.parametrize("limit, broadcast", [(10**6, 10), (10**6, 0), (5, 0)])
def test_join_hot_safe(spark, limit, broadcast):
    spark.conf.set(BROADCAST_ROWS_CONF, str(broadcast))
    big = spark.createDataFrame([("h", i) for i in range(20)] + [("c", 1), ("x", 2)], "k string, i int")
    small = spark.createDataFrame([("h", "H"), ("c", "C")], "k string, name string")
    got = join_hot_safe(big, small, ["k"], "left", limit=limit)
    spark.conf.unset(BROADCAST_ROWS_CONF)
    assert got.count() == 22
    assert got.where("name = 'H'").count() == 20
    assert got.where("name is null").count() == 1


def test_chunk_entries_chain_maps(spark):
    maps = spark.createDataFrame(
        [("k", 0, [FRESH], [7]), ("k", 1, [5, 7], [50, 70]), ("k", 2, [50], [51]), ("k", 3, [70], [90]),
         ("j", 0, [FRESH], [3]), ("j", 9, [4], [12])],
        "k string, _chunk int, entries array<bigint>, exits array<bigint>",
    )
    got = {(r.k, r._chunk): r.entry for r in chunk_entries(maps, ["k"]).collect()}
    assert got == {
        ("k", 0): FRESH, ("k", 1): 7, ("k", 2): 70, ("k", 3): 70, ("j", 0): FRESH, ("j", 9): 3,
    }
