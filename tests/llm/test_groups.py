"""Near-duplicate groups against brute force, and the components under them."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from helpers import AWKWARD, documents, words_of
from pyspark.sql import functions as F

from linkloom.llm import common, hyperminhash
from linkloom.llm.components import components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text, size):
    found = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(found) < size:
        return {tuple(found)} if found else set()
    return set(zip(*(found[k:] for k in range(size)), strict=False))


def brute(rows, rule):
    """component by row, of rows with distinct ids."""
    sets = {d: shingle_set(t, rule.words) for d, t in rows}
    holders = {}
    for d, s in sets.items():
        for g in s:
            holders.setdefault(g, []).append(d)
    top = {d: d for d in sets}

    def root(d):
        while top[d] != d:
            d = top[d]
        return d

    for d, s in sets.items():
        for other, n in Counter(o for g in s for o in holders[g] if o > d).items():
            if 100 * n >= rule.percent * (len(s) + len(sets[other]) - n):
                a, b = sorted((root(d), root(other)))
                top[b] = a
    return {d: (len(sets[d]), root(d)) for d in sets}


def edited(words, rng, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = "x%d" % rng.randrange(10**6)
    return words


def corpus():
    """Copies, chains of near copies, a star around one text, pairs near the bound, and unrelated texts."""
    rng, rows = random.Random(11), []
    add = lambda words: rows.append((len(rows) * 3 + 1, " ".join(words)))
    for seed in range(40):
        add(words_of(seed, rng.randrange(3, 120)))
    base = words_of(1000, 200)
    for _ in range(30):
        add(base)
    for _ in range(150):  # around the bound to the base, mostly below it to each other
        add(edited(base, rng, rng.randrange(2, 9)))
    step = words_of(2000, 150)
    for _ in range(25):
        step = edited(step, rng, 2)
        add(step)
    for seed in range(3000, 3040):
        short = words_of(seed, rng.randrange(1, 14))
        add(short), add(edited(short, rng, 1)), add([w.upper() for w in short])
    shared = words_of(5000, 60)
    for seed in range(5001, 5030):
        add(words_of(seed, 300) + shared)
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("rule", [hyperminhash.Rule(3, 85), hyperminhash.Rule()])
def test_groups_are_those_of_brute_force(spark, rule):
    rows = corpus() + [(10**6, None), (10**6 + 1, ""), (10**6 + 2, " \n"), (10**6 + 3, "One"), (10**6 + 4, "one")]
    want = brute(rows, rule)
    got = {r.doc_id: r for r in hyperminhash.near_groups(documents(spark, rows), rule).collect()}
    assert len(got) == len(rows)
    assert {d: (r.n_shingles, r.component_id) for d, r in got.items()} == want
    assert all(r.kept == (r.component_id == d) for d, r in got.items())


def nested(variants, lengths, rule, seed=1):
    """Texts that are beginnings of one another beside many variants of the longest one.

    Variants hold the bands' pivots; a beginning that fails against a pivot by its size
    is linked to the next longer one, which does not.
    """
    rng, words = random.Random(seed), ["w%d" % k for k in range(400)]
    rows = [(k, " ".join(words[:n])) for k, n in enumerate(lengths)]
    for k in range(variants):
        text = list(words)
        for at in rng.sample(range(400), 6 if rule.words == 3 else 5):
            text[at] = "v%d_%d" % (k, at)
        rows.append((1000 + k, " ".join(text)))
    return rows


@pytest.mark.parametrize(("variants", "lengths", "rule"), [
    (100, [310, 345], hyperminhash.Rule(3, 85)), (600, [310, 345], hyperminhash.Rule()),
    (300, [165, 190, 220, 258, 300, 350], hyperminhash.Rule(3, 85)), (40, [104, 120, 230, 268, 310, 355], hyperminhash.Rule()),
])
def test_no_link_is_lost_between_survivors_and_the_rest(spark, variants, lengths, rule):
    rows = nested(variants, lengths, rule)
    want = {d: c for d, (_, c) in brute(rows, rule).items()}
    assert want[1] == want[0] == 0
    got = {r.doc_id: r.component_id for r in hyperminhash.near_groups(documents(spark, rows), rule).collect()}
    assert got == want


def test_links_between_families_of_near_copies(spark):
    """Families around texts at many similarities to each other, below and above the bound."""
    rng, rows, rule = random.Random(21), [], hyperminhash.Rule(3, 85)
    base = words_of(77, 260)
    for family in range(25):
        centre = edited(base, rng, rng.randrange(1, 30))
        centre = centre[: rng.randrange(200, 261)]
        for _ in range(rng.randrange(1, 25)):
            rows.append((len(rows), " ".join(edited(centre, rng, rng.randrange(0, 7)))))
    rng.shuffle(rows)
    got = {r.doc_id: r.component_id for r in hyperminhash.near_groups(documents(spark, rows), rule).collect()}
    assert got == {d: c for d, (_, c) in brute(rows, rule).items()}


def test_awkward_rows(spark):
    got = hyperminhash.near_groups(documents(spark, AWKWARD)).collect()
    assert len(got) == len(AWKWARD)
    by = {r.doc_id: r for r in got}
    assert by[None].component_id is None and not by[None].kept
    assert by[2].component_id == 2 and by[2].n_shingles == 0 and by[2].kept
    assert by[8].component_id == 7 and not by[8].kept and by[7].kept
    assert hyperminhash.near_groups(documents(spark, [])).collect() == []


def test_ids_that_repeat_or_are_missing(spark):
    a, b, c, d = (" ".join(words_of(k, 90)) for k in (1, 2, 3, 4))
    near = lambda text: text.rsplit(" ", 1)[0]
    rows = [(5, a), (5, b), (3, near(a)), (None, near(b)), (None, c), (None, near(c)), (None, c), (None, d), (9, d), (5, a), (None, None), (8, "")]
    df = documents(spark, rows).withColumn("at", F.monotonically_increasing_id())
    got = {r["at"]: r for r in hyperminhash.near_groups(df, keep=["at"]).collect()}
    got = [got[k] for k in sorted(got)]
    assert len(got) == len(rows)
    assert [r.component_id for r in got] == [3, 5, 3, None, None, None, None, None, 9, 3, None, 8]
    assert [r.kept for r in got] == [False, True, True, False, False, False, False, False, True, False, False, True]
    # one row of each group is its first: those with the smallest id, or any where none has one
    first = [r.first for r in got]
    assert [first[k] for k in (0, 1, 2, 3, 7, 8, 9, 10, 11)] == [False, True, True, False, False, True, False, True, True]
    assert sum(first[k] for k in (4, 5, 6)) == 1


@pytest.mark.parametrize("members", [1, 4096])
def test_members_left_by_pivots_are_compared(spark, monkeypatch, members):
    monkeypatch.setattr(hyperminhash, "BLOCK_MEMBERS", members)
    monkeypatch.setattr(hyperminhash, "BLOCK", 16)
    rows, rule = corpus(), hyperminhash.Rule(3, 85)
    got = {r.doc_id: r.component_id for r in hyperminhash.near_groups(documents(spark, rows), rule).collect()}
    assert got == {d: c for d, (_, c) in brute(rows, rule).items()}


def test_registers_and_estimates():
    rng = np.random.default_rng(1)
    pool = common.mix(rng.integers(0, 2**63, 4000, dtype=np.uint64))
    a, b = np.unique(pool[:3000]), np.unique(pool[1000:])
    made = [hyperminhash.registers(x) for x in (a, b)]
    found, used = hyperminhash.estimate(made[0][None], made[1][None], np.array([len(a)]), np.array([len(b)]))
    assert used[0] == hyperminhash.BUCKETS and abs(found[0] - 0.5) < 0.2
    assert (hyperminhash.registers(a[:0]) == 0).all()
    few = hyperminhash.registers(a[:5])
    assert (few > 0).sum() <= 5 and len(hyperminhash.bands(few)) == hyperminhash.BANDS
    # a register is the least element of its bucket, compressed
    bucket = a >> np.uint64(57)
    least = [int(a[bucket == k].min()) << 7 & (2**64 - 1) | 1 for k in range(128)]
    want = [((64 - x.bit_length()) + 1) << 10 | (x << (64 - x.bit_length()) >> 53) & 1023 for x in least]
    assert np.mean(made[0] == np.array(want)) > 0.99


def test_components(spark):
    rng = random.Random(4)
    chain = [(k, k + 1) for k in range(100, 220)]
    star = [(500, k) for k in range(300, 400)]
    some = [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(70)]
    edges = chain + star + some + [(7, 7), (None, 3), (100, 101)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    top = {}

    def root(x):
        while top.setdefault(x, x) != x:
            x = top[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = sorted((root(a), root(b)))
            top[y] = x
    assert got == {x: root(x) for x in list(top)}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
