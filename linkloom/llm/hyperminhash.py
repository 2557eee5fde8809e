"""Near-duplicate documents by HyperMinHash sketches, with every link confirmed on full sets.

A document's word shingles are hashed once. The hash's first bits choose one of 128
buckets; a bucket's register holds the least of the remaining bits in compressed form,
its count of leading zeros and the ten bits after the first one: 16 bits in place of
64. Registers of empty buckets are borrowed from others by a fixed order per bucket
for banding only, so that short documents band as reliably as long ones. Four
registers make a band, 32 bands a document; a pair at similarity 0.85 shares no band
with a chance below 10^-10, one at 0.8 below 10^-7.

Documents that share a band are candidates, but no bucket is expanded into pairs:

1. Exact copies (equal word sequences) are one node, whatever ids their rows have. Nodes
   are named by a row of theirs, components by the smallest doc_id only at the end.
2. Each band bucket compares its members to one pivot, the member whose buckets hold
   the most nodes. A pair survives if its Jaccard estimate from the registers, less the
   matches that compression makes by chance, is within six standard errors of the bound.
   Members that fail against the pivot get a pivot of their own while they are many;
   a few thousand left in a bucket are estimated against each other in blocks. A member
   that failed may still be linked to one that survived: it is estimated against all of
   the pivot's cluster, in blocks, and tied to it if any estimate survives.
3. Survivors are verified on full shingle sets. Nodes joined by survivors form a
   cluster, nodes joined by verified links a component. Where a cluster holds several
   components, the nodes outside its largest one are verified against all of the
   cluster, in blocks, so no link between candidates is lost; a block returns only the
   links that join different components.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkloom.llm import common
from linkloom.llm.components import components
from linkloom.operators import history

BUCKET_BITS, MANTISSA_BITS = 7, 10
BUCKETS = 1 << BUCKET_BITS
ROWS_PER_BAND = 4
BANDS = BUCKETS // ROWS_PER_BAND
STANDARD_ERRORS = 6
BLOCK = 256
# A bucket with more members left than this chooses another pivot, for some rounds.
BLOCK_MEMBERS = 4096
PIVOT_ROUNDS = 8

# For each bucket the order in which it looks for another that is not empty.
_BORROW = np.stack([np.random.default_rng(k).permutation(BUCKETS) for k in range(BUCKETS)])
_BAND_SALT = common.mix(np.arange(1, BANDS + 1, dtype=np.uint64))


@dataclass(frozen=True)
class Rule:
    """Shingle length and the bound: similar if 100 * intersection >= percent * union."""

    words: int = 5
    percent: int = 80


def shingles(found: list[bytes], size: int) -> np.ndarray:
    """Sorted distinct hashes of a word list's shingles; a list shorter than a shingle is one."""
    if not found:
        return np.empty(0, np.uint64)
    return np.unique(common.windows(common.hashes(found), min(size, len(found))))


def registers(elements: np.ndarray) -> np.ndarray:
    """Compressed minima of the buckets, 0 where empty; ``elements`` are sorted, so minima come first."""
    made = np.zeros(BUCKETS, np.uint16)
    bucket, first = np.unique(elements >> np.uint64(64 - BUCKET_BITS), return_index=True)
    rest = (elements[first] << np.uint64(BUCKET_BITS)) | np.uint64(1)
    zeros = (64 - np.frexp(rest.astype(np.float64))[1]).clip(0, 63).astype(np.uint64)
    mantissa = ((rest << zeros) >> np.uint64(63 - MANTISSA_BITS)) & np.uint64((1 << MANTISSA_BITS) - 1)
    made[bucket.astype(np.int64)] = ((zeros + np.uint64(1)).clip(0, 63) << np.uint64(MANTISSA_BITS)) | mantissa
    return made


def bands(made: np.ndarray) -> np.ndarray:
    """Band keys of a document with at least one shingle."""
    full = made > 0
    if not full.all():
        empty = np.flatnonzero(~full)
        order = _BORROW[empty]
        made = made.copy()
        made[empty] = made[order[np.arange(len(empty)), full[order].argmax(axis=1)]]
    return common.mix(made.view(np.uint64) + _BAND_SALT).view(np.int64)


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Jaccard estimates of register rows and the number of registers each rests on.

    Different minima compress to equal registers with a chance of about
    0.16992 * 2^-r * 4nm / (n + m)^2, the expected collisions of the sketch's authors;
    it is taken out of the share of equal registers.
    """
    used = ((a > 0) | (b > 0)).sum(axis=-1)
    equal = ((a == b) & (a > 0)).sum(axis=-1) / np.maximum(used, 1)
    sizes = n_a.astype(float) + n_b
    chance = 0.169919487159739093975315012348 * 2.0 ** -MANTISSA_BITS * 4 * n_a * n_b / np.maximum(sizes, 1) ** 2
    return np.clip((equal - chance) / (1 - chance), 0, 1), used


def _survives(a, b, n_a, n_b, percent: int) -> np.ndarray:
    found, used = estimate(a, b, n_a, n_b)
    bound = percent / 100
    return found >= bound - STANDARD_ERRORS * np.sqrt(bound * (1 - bound) / np.maximum(used, 1))


def _rows(docs: DataFrame, *keep: str) -> DataFrame:
    """doc_id, text, the kept columns, and rid, which finds a row again: the id, or a hash of the text where there is none."""
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), *keep)
    return texts.withColumn("rid", F.coalesce("doc_id", F.xxhash64("text")))


def _key(found: list[bytes]) -> np.ndarray:
    """128 bits of a word sequence."""
    return np.frombuffer(xxhash.xxh3_128_digest(b" ".join(found)), np.int64)


def sketch(rows: DataFrame, rule: Rule, keep: list[str] | None = None) -> DataFrame:
    """doc_id, rid, n_shingles, copy_key (128 bits of the word sequence), registers, bands and the kept columns; one row per row of ``rows``."""
    keep = keep or []
    names = ["doc_id", "rid", *keep]
    made_names = ["n_shingles", "key_a", "key_b", "registers", "bands"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 2048):
                part = batch.slice(start, 2048)
                sizes, keys, regs, band = [], [], [], []
                for text in part.column(len(names)).to_pylist():
                    found = common.words(text)
                    elements = shingles(found, rule.words)
                    sizes.append(len(elements))
                    keys.append(_key(found))
                    made = registers(elements)
                    regs.append(made.tobytes())
                    band.append(bands(made) if len(elements) else None)
                key = np.array(keys, np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([
                    *part.columns[:len(names)], pa.array(sizes, pa.int64()), pa.array(key[:, 0].copy()), pa.array(key[:, 1].copy()),
                    pa.array(regs, pa.binary()), pa.array(band, pa.list_(pa.int64())),
                ], [*names, *made_names])

    sent = rows.select(*names, "text")
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in sent.schema.fields[:-1])
    return sent.mapInArrow(run, f"{kept}, n_shingles long, key_a long, key_b long, registers binary, bands array<long>")


def full_sets(docs: DataFrame, wanted: DataFrame, rule: Rule) -> DataFrame:
    """node and its whole shingle set as sorted 64-bit hashes, for ``wanted(node, rid, key_a, key_b)``.

    An id may have several texts: the copy key tells which one a node stands for. Rows
    that repeat a text may give a node its set more than once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[int] = set()
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                nodes, sets = [], []
                for text, node, a, b in zip(*(c.to_pylist() for c in batch.slice(start, 1024).columns), strict=True):
                    found = common.words(text)
                    if node not in done and _key(found).tolist() == [a, b]:
                        done.add(node)
                        nodes.append(node)
                        sets.append(shingles(found, rule.words).tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(sets, pa.binary())], ["node", "elements"])

    rows = _rows(docs).join(history.broadcast_if_small(wanted), "rid").select("text", "node", "key_a", "key_b")
    return rows.mapInArrow(run, "node long, elements binary")


def _alike(shared: int, n_a: int, n_b: int, percent: int) -> bool:
    return 100 * shared >= percent * (n_a + n_b - shared)


def estimated(pairs: DataFrame, nodes: DataFrame, rule: Rule) -> DataFrame:
    """Pairs (a, b) whose register estimate does not rule the bound out."""
    held = lambda end: nodes.select(
        F.col("node").alias(end), F.col("registers").alias(f"r_{end}"), F.col("n_shingles").alias(f"n_{end}"))
    both = pairs.join(held("a"), "a").join(held("b"), "b").select("a", "b", "r_a", "r_b", "n_a", "n_b")

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            if not batch.num_rows:
                continue
            r_a, r_b = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint16).reshape(-1, BUCKETS) for k in (2, 3))
            keep = _survives(r_a, r_b, batch.column(4).to_numpy(), batch.column(5).to_numpy(), rule.percent)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return both.mapInArrow(run, "a long, b long")


def verified(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """Pairs (a, b) whose full sets reach the bound."""
    held = lambda end: sets.select(F.col("node").alias(end), F.col("elements").alias(f"s_{end}"))
    both = pairs.join(held("a"), "a").join(held("b"), "b").select("a", "b", "s_a", "s_b")

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            keep = []
            for s_a, s_b in zip(batch.column(2), batch.column(3), strict=True):
                x, y = (np.frombuffer(s.as_buffer(), np.uint64) for s in (s_a, s_b))
                keep.append(_alike(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y), rule.percent))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(run, "a long, b long")


def _pivot_pairs(members: DataFrame, rule: Rule) -> DataFrame:
    """For members (bucket, node, n, weight): bucket, node, and the bucket's pivot with its size."""
    first = F.struct(-F.col("weight"), "node", "n")
    pivots = members.groupBy("bucket").agg(F.min(first).alias("_p"), F.min("node").alias("_low"), F.max("node").alias("_high"))
    pivots = pivots.where("_low < _high").select("bucket", F.col("_p.node").alias("pivot"), F.col("_p.n").alias("pivot_n"))
    return members.join(pivots, "bucket").where("node <> pivot")


def _sized(n_a, n_b, rule: Rule):
    """The bound can only be reached if the smaller set is that share of the larger."""
    return 100 * F.least(n_a, n_b) >= rule.percent * F.greatest(n_a, n_b)


def _in_blocks(few: DataFrame, every: DataFrame, compare, schema: str) -> DataFrame:
    """Compare the rows of ``few`` to those of ``every`` in the same group, block by block.

    Both have ``group`` and ``node`` and the same columns; each is cut into blocks of
    about 256, and each pair of blocks is one group for ``compare``, which gets the few
    (side 0) and the others (side 1). Rows are copied once per block they meet, so few
    against many cost one pass over the many. Groups' sizes are sent to where their rows
    lie, so a large group is dealt without being gathered.
    """
    blocks = lambda side: F.ceil(F.count_if(F.col("side") == side) / F.lit(BLOCK)).cast("int")
    rows = few.withColumn("side", F.lit(0)).unionByName(every.withColumn("side", F.lit(1)))
    sizes = rows.groupBy("group").agg(blocks(0).alias("_few"), blocks(1).alias("_all")).where("_few > 0 and _all > 0")
    rows = rows.join(history.broadcast_if_small(common.stored(sizes, "group-sizes")), "group")
    deal = lambda n: F.pmod(F.xxhash64("node"), n).cast("int")
    x = F.when(F.col("side") == 0, F.array(deal(F.col("_few")))).otherwise(F.sequence(F.lit(0), F.col("_few") - 1))
    y = F.when(F.col("side") == 1, F.array(deal(F.col("_all")))).otherwise(F.sequence(F.lit(0), F.col("_all") - 1))
    dealt = rows.withColumn("x", F.explode(x)).withColumn("y", F.explode(y)).drop("_few", "_all")
    return dealt.groupBy("group", "x", "y").applyInArrow(compare, schema)


def _estimate_blocks(rule: Rule, first_only: bool):
    """Pairs that survive; with ``first_only`` one for each of the few, and both orders of a pair count."""

    def compare(rows: pa.Table) -> pa.Table:
        side = rows.column("side").to_numpy()
        node, size = rows.column("node").to_numpy(), rows.column("n").to_numpy()
        regs = np.frombuffer(b"".join(rows.column("registers").to_pylist()), np.uint16).reshape(-1, BUCKETS)
        few, every = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        found = [(np.empty(0, np.int64), np.empty(0, np.int64))]
        for k in few.tolist():
            others = every if first_only else every[node[every] > node[k]]
            small, large = np.minimum(size[others], size[k]), np.maximum(size[others], size[k])
            others = others[100 * small >= rule.percent * large]
            if len(others):
                keep = others[_survives(regs[k], regs[others], size[k], size[others], rule.percent)][:1 if first_only else None]
                found.append((np.full(len(keep), node[k]), node[keep]))
        return pa.table({"a": np.concatenate([a for a, _ in found]), "b": np.concatenate([b for _, b in found])})

    return compare


def _verify_blocks(rule: Rule):
    def compare(rows: pa.Table) -> pa.Table:
        side, node = rows.column("side").to_numpy(), rows.column("node").to_numpy()
        label = {int(x): int(c) for x, c in zip(node, rows.column("component").to_numpy(), strict=True)}
        few, every = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        top: dict[int, int] = {}

        def root(x: int) -> int:
            while top.get(x, x) != x:
                x = top[x]
            return x

        sets = [np.frombuffer(s.as_buffer(), np.uint64) for s in rows.column("elements").combine_chunks()]
        found: list[tuple[int, int]] = []
        if len(few) and len(every):
            codes = np.unique(np.concatenate([sets[k] for k in every]), return_inverse=True)
            starts = np.concatenate([[0], np.cumsum([len(sets[k]) for k in every])])[:-1]
            sizes = np.array([len(sets[k]) for k in every])
            for k in few.tolist():
                place = np.searchsorted(codes[0], sets[k])
                place[place == len(codes[0])] = 0
                mark = np.zeros(len(codes[0]), np.int64)
                mark[place[codes[0][place] == sets[k]]] = 1
                shared = np.add.reduceat(mark[codes[1]], starts)
                union = len(sets[k]) + sizes - shared
                for j in np.flatnonzero(100 * shared >= rule.percent * union).tolist():
                    a, b = int(node[k]), int(node[every[j]])
                    x, y = root(label[a]), root(label[b])
                    if x != y:
                        top[x] = y
                        found.append((a, b))
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    return compare


def candidates(nodes: DataFrame, rule: Rule) -> DataFrame:
    """Pairs (a, b) not ruled out by their registers, which tie together what may be linked.

    Of two nodes that share a band, either their registers rule the bound out, or both lie
    in one connected part of these pairs: members of a bucket that survive against the
    same pivot do by that; members that fail against it go on to the next; and of one
    that survives and one that fails, the latter is compared to the former's whole part.
    """
    banded = nodes.select("node", F.col("n_shingles").alias("n"), F.explode("bands").alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("weight")).where("weight > 1")
    members = common.stored(banded.join(shared, "bucket"), "band-members")
    weights = members.groupBy("node").agg(F.sum("weight").alias("weight"))
    members = common.stored(members.drop("weight").join(weights, "node"), "band-members")
    found = failed = None
    for _ in range(PIVOT_ROUNDS):
        starred = _pivot_pairs(members, rule)
        near = starred.where(_sized(F.col("n"), F.col("pivot_n"), rule))
        pairs = near.select(F.col("node").alias("a"), F.col("pivot").alias("b")).distinct()
        kept = common.stored(estimated(pairs, nodes, rule), "candidates")
        found = kept if found is None else found.unionByName(kept)
        # members that survived against their pivot are tied to it; the others go on among themselves
        rest = starred.join(kept, (starred["node"] == kept["a"]) & (starred["pivot"] == kept["b"]), "left_anti")
        members = common.stored(rest.select("bucket", "node", "n", "weight", "pivot"), "band-members")
        apart = members.select("node", "pivot")
        failed = apart if failed is None else failed.unionByName(apart)
        members = members.drop("pivot")
        again = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("_c")).where("_c > 1")
        most = again.agg(F.max("_c")).first()[0] or 0
        if most <= BLOCK_MEMBERS:
            break
    described = nodes.select("node", F.col("n_shingles").alias("n"), "registers")
    if most:
        left = members.join(again, "bucket").select(F.col("bucket").alias("group"), "node").join(described, "node")
        found = found.unionByName(common.stored(_in_blocks(left, left, _estimate_blocks(rule, False), "a long, b long").distinct(), "candidates"))
    return found.unionByName(_across(found, failed, described, rule))


def _across(found: DataFrame, failed: DataFrame, described: DataFrame, rule: Rule) -> DataFrame:
    """One pair for each node and part of ``found`` of which a pivot, but not every member, is ruled out for the node."""
    parts = components(found)
    own = failed.join(parts.select(F.col("node").alias("pivot"), F.col("component").alias("group")), "pivot").select("node", "group").distinct()
    own = own.join(parts, "node", "left").where(F.col("component").isNull() | (F.col("component") != F.col("group"))).select("node", "group")
    own = common.stored(own, "across")
    if own.isEmpty():
        return found.limit(0)
    groups = history.broadcast_if_small(common.stored(own.select("group").distinct(), "across-groups"))
    members = parts.withColumnRenamed("component", "group").join(groups, "group", "left_semi")
    few, every = (rows.select("group", "node").join(described, "node") for rows in (own, members))
    return common.stored(_in_blocks(few, every, _estimate_blocks(rule, True), "a long, b long").distinct(), "candidates")


def _labelled(nodes: DataFrame, labels: DataFrame, name: str) -> DataFrame:
    """``nodes`` with the component of each ``name`` in place of it; unlabelled ones stay themselves."""
    known = labels.select(F.col("node").alias(name), F.col("component").alias("_label"))
    return nodes.join(known, name, "left").withColumn(name, F.coalesce("_label", name)).drop("_label")


def linked(docs: DataFrame, nodes: DataFrame, rule: Rule) -> DataFrame:
    """Components of the nodes with a verified link: node, component."""
    pairs = candidates(nodes, rule)
    involved = common.stored(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), "involved")
    wanted = common.stored(nodes.select("node", "rid", "key_a", "key_b").join(involved, "node"), "wanted")
    sets = common.stored(full_sets(docs, wanted, rule), "sets")
    parts = components(verified(pairs, sets, rule))
    # candidates whose ends came apart tie components to clusters
    apart = _labelled(_labelled(pairs, parts, "a"), parts, "b").where("a <> b")
    clusters = components(apart).select(F.col("node").alias("component"), F.col("component").alias("group"))
    if clusters.isEmpty():
        return parts
    tops = history.broadcast_if_small(clusters)
    placed = common.stored(_labelled(involved.withColumn("component", F.col("node")), parts, "component").join(tops, "component"), "clustered")
    sizes = placed.groupBy("group", "component").agg(F.count(F.lit(1)).alias("size"))
    main = sizes.groupBy("group").agg(F.max(F.struct("size", "component")).alias("_top")).select(F.col("_top.component").alias("component"))
    members = placed.join(sets, "node")
    others = placed.join(history.broadcast_if_small(common.stored(main, "main")), "component", "left_anti").join(sets, "node")
    more = common.stored(_in_blocks(others, members, _verify_blocks(rule), "a long, b long"), "links")
    if more.isEmpty():
        return parts
    joined = components(_labelled(_labelled(more, parts, "a"), parts, "b"))
    ends = more.select(F.col("a").alias("node")).union(more.select("b"))
    alone = ends.join(parts, "node", "left_anti").distinct().withColumn("component", F.col("node"))
    return _labelled(parts.unionByName(alone), joined, "component").select("node", "component")


def near_groups(docs: DataFrame, rule: Rule = Rule(), keep: list[str] | None = None) -> DataFrame:
    """Groups of near copies in ``docs(doc_id, text)``: doc_id, n_shingles, component_id, kept, first, and the columns of ``keep``.

    A row per row of ``docs``. component_id is the smallest doc_id reachable over links
    and copies, kept marks it. first marks one row of each group, of those with the
    smallest doc_id, or any if none has an id. Null and empty texts have no shingles and
    stay alone. Rows that repeat a doc_id with another text are documents of their own
    under one id; rows without a doc_id take part like all others, but only first can
    mark them: their component_id is null and kept is false.
    """
    keep = keep or []
    made = sketch(_rows(docs, *keep), rule, keep)
    made = common.stored(made.withColumn("row", F.monotonically_increasing_id()), "sketches")
    usable = made.where("n_shingles > 0")
    # of a copy's rows the one with the smallest id stands for it
    lowest = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row"))
    copies = common.stored(usable.groupBy("key_a", "key_b").agg(lowest.alias("_low")).select("key_a", "key_b", F.col("_low.doc_id").alias("low"), F.col("_low.row").alias("node")), "copies")
    own = copies.select(F.col("node").alias("row"))
    nodes = usable.join(own, "row", "left_semi").select(F.col("row").alias("node"), "rid", "key_a", "key_b", "n_shingles", "registers", "bands")
    nodes = common.stored(nodes, "nodes")
    joined = linked(docs, nodes, rule)
    grouped = copies.join(joined, "node", "left").withColumn("_group", F.coalesce("component", "node"))
    top = F.min(F.struct(F.col("low").isNull(), "low", "node"))
    names = grouped.groupBy("_group").agg(top.alias("_top")).select("_group", F.col("_top.low").alias("_name"), F.col("_top.node").alias("_first"))
    named = grouped.join(names, "_group").select("key_a", "key_b", "_name", "_first")
    rows = made.select("doc_id", "n_shingles", "key_a", "key_b", "row", *keep)
    # empty texts have one key among them, but no row in ``named``
    found = rows.join(named, ["key_a", "key_b"], "left")
    alone = F.col("n_shingles") == 0
    component = F.when(F.col("doc_id").isNull(), F.lit(None)).when(alone, F.col("doc_id")).otherwise(F.col("_name"))
    return found.select("doc_id", "n_shingles", component.alias("component_id"), (alone | (F.col("row") == F.col("_first"))).alias("first"), *keep).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
