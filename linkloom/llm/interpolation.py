"""Word n-gram scoring by deleted interpolation.

The probability of a word after another mixes three estimates: the pair's relative
frequency after its context, the word's relative frequency, and a uniform share over
the known words and one unknown. The weights depend on how often the context was seen
(buckets of doubling counts), and expectation-maximisation learns them on counts from
which the token at hand is deleted, so that every training token is held out once.

A document's tokens are its words, A-Z folded, and one end; the end also stands in
front of each first word as its context, so the counts of contexts are those of words.

Counts of all training documents are needed for every token of every document, which
no broadcast can hold. Documents are read into blocks of a few million tokens. Each
block asks for its distinct words and pairs once: sorted 64-bit keys with the block's
own training counts, cut by key range. One task per range adds up what all blocks sent
and answers each block with totals in the block's order, so answers carry no keys. The
shuffled volume follows the distinct pairs per block, not the tokens, and no text moves.
Statistics for the weights are a histogram of bounded size, summed over all blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm import common

# White space cannot be part of a word, so this names the end of a document.
END = b"\n"
BLOCK_TOKENS = 2_000_000
# Keys that one range's task adds up, at most about.
RANGE_KEYS = 2_000_000
WORD, PAIR = 0, 1
EM_ROUNDS = 60
# Histogram cells per doubling of a probability, and doublings covered; smaller ones fall into the last cell.
STEPS, DOUBLINGS = 4, 40
CELLS = STEPS * DOUBLINGS + 2
BUCKETS = 64


class _Ids(dict):
    """Word -> its number in the block, in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def _sorted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order that sorts keys, and each key's place in it."""
    order = np.argsort(keys)
    rank = np.empty(len(order), np.int32)
    rank[order] = np.arange(len(order), dtype=np.int32)
    return order, rank


def _steps(keys: np.ndarray) -> np.ndarray:
    return np.diff(keys, prepend=np.uint64(0))


def _pressed(values: np.ndarray) -> bytes:
    """Bytes of equal weight side by side, compressed: differences of sorted keys and counts have idle upper bytes."""
    return zstandard.ZstdCompressor(level=3).compress(values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes())


def _unpressed(data: bytes, kind) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


@dataclass(frozen=True)
class Weights:
    """Per bucket the weights of pair, word and uniform estimate; training tokens and types."""

    mixed: np.ndarray
    n_tokens: int
    n_types: int


def _bucket(count: np.ndarray) -> np.ndarray:
    """0 for contexts never seen, else one more than the whole doublings of the count."""
    return np.frexp(count.astype(np.float64))[1].astype(np.int64)


def read_blocks(docs: DataFrame, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Blocks of whole documents: the words' sorted hashes, the stream of their numbers, and the documents.

    ``docs`` has doc_id, text and held_out. Null texts count as empty. A document longer
    than a block makes a block of its own.
    """
    names = ["block", "n_tokens", "doc_ids", "held", "starts", "stream", "words"]

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0
        ids, stream, doc_ids, held, starts = _Ids(), [], [], [], [0]

        def block() -> pa.RecordBatch:
            keys = common.hashes(list(ids))
            order, rank = _sorted(keys)
            return pa.RecordBatch.from_arrays([
                pa.array([part << 24 | made]), pa.array([starts[-1]]), pa.array([doc_ids], pa.list_(pa.int64())), pa.array([held], pa.list_(pa.bool_())),
                pa.array([np.array(starts, np.int64).tobytes()]), pa.array([_pressed(rank[np.concatenate(stream)])]), pa.array([_pressed(_steps(keys[order]))]),
            ], names)

        for batch in rows:
            for doc_id, text, out in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if not stream:
                    stream.append(np.array([ids[END]], np.int32))
                found = common.words(text)
                found.append(END)
                stream.append(np.fromiter(map(ids.__getitem__, found), np.int32, len(found)))
                doc_ids.append(doc_id), held.append(out), starts.append(starts[-1] + len(found))
                if starts[-1] >= block_tokens:
                    yield block()
                    made += 1
                    ids, stream, doc_ids, held, starts = _Ids(), [], [], [], [0]
        if doc_ids:
            yield block()

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string"), "held_out")
    made = rows.mapInArrow(run, "block long, n_tokens long, doc_ids array<long>, held array<boolean>, starts binary, stream binary, words binary")
    return common.stored(made, "blocks")


class Block:
    """A block's arrays: sorted word and pair keys, and per token the places of its word and its pair among them."""

    def __init__(self, row: dict):
        self.doc_ids, self.held = row["doc_ids"], np.array(row["held"], bool)
        self.starts = np.frombuffer(row["starts"], np.int64)
        self.words = np.cumsum(_unpressed(row["words"], np.uint64), dtype=np.uint64)
        places = _unpressed(row["stream"], np.int32)
        self.first, self.token = places[0], places[1:]
        size = len(self.words)
        codes, pair = np.unique(places[:-1].astype(np.int64) * size + self.token, return_inverse=True)
        keys = common.mix(common.mix(self.words[codes // size] + np.uint64(1)) + self.words[codes % size])
        order, rank = _sorted(keys)
        self.pairs, self.pair = keys[order], rank[pair]
        self.training = np.repeat(~self.held, np.diff(self.starts))


def _ask(blocks: DataFrame, ranges: int) -> DataFrame:
    """Requests: kind, range, block, sorted keys (as differences) and the block's training counts."""
    edges = (np.arange(1, ranges, dtype=np.float64) / ranges * 2.0**64).astype(np.uint64)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for row in batch.to_pylist():
                block = Block(row)
                for kind, keys, place in ((WORD, block.words, block.token), (PAIR, block.pairs, block.pair)):
                    counts = np.bincount(place[block.training], minlength=len(keys)).astype(np.uint32)
                    cuts = [0, *np.searchsorted(keys, edges).tolist(), len(keys)]
                    out = []
                    for k in range(ranges):
                        part = keys[cuts[k]:cuts[k + 1]]
                        if len(part):
                            asked = {"keys": _pressed(_steps(part)), "counts": _pressed(counts[cuts[k]:cuts[k + 1]])}
                            out.append({"kind": kind, "range": k, "block": row["block"]} | asked)
                    yield pa.RecordBatch.from_pylist(out, _REQUEST)

    return blocks.mapInArrow(run, "kind int, range int, block long, keys binary, counts binary")


_REQUEST = pa.schema([("kind", pa.int32()), ("range", pa.int32()), ("block", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])


def _add_up(rows: pa.Table) -> pa.Table:
    """One range's totals for each block that asked, and the range's training tokens and types."""
    asked = [np.cumsum(_unpressed(k, np.uint64), dtype=np.uint64) for k in rows.column("keys").to_pylist()]
    counts = np.concatenate([_unpressed(c, np.uint32) for c in rows.column("counts").to_pylist()]).astype(np.int64)
    sizes = np.cumsum([len(k) for k in asked])[:-1]
    _, place = np.unique(np.concatenate(asked), return_inverse=True)
    totals = np.zeros(place.max() + 1, np.int64)
    np.add.at(totals, place, counts)
    n = rows.num_rows
    first = lambda value: [int(value)] + [0] * (n - 1)
    return pa.table({
        "block": rows.column("block"), "kind": rows.column("kind"), "range": rows.column("range"),
        "totals": pa.array([_pressed(t) for t in np.split(totals[place].astype(np.uint64), sizes)], pa.binary()),
        "n_tokens": first(totals.sum()), "n_types": first(np.count_nonzero(totals)),
    })


_RESOLVED = "doc_ids array<long>, held array<boolean>, starts binary, seen_first long, seen_token binary, seen_pair binary"


def _resolve(block: pa.Table, answers: pa.Table) -> pa.Table:
    """A block with the training counts of each token and of its pair, and of the first token's context."""
    made = []
    for row in block.to_pylist():
        own = Block(row)
        found = {WORD: [], PAIR: []}
        for answer in sorted(answers.select(["kind", "range", "totals"]).to_pylist(), key=lambda r: (r["kind"], r["range"])):
            found[answer["kind"]].append(_unpressed(answer["totals"], np.uint64).astype(np.int64))
        words, pairs = np.concatenate(found[WORD]), np.concatenate(found[PAIR])
        made.append({
            "doc_ids": row["doc_ids"], "held": row["held"], "starts": row["starts"],
            "seen_first": int(words[own.first]), "seen_token": _pressed(words[own.token]), "seen_pair": _pressed(pairs[own.pair]),
        })
    schema = pa.schema([
        ("doc_ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())), ("starts", pa.binary()),
        ("seen_first", pa.int64()), ("seen_token", pa.binary()), ("seen_pair", pa.binary()),
    ])
    return pa.Table.from_pylist(made, schema)


def count(blocks: DataFrame, range_keys: int = RANGE_KEYS) -> tuple[DataFrame, int, int]:
    """Blocks with training counts per token, the number of training tokens, and that of training types."""
    total = blocks.agg(F.sum("n_tokens")).first()[0] or 0
    ranges = 1 << max(0, int(np.ceil(np.log2(max(1.0, total / range_keys)))))
    answers = _ask(blocks, ranges).groupBy("kind", "range").applyInArrow(
        _add_up, "block long, kind int, range int, totals binary, n_tokens long, n_types long")
    answers = common.stored(answers, "answers")
    sums = answers.where(F.col("kind") == WORD).agg(F.sum("n_tokens"), F.sum("n_types")).first()
    resolved = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_resolve, _RESOLVED)
    return common.stored(resolved, "counted-blocks"), int(sums[0] or 0), int(sums[1] or 0)


def _counts(row: dict) -> tuple[np.ndarray, ...]:
    """Training counts of each token's context, which is the token before, of the token, and of the pair."""
    token = _unpressed(row["seen_token"], np.int64)
    return np.concatenate([[row["seen_first"]], token[:-1]]), token, _unpressed(row["seen_pair"], np.int64)


def _cell(p: np.ndarray) -> np.ndarray:
    """0 for impossible, else the cell of a probability on a logarithmic grid."""
    with np.errstate(divide="ignore"):
        place = np.clip(-np.log2(p) * STEPS, 0, CELLS - 2)
    return np.where(p > 0, place.astype(np.int64) + 1, 0)


def learn(counted: DataFrame, n_tokens: int, n_types: int) -> Weights:
    """Weights per bucket from all training tokens, each deleted from the counts it is judged by."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for row in batch.to_pylist():
                training = np.repeat(~np.array(row["held"], bool), np.diff(np.frombuffer(row["starts"], np.int64)))
                context, token, pair = (x[training] - 1 for x in _counts(row))
                p_pair = np.where(context > 0, pair / np.maximum(context, 1), 0.0)
                p_word = token / max(n_tokens - 1, 1)
                code = (_bucket(context) * CELLS + _cell(p_pair)) * CELLS + _cell(p_word)
                codes, place = np.unique(code, return_inverse=True)
                sums = [np.bincount(place, weights=w, minlength=len(codes)) for w in (None, p_pair, p_word)]
                yield pa.RecordBatch.from_arrays([pa.array(codes), *(pa.array(s.astype(float)) for s in sums)], ["code", "n", "pair", "word"])

    grouped = counted.mapInArrow(run, "code long, n double, pair double, word double").groupBy("code")
    # at most buckets x cells x cells rows, whatever the corpus
    cells = grouped.agg(F.sum("n").alias("n"), F.sum("pair").alias("pair"), F.sum("word").alias("word")).orderBy("code").toPandas()
    uniform = 1 / (n_types + 1)
    n = cells["n"].to_numpy()
    p = np.stack([cells["pair"].to_numpy() / np.maximum(n, 1), cells["word"].to_numpy() / np.maximum(n, 1), np.full(len(n), uniform)])
    bucket = (cells["code"] // (CELLS * CELLS)).to_numpy()

    def fit(rows: np.ndarray, pairs: bool) -> np.ndarray:
        mixed = np.array([1.0, 1.0, 1.0]) if pairs else np.array([0.0, 1.0, 1.0])
        mixed /= mixed.sum()
        for _ in range(EM_ROUNDS if rows.any() else 0):
            share = mixed[:, None] * p[:, rows]
            mixed = ((share / share.sum(axis=0)) * n[rows]).sum(axis=1) / n[rows].sum()
        # no estimate ever becomes impossible
        mixed = np.maximum(mixed, [1e-6 if pairs else 0.0, 1e-6, 1e-6])
        return mixed / mixed.sum()

    every = fit(np.ones(len(n), bool), True)
    mixed = np.tile(every, (BUCKETS, 1))
    mixed[0] = fit(bucket == 0, False)
    for k in range(1, BUCKETS):
        if (bucket == k).any():
            mixed[k] = fit(bucket == k, True)
    if not n_tokens:
        mixed[:] = [0.0, 0.0, 1.0]
    return Weights(mixed, n_tokens, n_types)


def score(counted: DataFrame, weights: Weights) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score (log10), a row per document."""
    schema = pa.schema([
        ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
        ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()),
    ])
    total, types = weights.n_tokens, weights.n_types

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for row in batch.to_pylist():
                context, token, pair = _counts(row)
                starts = np.frombuffer(row["starts"], np.int64)
                mixed = weights.mixed[_bucket(context)]
                p = mixed[:, 0] * pair / np.maximum(context, 1) + mixed[:, 1] * token / max(total, 1) + mixed[:, 2] / (types + 1)
                base = np.log10((token + 1) / (total + types + 1))
                add = lambda x: np.add.reduceat(x, starts[:-1])
                n = len(row["doc_ids"])
                yield pa.RecordBatch.from_arrays([
                    pa.array(row["doc_ids"], pa.int64()), pa.array(row["held"], pa.bool_()), pa.array(np.diff(starts)),
                    pa.array(add((token > 0).astype(np.int64))), pa.array(np.full(n, total)), pa.array(add(base)), pa.array(add(np.log10(p))),
                ], schema=schema)

    return counted.mapInArrow(run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def score_documents(docs: DataFrame) -> DataFrame:
    """Learn from the rows of ``docs(doc_id, text, held_out)`` that are not held out, and score all."""
    counted, n_tokens, n_types = count(read_blocks(docs))
    return score(counted, learn(counted, n_tokens, n_types))
