"""SentencePiece models on the tokenizers library: encoding, decoding, and proof of parity.

The model file is a protobuf message; the few fields needed are read from its wire
format. From them a tokenizer is rebuilt: the normaliser (the model's character map,
white space rules, the metaspace marker), the model itself (unigram scores, or for a
BPE model merges ranked by the merged piece's score) and byte fallback. White space
never lies inside a piece after its first other character; where the vocabulary
confirms that, a text is cut in front of each run of markers, and each distinct part
is encoded once per worker. New parts are encoded in batches by the library's own
threads, and each is checked against SentencePiece, ids and decoded text both.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

from linkloom.llm import common

MARK = "▁"
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
# Distinct parts of a generation, of which a worker keeps two: parts met again move to the newer one.
MAX_PARTS = 250_000


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and raw values of a protobuf message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 0x7F) << shift
            if byte < 0x80:
                return value
            shift += 7

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
            continue
        size = {1: 8, 2: None, 5: 4}[kind]
        size = varint() if size is None else size
        yield tag >> 3, data[at:at + size]
        at += size


@dataclass
class PieceModel:
    """What a model file says; field numbers are those of sentencepiece_model.proto."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    unk_id: int = 0
    charsmap: bytes = b""
    dummy_prefix: bool = True
    remove_extra: bool = True
    escape: bool = True

    @classmethod
    def parse(cls, data: bytes) -> PieceModel:
        model = cls()
        for number, value in _fields(data):
            if number == 1:
                text, score, kind = "", 0.0, NORMAL
                for n, v in _fields(value):
                    if n == 1:
                        text = v.decode("utf-8")
                    elif n == 2:
                        (score,) = struct.unpack("<f", v)
                    elif n == 3:
                        kind = v
                model.pieces.append((text, score, kind))
            elif number == 2:
                spec = dict(_fields(value))
                model.kind = spec.get(3, UNIGRAM)
                model.byte_fallback = bool(spec.get(35, 0))
                model.unk_id = spec.get(40, 0)
            elif number == 3:
                spec = dict(_fields(value))
                model.charsmap = spec.get(2, b"")
                model.dummy_prefix = bool(spec.get(3, 1))
                model.remove_extra = bool(spec.get(4, 1))
                model.escape = bool(spec.get(5, 1))
        return model

    def merges(self) -> list[tuple[str, str]]:
        """Pairs of pieces that join to a piece, best merged score first, as the BPE trainer found them."""
        score = {text: s for text, s, kind in self.pieces if kind in (NORMAL, USER_DEFINED, UNUSED)}
        ids = {text: k for k, (text, _, _) in enumerate(self.pieces)}
        found = []
        for text, s in score.items():
            cuts = [(text[:k], text[k:]) for k in range(1, len(text))]
            pairs = [(ids[a], ids[b], a, b) for a, b in cuts if a in score and b in score]
            found += [(-s, ids[text], *pair) for pair in sorted(pairs)]
        found.sort(key=lambda m: (m[0], m[1]))
        return [(a, b) for *_, a, b in found]

    def cut_at_marks(self) -> bool:
        """Whether no piece holds a marker behind another character, or a line feed."""
        return self.escape and not any(MARK in text.lstrip(MARK) or "\n" in text for text, _, kind in self.pieces if kind != CONTROL)

    def tokenizer(self) -> Tokenizer:
        if self.kind == BPE:
            vocab = {text: k for k, (text, _, _) in enumerate(self.pieces)}
            model = models.BPE(vocab, self.merges(), unk_token=self.pieces[self.unk_id][0], fuse_unk=True, byte_fallback=self.byte_fallback, cache_capacity=0)
        elif self.kind == UNIGRAM:
            model = models.Unigram([(text, s) for text, s, _ in self.pieces], unk_id=self.unk_id, byte_fallback=self.byte_fallback)
        else:
            raise ValueError("only unigram and BPE models are supported")
        built = Tokenizer(model)
        steps = []
        if self.charsmap:
            steps.append(normalizers.Precompiled(self.charsmap))
        if self.remove_extra:
            steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
        if self.dummy_prefix:
            steps.append(normalizers.Prepend(MARK if self.escape else " "))
        if self.escape:
            steps.append(normalizers.Replace(" ", MARK))
        if steps:
            built.normalizer = normalizers.Sequence(steps)
        if self.cut_at_marks():
            built.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARK}*[^{MARK}]+|{MARK}+"), "isolated")
        undo = [decoders.Replace(MARK, " ")] if self.escape else []
        if self.byte_fallback:
            undo.append(decoders.ByteFallback())
        undo.append(decoders.Fuse())
        if self.dummy_prefix:
            undo.append(decoders.Strip(" ", 1, 0))
        built.decoder = decoders.Sequence(undo)
        return built


class Backend:
    """A worker's tokenizer with its proven parts.

    ``encode`` gives ids (little-endian uint32), whether they are SentencePiece's and both
    decode alike, and whether the text comes back. A part is what stands between single
    spaces, and ends before a line feed; a text with longer runs of spaces is encoded and
    checked whole. Parts prove their text: no piece holds a marker behind another
    character, so neither library joins anything across a part's first marker, a text's
    ids are its parts' ids in a row, and its decoding is theirs, each behind a space.
    """

    def __init__(self, data: bytes, threads: int):
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "true")
        self.model = PieceModel.parse(data)
        self.tokenizer, self.threads = self.model.tokenizer(), threads
        self.oracle = sentencepiece.SentencePieceProcessor(model_proto=data)
        self.parts: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        # parts whose ids or decoded texts differ, and parts that do not come back
        self.unlike: set[str] = set()
        self.changed: set[str] = set()
        self.simple = self.model.cut_at_marks() and self.model.dummy_prefix and not self.model.charsmap

    def _prove(self, texts: list[str], cut: bool) -> list[tuple[bytes, bool, bool]]:
        """Ids, parity and round trip of texts, or of parts a text was cut into."""
        if not texts:
            return []
        found = [e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
        wanted = self.oracle.encode(texts, num_threads=self.threads)
        decoded = self.tokenizer.decode_batch(found, skip_special_tokens=False)
        undone = self.oracle.decode(wanted, num_threads=self.threads)
        # a part from a line feed on has no marker in its text: the one given to it goes
        kept = [ids[1:] if cut and text.startswith("\n") else ids for ids, text in zip(found, texts, strict=True)]
        return [
            (struct.pack(f"<{len(own)}I", *own), ids == right and own_text == back, own_text == text)
            for own, ids, right, own_text, back, text in zip(kept, found, wanted, decoded, undone, texts, strict=True)
        ]

    def _learn(self, fresh: set[str]) -> None:
        new = []
        for part in fresh:
            ids = self.older.get(part)
            if ids is None:
                new.append(part)
            else:
                self.parts[part] = ids
        for part, (ids, same, back) in zip(new, self._prove(new, True), strict=True):
            self.parts[part] = ids
            if not same:
                self.unlike.add(part)
            if not back:
                self.changed.add(part)

    def encode(self, texts: list[str | None]) -> list[tuple[bytes, bool, bool]]:
        if len(self.parts) > MAX_PARTS:
            self.parts, self.older = {}, self.parts
            # only parts that are still held are looked at
            self.unlike &= self.older.keys()
            self.changed &= self.older.keys()
        cut: list[list[str] | None] = []
        fresh: set[str] = set()
        whole: list[str] = []
        known = self.parts
        for text in texts:
            text = text or ""
            parts = text.replace("\n", " \n").split(" ") if self.simple else [""]
            if "" in parts:
                cut.append(None)
                whole.append(text)
            else:
                cut.append(parts)
                fresh.update(parts)
        self._learn(fresh - known.keys())
        others = iter(self._prove(whole, False))
        same = lambda parts, odd: not odd or odd.isdisjoint(parts)
        return [
            next(others) if parts is None else (b"".join(map(known.__getitem__, parts)), same(parts, self.unlike), same(parts, self.changed)) for parts in cut
        ]

    def decode(self, encoded: list[bytes | None]) -> list[str]:
        ids = [struct.unpack(f"<{len(x) // 4}I", x) if x else () for x in encoded]
        return self.tokenizer.decode_batch(ids, skip_special_tokens=False)


_BACKENDS: dict[int, Backend] = {}


def backend(data: bytes, threads: int) -> Backend:
    key = hash(data)
    if key not in _BACKENDS:
        _BACKENDS[key] = Backend(data, threads)
    return _BACKENDS[key]


def encode(docs: DataFrame, path: str, threads: int | None = None) -> DataFrame:
    """Encode ``docs(doc_id, text)``: doc_id, ids (little-endian uint32), n_tokens, ids_crc32, parity, round_trip.

    Null texts count as empty and give no ids. parity says that SentencePiece gives the
    same ids and the same text back (for every part of a text that can be cut); round_trip
    that the text comes back from the ids (a model that normalises texts need not give
    it). ``threads`` of the library encode each batch; by default the cores of a task.
    """
    with open(path, "rb") as source:
        data = source.read()  # a vocabulary, below a few MB whatever the input
    spark = docs.sparkSession
    threads = threads or int(spark.conf.get("spark.task.cpus", "1"))
    sent = spark.sparkContext.broadcast(data)
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("parity", pa.bool_()), ("round_trip", pa.bool_())])

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = backend(sent.value, threads)
        for batch in rows:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                texts = [text or "" for text in part.column(1).to_pylist()]
                ids, same, back = zip(*own.encode(texts), strict=True)
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array(ids, pa.binary()), pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array([zlib.crc32(x) for x in ids], pa.int64()), pa.array(same, pa.bool_()), pa.array(back, pa.bool_()),
                ], schema=schema)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, ids binary, n_tokens long, ids_crc32 long, parity boolean, round_trip boolean")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """Texts of ``encoded(doc_id, ids)``: doc_id, text. Null ids give an empty text."""
    with open(path, "rb") as source:
        data = source.read()
    sent = encoded.sparkSession.sparkContext.broadcast(data)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = backend(sent.value, 1)
        for batch in rows:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                texts = own.decode(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("bigint").alias("doc_id"), "ids").mapInArrow(run, "doc_id long, text string")
