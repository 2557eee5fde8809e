"""Operators on token ids: cached encoders, addressable codes, packing, piece models."""

import random
import struct
import zlib

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from helpers import AWKWARD, LONG, documents
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import AddedToken, Tokenizer

from linkloom.llm import dac, packing, pieces, queries, tokens

VOCABULARIES = ["byte_bpe_50k.json", "word_bpe_49k.json"]


@pytest.fixture(scope="module")
def definitions():
    return {name: tokens.definition_of(public_tokenizers.path(name)) for name in VOCABULARIES}


def library(name):
    made = Tokenizer.from_file(public_tokenizers.path(name))
    made.encode_special_tokens = True
    return made


LIBRARIES = {name: library(name) for name in VOCABULARIES}


def whole(name, text):
    return np.array(LIBRARIES[name].encode(text or "", add_special_tokens=False).ids, "<u4").tobytes()


@pytest.mark.parametrize("name", VOCABULARIES)
def test_cached_ids_are_the_librarys(definitions, name):
    encoder = tokens.encoder(definitions[name])
    for text in [t for _, t in AWKWARD] + ["it's 'S x's don't\n'll", "İI Σς", "\x1c a\x1cb", "a\n b", "a \nb", "\x85a\xa0b", "ſ ß ÿ Ÿ"]:
        assert encoder.ids(text) == whole(name, text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t'sStTÀéñıİ.,!?0129abAB"), st.characters(max_codepoint=0x2FF), st.characters()), max_size=40))
def test_cached_ids_on_any_text(text):
    for name in VOCABULARIES:
        if any(0xD800 <= ord(c) < 0xE000 for c in text):
            continue
        encoder = tokens.encoder(tokens.definition_of(public_tokenizers.path(name)))
        assert encoder.ids(text) == whole(name, text)


def test_full_word_table_is_emptied():
    made = tokens.Words(lambda w: w.encode(), limit=3)
    assert [made[w] for w in "abcdeab"] == [w.encode() for w in "abcdeab"] and len(made) <= 3


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=700), st.data())
def test_shards_give_random_access(ids, data):
    ids = np.array(ids, np.uint32)
    shard = dac.Shard(b"".join(dac.encode_shard([5, None], [0, len(ids), len(ids)], ids)))
    assert (shard.run(0, len(ids)) == ids).all()
    if len(ids):
        at = data.draw(st.lists(st.integers(0, len(ids) - 1), max_size=30))
        assert (shard.tokens(at) == ids[np.array(at, int)]).all()
        a = data.draw(st.integers(0, len(ids)))
        b = data.draw(st.integers(a, len(ids)))
        assert (shard.run(a, b) == ids[a:b]).all()
    assert shard.doc_ids.tolist() == [5, 0] and shard.null_ids.tolist() == [0, 1]


def test_shards_hold_the_stream_in_id_order(spark, definitions):
    name = "byte_bpe_50k.json"
    rows = AWKWARD + [(100 - k, f"text number {k}") for k in range(40)]
    manifest = dac.write_shards(documents(spark, rows), definitions[name], shard_tokens=500)
    assert manifest.count() > 3
    got = dac.read_documents(manifest, with_ids=True).collect()
    end = struct.pack("<I", dac.END_ID)
    want = sorted((d is not None, d or 0, whole(name, t) + end) for d, t in rows)
    assert sorted((r.doc_id is not None, r.doc_id or 0, bytes(r.ids)) for r in got) == want
    got.sort(key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((d for d, _ in rows), key=lambda d: (d is not None, d or 0))
    at = 0
    for r in got:
        assert r.start == at and r.n_tokens == len(r.ids) // 4 and r.ids_crc32 == zlib.crc32(bytes(r.ids))
        at += r.n_tokens
    stream = np.frombuffer(b"".join(bytes(r.ids) for r in got), "<u4")
    places = [0, 1, at - 1, at, -1, 7, 7, at // 2]
    asked = spark.createDataFrame([(p,) for p in places] + [(None,)], "place long").withColumn("token", F.lit("x"))
    found = sorted((r.place, r.token) for r in dac.look_up(manifest, asked).collect())
    assert found == sorted((p, int(stream[p])) for p in places if 0 <= p < at)


def test_no_documents_give_no_shards(spark, definitions):
    empty = documents(spark, [])
    assert dac.read_documents(dac.write_shards(empty, definitions["byte_bpe_50k.json"])).collect() == []
    assert packing.pack(packing.stored_pieces(empty, definitions["word_bpe_49k.json"])).collect() == []


def slow_pack(lengths, capacity):
    """Sum of squares with every choice tried out on the counts."""
    count, bins, out = [0] * (capacity + 1), [], []
    for length in lengths:
        best = None
        for gap in [g for g in range(length, capacity) if count[g]] + [capacity]:
            now = list(count)
            if gap < capacity:
                now[gap] -= 1
            if gap - length:
                now[gap - length] += 1
            value = sum(c * c for c in now[1:capacity])
            if best is None or value < best[0]:
                best = (value, gap)
        gap = best[1]
        k = max((k for k, b in enumerate(bins) if b["gap"] == gap), key=lambda k: bins[k]["at"]) if gap < capacity else len(bins)
        if gap == capacity:
            bins.append({"gap": capacity, "at": 0})
        out.append((k, capacity - bins[k]["gap"]))
        count[gap] -= gap < capacity
        bins[k]["gap"] -= length
        bins[k]["at"] = len(out)
        count[bins[k]["gap"]] += bins[k]["gap"] > 0
    return out


def test_sum_of_squares_is_least_at_each_step():
    rng = random.Random(5)
    for _ in range(30):
        lengths = [rng.choice([1, 2, 3, 5, 7, 12, 20]) for _ in range(60)]
        sequence, offset = packing.pack_lengths(np.array(lengths), 20)
        assert list(zip(sequence.tolist(), offset.tolist(), strict=True)) == slow_pack(lengths, 20)


def check_sequences(rows, capacity):
    held = {}
    for r in rows:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    return held


def test_packing_keeps_every_piece(spark, definitions):
    name = "word_bpe_49k.json"
    rows = AWKWARD + [(1000 + k, " ".join(["word"] * (k * 37 % 900))) for k in range(200)]
    made = packing.stored_pieces(documents(spark, rows), definitions[name], with_ids=True)
    packed = packing.pack(made, group_tokens=20_000)
    got = packed.collect()
    want = []
    for d, t in rows:
        ids = whole(name, t) + struct.pack("<I", packing.END_ID)
        want += [(d or -1, k, a // 4, zlib.crc32(ids[a:a + 4 * 4096])) for k, a in enumerate(range(0, len(ids), 4 * 4096))]
    assert sorted((r.doc_id or -1, r.piece, r.start, r.ids_crc32) for r in got) == sorted(want)
    held = check_sequences(got, packing.CAPACITY)
    total = sum(r.length for r in got)
    assert len(held) <= -(-total // packing.CAPACITY) + 3
    whole_sequences = {r.sequence_id: r for r in packing.assemble(packed).collect()}
    assert set(whole_sequences) == set(held)
    r = got[0]
    ids = np.frombuffer(bytes(whole_sequences[r.sequence_id].ids), "<u4")[r.offset:r.offset + r.length]
    assert zlib.crc32(ids.tobytes()) == r.ids_crc32


PIECES = public_tokenizers.path("piece_bpe_32k.model")


def test_piece_backend_agrees_with_sentencepiece(spark):
    import sentencepiece

    oracle = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rows = AWKWARD + [(50, "\nstarts on a new line\n"), (51, "▁marks ▁"), (52, "aaaa aaaaaaa hahaha"), (53, " x")]
    encoded = pieces.encode(documents(spark, rows), PIECES)
    got = {(r.doc_id, bytes(r.ids)): r for r in encoded.collect()}
    for d, t in rows:
        r = got[d, struct.pack(f"<{len(oracle.encode(t or ''))}I", *oracle.encode(t or ""))]
        assert r.parity and r.n_tokens == len(r.ids) // 4 and r.ids_crc32 == zlib.crc32(bytes(r.ids))
        assert r.round_trip or "▁" in (t or "")
    texts = sorted((r.doc_id or 0, r.text) for r in pieces.decode(encoded, PIECES).collect())
    assert texts == sorted((d or 0, (t or "").replace("▁", " ")) for d, t in rows)
    assert pieces.encode(documents(spark, []), PIECES).collect() == []


def _varint(n):
    out = b""
    while True:
        out += bytes([n & 127 | (128 if n > 127 else 0)])
        n >>= 7
        if not n:
            return out


def _sub(number, data):
    return _varint(number << 3 | 2) + _varint(len(data)) + data


def unigram_model():
    """A small unigram model file, written field by field."""
    vocabulary = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)] + [(f"<0x{b:02X}>", 0.0, 6) for b in range(256)]
    vocabulary += [(w, -1.0 - 0.37 * k, 1) for k, w in enumerate(["▁the", "▁", "▁a", "ab", "b", "a", "c", "abc", "▁ab", "the", "t", "h", "e", "bc"])]
    made = b""
    for text, score, kind in vocabulary:
        made += _sub(1, _sub(1, text.encode()) + b"\x15" + struct.pack("<f", score) + b"\x18" + _varint(kind))
    made += _sub(2, b"\x18\x01" + _varint(35 << 3) + b"\x01" + _varint(40 << 3) + b"\x00")
    return made + _sub(3, _sub(1, b"identity") + b"\x18\x01\x20\x00\x28\x01")


def test_unigram_models_are_rebuilt_too():
    import sentencepiece

    data = unigram_model()
    backend = pieces.Backend(data, 1)
    assert backend.model.kind == pieces.UNIGRAM and backend.model.byte_fallback
    oracle = sentencepiece.SentencePieceProcessor(model_proto=data)
    rng = random.Random(3)
    texts = ["", "the abc", "a  b", "é the"] + ["".join(rng.choice("abcthe \n") for _ in range(30)) for _ in range(200)]
    for text, (ids, same, back) in zip(texts, backend.encode(texts), strict=True):
        assert same and back == (oracle.decode(oracle.encode(text)) == text) and list(struct.unpack(f"<{len(ids) // 4}I", ids)) == oracle.encode(text), text


def test_long_text_is_encoded_whole():
    encoder = tokens.encoder(tokens.definition_of(public_tokenizers.path("byte_bpe_50k.json")))
    assert encoder.ids(LONG) == whole("byte_bpe_50k.json", LONG)


ADDED = ["a <|endoftext|> b", "a<|endoftext|>b", " <|endoftext|>\n<|startoftext|> x", "<|ENDOFTEXT|>", "<|endoftext", "  two  spaces<|endoftext|>\t", "plain text"]


def as_loaded(name, text):
    return np.array(Tokenizer.from_file(public_tokenizers.path(name)).encode(text or "", add_special_tokens=False).ids, "<u4").tobytes()


@pytest.mark.parametrize("name", VOCABULARIES)
def test_ids_of_the_tokenizer_as_loaded(definitions, name):
    encoder = tokens.encoder(definitions[name], literal=False)
    for text in ADDED + [t for _, t in AWKWARD]:
        assert encoder.ids(text) == as_loaded(name, text)


def test_added_tokens_of_any_kind():
    for normalized, special in [(False, False), (True, False), (True, True)]:
        for name in VOCABULARIES:
            made = Tokenizer.from_file(public_tokenizers.path(name))
            add = made.add_special_tokens if special else made.add_tokens
            add([AddedToken("Key Word", normalized=normalized, special=special)])
            encoder = tokens.encoder(made.to_str(), literal=False)
            for text in ["a Key Word b", "a key\tword b", "a \u212aey Word", "aKEY WORDb", "Key  Word", "none"]:
                assert encoder.ids(text) == np.array(made.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_queries_use_the_tokenizer_as_loaded(spark, tmp_path):
    rows = list(enumerate(ADDED))
    documents(spark, rows, clashing=False).write.parquet(str(tmp_path / "documents.parquet"))
    want = {d: zlib.crc32(as_loaded("byte_bpe_50k.json", t) + struct.pack("<I", dac.END_ID)) for d, t in rows}
    assert {r.doc_id: r.ids_crc32 for r in queries.QUERIES["op3_addressable_codes"](spark, str(tmp_path)).collect()} == want
    want = {d: zlib.crc32(as_loaded("word_bpe_49k.json", t) + struct.pack("<I", packing.END_ID)) for d, t in rows}
    assert {r.doc_id: r.ids_crc32 for r in queries.QUERIES["op5_sum_of_squares"](spark, str(tmp_path)).collect()} == want
    assert {r.doc_id: r.ids_crc32 for r in corpus_pipeline.pack(spark, spark.read.parquet(str(tmp_path / "documents.parquet")), str(tmp_path)).collect()} == want
