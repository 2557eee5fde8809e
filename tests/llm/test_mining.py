"""Collocations, toxicity and whitening against brute force."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from helpers import AWKWARD, LONG, documents
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkloom.llm import collocations, toxicity, whitening

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# Collocations


def brute_phrases(rows, rule, top):
    counts, total = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            total[lang] += len(words)
            for n in range(1, rule.words + 1):
                counts.setdefault(lang, Counter()).update(tuple(words[k:k + n]) for k in range(len(words) - n + 1))
    made = {}
    for lang, f in counts.items():
        found = []
        large = [p for p in f if len(p) > 1 and f[p] >= rule.least]
        for p in large:
            if any(
                len(q) > len(p) and 100 * f[q] >= rule.covers * f[p] and any(q[k:k + len(p)] == p for k in range(len(q) - len(p) + 1)) for q in large
            ):
                continue
            cuts = [(collocations.SCALE * f[p] ** 2 // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            found.append((-score, -f[p], " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        made[lang] = [(rank, p.decode(), -a, left, right, total[lang], -s) for rank, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1)]
    return {lang: rows for lang, rows in made.items() if rows}


def mined(df, rule, top):
    got = {}
    for r in collocations.mine(df, top, rule).orderBy("lang", "rank").collect():
        got.setdefault(r.lang, []).append((r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score))
    return got


def phrase_rows():
    rng = random.Random(5)
    fixed = ["new york city", "New\tYork", "é日本 wort", "in the end", "a b a b a b"]
    rows = []
    for k in range(250):
        words = [rng.choice(fixed) if rng.random() < 0.3 else rng.choice("abcdefghij") for _ in range(rng.randrange(30))]
        text = "".join(w + rng.choice([" ", " ", "  ", "\t", ". ", "!", "\n", "\x0b"]) for w in words)
        rows.append((k, text, rng.choice(["en", "en", "de", None, "und", "x y\nz"])))
    return rows + [(900 + k, "hot pair " + rng.choice("abcdefgh"), "hot") for k in range(120)]


@pytest.mark.parametrize("rule", [collocations.Rule(), collocations.Rule(4, 3, 70), collocations.Rule(2, 1, 50)])
def test_collocations_are_those_of_brute_force(spark, monkeypatch, rule):
    monkeypatch.setattr(collocations, "PARTITION_CHARS", 500)
    rows = phrase_rows()
    got = mined(documents(spark, rows).repartition(5), rule, 40)
    assert got == brute_phrases([(t, lang) for _, t, lang in rows], rule, 40)


def test_windows_of_long_texts_are_cut_without_loss(monkeypatch):
    monkeypatch.setattr(collocations, "STRETCH", 9)
    rng = random.Random(2)
    for size in (1, 2, 3, 5):
        for _ in range(200):
            text = "".join(rng.choice("abc   .\t") for _ in range(rng.randrange(90)))
            want = []
            for piece in text.split("."):
                words = piece.split()
                want += [" ".join(words[k:k + size]).encode() for k in range(len(words))]
            got = []
            for part, borrowed in collocations._stretches(text.encode().translate(collocations.FLAT), size):
                keys = collocations.longest_windows(part, size).to_pylist()
                got += keys[:len(keys) - borrowed]
            assert got == want


def test_collocations_of_awkward_rows(spark):
    rows = [(d, t, lang) for d, t, *_ in AWKWARD for lang in ("en", None)] * 6 + [(50, LONG, "en")] * 2 + [(51, "w" * 100_000 + " " + "v" * 50_000, "big")] * 12
    rule = collocations.Rule()
    assert mined(documents(spark, rows), rule, 2000) == brute_phrases([(t, lang) for _, t, lang in rows], rule, 2000)
    assert mined(documents(spark, []), rule, 5) == {}


def test_scores_beyond_64_bits_are_exact(spark):
    n = 3 * 10**14
    counts = spark.createDataFrame([("en", 0, "", 5 * n), ("en", 1, "a", n + 7), ("en", 1, "b", n + 11), ("en", 2, "a b", n)], "lang string, size int, phrase string, f long")
    row = collocations.candidates(counts, collocations.Rule()).first()
    assert row.score == 10**6 * n * n // ((n + 7) * (n + 11)) and (row.l, row.r) == (n + 7, n + 11)


# Toxicity


def distance(a, b):
    """Levenshtein distances of ``a`` to all beginnings of ``b``."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row


def test_automaton_finds_what_the_distance_says():
    rng = random.Random(8)
    terms = [("".join(rng.choice("abcd") for _ in range(rng.randrange(3, 10))), rng.random() < 0.4) for _ in range(60)]
    terms = [(t, stem, toxicity.allowed(t, stem, rng.choice([1.0, 9.0]))) for t, stem in dict.fromkeys(terms)]
    trie = toxicity.Trie(terms)
    words = sorted({"".join(rng.choice("abcde") for _ in range(rng.randrange(3, 12))) for _ in range(1500)} | {t for t, _, _ in terms})
    found = trie.near_all(words, batch=400)
    hits = 0
    for word in words:
        want = {}
        for k, (term, stem, edits) in enumerate(terms):
            row = distance(term, word)
            e = min(row) if stem else row[-1]
            if e <= edits:
                want[k] = e
        assert dict(found.get(word, [])) == want, word
        hits += len(want)
    assert hits > 100


def toxic_corpus(n=900):
    """Documents of invented words; toxic ones hold insults, some misspelled; clean ones may quote them."""
    rng = random.Random(3)
    insults = ["blorfnik", "zundheimer", "quexal", "mortidan"]
    vowel = lambda w: w.replace("o", "u", 1) if "o" in w else w.replace("u", "o", 1)
    plain = ["".join(rng.choice(["ta", "re", "li", "mo", "sen", "dor", "wi"]) for _ in range(rng.randrange(1, 4))) for _ in range(800)]
    rows, labels, kinds = [], [], {}
    for k in range(n):
        words = [rng.choice(plain) for _ in range(rng.randrange(10, 120))]
        kind = rng.choice(["clean"] * 5 + ["toxic"] * 2 + ["quoted"]) if k < n - 60 else "misspelled"
        if kind in ("toxic", "misspelled"):
            for _ in range(rng.randrange(1, 4)):
                term = rng.choice(insults)
                if kind == "misspelled":
                    term = rng.choice([term[:3] + term[4:], term[:4] + "x" + term[4:], vowel(term)])
                words.insert(rng.randrange(len(words)), term.upper() if rng.random() < 0.2 else term + rng.choice(["", "!", ","]))
        if kind == "quoted" and rng.random() < 0.5:
            at = rng.randrange(len(words))
            words[at:at] = ["said", '"', rng.choice(insults), '"']
        rows.append((k, " ".join(words)))
        kinds[k] = kind
        if kind != "misspelled":
            labels.append((k, 1, int(kind == "toxic")))
    return rows, labels, kinds


@pytest.fixture(scope="module")
def toxic_model(spark):
    rows, labels, kinds = toxic_corpus()
    docs, marks = documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    train = docs.where("doc_id % 3 <> 1")
    return toxicity.learn(train, marks), docs, kinds


def test_toxic_documents_are_told_from_clean_and_quoting_ones(toxic_model):
    model, docs, kinds = toxic_model
    assert {"blorfnik", "zundheimer", "quexal", "mortidan"} <= {t for t, *_ in model.lexicon.terms}
    got = {r.doc_id: r.predicted for r in toxicity.score(docs, model).collect()}
    held = [d for d in got if d % 3 == 1]
    share = lambda kind, among: np.mean([got[d] for d in among if kinds[d] == kind])
    assert share("toxic", held) > 0.95
    assert share("clean", held) < 0.02 and share("quoted", held) < 0.1
    # documents whose only terms are in spellings never seen: one such match in a long text is not enough
    assert share("misspelled", list(got)) > 0.7


def test_toxicity_of_awkward_rows(spark, toxic_model):
    model, _, _ = toxic_model
    rows = AWKWARD + [(99, "blorfnik you are a quexal"), (99, "blorfnik you are a quexal"), (100, "x" * 200_000)]
    got = toxicity.score(documents(spark, rows), model, ["doc_id", "source"]).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    assert {r.predicted for r in got if r.doc_id == 99} == {1} and not any(r.predicted for r in got if r.doc_id != 99)
    empty = spark.createDataFrame([], "doc_id long, toxic int")
    none = toxicity.learn(documents(spark, rows), empty)
    assert none.lexicon.terms == [] and not any(r.predicted for r in toxicity.score(documents(spark, rows), none).collect())
    odd = spark.createDataFrame([(None, 1), (7, None), (99, 1), (99, 0), (1, 0)], "doc_id long, toxic int")
    assert toxicity.learn(documents(spark, rows), odd).lexicon.terms == []
    assert toxicity.score(documents(spark, []), model).collect() == []


def test_quotation_is_told_from_abuse():
    lexicon = toxicity.Lexicon([("blorfnik", False, 2)], np.array([[5.0, 3.0, 2.0]]))
    plain, quoted, near = toxicity.features(lexicon, ["you are a blorfnik here", 'he said "a blorfnik" here', "you blorfni here"])
    assert plain[0] > 0 and plain[1] == 0 and quoted[0] == 0 and quoted[1] > 0
    assert 0 < near[0] < plain[0]


# Whitening

VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("component", T.StringType())])


def brute_whitening(rows, top):
    x = [(i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v in rows]
    n, d = len(x), len(x[0][1])
    sums = [sum(v[k] for _, v in x) for k in range(d)]
    centred = np.array([[(n * v[k] - sums[k]) / n for k in range(d)] for _, v in x])
    cov = centred.T @ centred / n
    values, basis = np.linalg.eigh(cov)
    values, basis = values[::-1][:top], basis[:, ::-1][:, :top]
    deviations = [sum((n * v[k] - sums[k]) ** 2 for k in range(d)) for _, v in x]
    return centred @ basis / np.sqrt(values), deviations, values / np.trace(cov)


@pytest.mark.parametrize("parts", [1, 40])
def test_whitening_is_that_of_the_covariance(spark, parts):
    rng = np.random.default_rng(4)
    turn = rng.normal(size=(12, 12))
    vectors = rng.normal(size=(700, 12)) @ turn + 3
    rows = [(k, [float(np.float32(c)) for c in v]) for k, v in enumerate(vectors)] + [(k, [0.5] * 12) for k in range(700, 1000)]
    df = spark.createDataFrame([(i, v, "clash") for i, v in rows], VECTORS).repartition(parts)
    got = whitening.whiten(df, top=8).collect()
    white, deviations, explained = brute_whitening(rows, 8)
    assert len(got) == 8 * len(rows) and {r.n for r in got} == {len(rows)}
    own = np.zeros_like(white)
    for r in got:
        own[r.vec_id, r.component - 1] = r.whitened
        assert r.deviation == deviations[r.vec_id]
        assert abs(r.explained / explained[r.component - 1] - 1) < 1e-9 and r.identity_error < 1e-9
    signs = np.sign((own * white).sum(axis=0))
    assert np.abs(own * signs - white).max() < 1e-9


def test_spectrum_of_hard_cases():
    rng = np.random.default_rng(9)
    for size, rows in (
        (6, np.repeat(rng.normal(size=(3, 6)), 40, axis=0)),  # rank two
        (5, np.eye(5).repeat(20, axis=0) * 7),  # equal eigenvalues
        (4, np.zeros((30, 4)) + 1e6),  # none
        (3, np.array([[1e6, 1e-3, 0]]) * rng.normal(size=(50, 1))),  # far apart
        (8, rng.normal(size=(5, 8))),  # fewer vectors than dimensions
    ):
        want = (rows - rows.mean(axis=0)).T @ (rows - rows.mean(axis=0))
        single, blocks = whitening.Spectrum.empty(size), whitening.Spectrum.empty(size)
        for row in rows:
            single.shift(1.0, row)
        for part in np.array_split(rows, 4):
            if len(part):
                other = whitening.Spectrum.empty(size)
                other.add(part)
                blocks.merge(other)
        for made in (single, blocks):
            assert np.abs((made.basis * made.lam) @ made.basis.T - want).max() <= 1e-9 * max(1.0, np.abs(want).max())
            assert np.abs(made.basis.T @ made.basis - np.eye(size)).max() < 1e-10
            assert np.abs(made.mean - rows.mean(axis=0)).max() <= 1e-9 * max(1.0, np.abs(rows).max())


def test_secular_roots_interlace():
    rng = np.random.default_rng(3)
    for _ in range(50):
        lam = np.sort(rng.uniform(0, 10, 7))
        z, rho = rng.normal(size=7), float(rng.uniform(0.01, 5))
        pole, offset = whitening.secular_roots(lam, z, rho)
        roots = lam[pole] + offset
        assert (roots >= lam).all() and (roots[:-1] <= lam[1:]).all()
        assert np.allclose(roots, np.linalg.eigvalsh(np.diag(lam) + rho * np.outer(z, z)))


def test_whitening_of_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(1, [1.0, 2.0]), (2, [2.0, 2.5]), (2, [2.0, 2.5]), (None, [0.0, 4.0]), (5, [-1.0, 0.25])]
    bad = [(6, None), (7, []), (8, [1.0, None]), (9, [nan, 1.0]), (10, [1.0, inf]), (11, [1.0, 2.0, 3.0]), (12, [1.0])]
    df = spark.createDataFrame([(i, v, "c") for i, v in good + bad], VECTORS)
    got = whitening.whiten(df).collect()
    assert sorted((r.vec_id is None, r.vec_id or 0, r.component) for r in got) == sorted((i is None, i or 0, c) for i, _ in good for c in (1, 2))
    assert {r.n for r in got} == {5}
    # directions without variance have no component
    flat = spark.createDataFrame([(k, [float(k), 1.0, 2.0 * k], "c") for k in range(9)], VECTORS)
    assert {r.component for r in whitening.whiten(flat).collect()} == {1}
    for rows in ([], bad[:3], [(1, [1.0, 2.0])], [(k, [3.0, 3.0]) for k in range(4)]):
        assert whitening.whiten(spark.createDataFrame([(i, v, "c") for i, v in rows], VECTORS)).collect() == []
    huge = spark.createDataFrame([(1, [3e9, 0.0], "c"), (2, [-3e9, 1.0], "c")], VECTORS)
    found = {r.vec_id: r.deviation for r in whitening.whiten(huge).collect()}
    assert found == {1: None, 2: None}
