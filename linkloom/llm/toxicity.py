"""Toxicity of texts: a learned lexicon in a trie, matched by Levenshtein automata, weighed in context.

Learning, on labelled documents:

1. Words and their beginnings (4 to 8 characters) are counted by document and label. Terms
   that toxic documents hold far more often (log-likelihood ratio, log odds) enter the
   lexicon, whole words as they are, beginnings as stems that any ending may follow.
2. The lexicon lies in a trie. A Levenshtein automaton reads the trie: its states are the
   rows of the edit distance to a document's word, kept as bit sets, and a word leaves a
   branch as soon as no state is within the allowed distance. One walk takes the automata
   of thousands of words along, so it finds every term within one edit (two for whole
   words from eight characters on) of any of them. Terms that say little match as they are.
3. How much a misspelling says is learned per term and distance: words near a term that
   clean documents also hold weigh little; a term without such neighbours passes on most
   of its weight.
4. Each match is read in a window of words around it. Quotation marks around it and words
   of reporting lessen it, address in the second person strengthens it. Quoted and
   unquoted weights, their density and the strongest one are a document's features, and
   a logistic model turns them into a score.

The classifier, lexicon included, is learned from at most ``FIT_ROWS`` labelled documents,
chosen by the hash of their id where there are more, so learning costs the same however
large the corpus is; every text is scored. The lexicon, the counts per term and the
features of the documents learned from reach the driver. Scoring reads each text alone.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.llm import common

STEMS = range(4, 9)
# Terms at most, and what makes one: documents, log odds, log-likelihood ratio (chi-square with one degree of freedom).
LEXICON, LEAST_DOCS, LEAST_ODDS, LEAST_RATIO = 2000, 5, 1.5, 30.0
# The share of a term's occurrences that are taken to be misspelled, before any is seen.
MISSPELLED = 0.05
# Log odds from which on a term is looked for in other spellings.
FUZZY_ODDS = 3.0
# Labelled documents the classifier is learned from, about that many where there are more.
FIT_ROWS = 20_000
WINDOW = 6
TOXIC_AT = 0.7
# Distinct words a worker remembers, and terms a task holds before it passes them on.
MAX_WORDS, HELD_TERMS = 400_000, 500_000
LONGEST = 40

WORDS = re.compile(r"[^\W\d_]+").findall
TOKENS = re.compile(r"[^\W\d_]+|[\"'“”„‟«»‹›‘’]").findall
QUOTES = frozenset("\"'“”„‟«»‹›‘’")
# Words of reporting and of address in the languages of the corpus.
REPORTING = frozenset(
    "said says wrote writes called quote quoted quotes word words term means reported alleged "
    "sagte schrieb zitat zitiert wort bedeutet dit écrit cité mot signifie dijo escribió cita citado palabra significa".split())
ADDRESS = frozenset("you your youre yourself du dein deine ihr euch vous votre tu toi tú usted ustedes vosotros".split())

FEATURES = ["plain", "quoted", "strongest", "density", "distinct", "length"]
# Where data says nothing, weights stay here: quoted matches count against a document a quarter as much.
PRIOR = np.array([-3.5, 1.0, 0.25, 0.3, 1.0, 0.5, -0.2])
STIFFNESS = np.array([0.01, 0.3, 2.0, 0.3, 0.3, 0.3, 0.3])


def allowed(term: str, stem: bool, odds: float = math.inf) -> int:
    """Edits a term may be away; a stem has any ending already, so it may be one away at most."""
    if odds < FUZZY_ODDS or len(term) < (6 if stem else 4):
        return 0
    return 2 if len(term) >= 8 and not stem else 1


def _usual(words: set[str]) -> list[str]:
    return sorted(w for w in words if 3 <= len(w) <= LONGEST)


class _Node:
    __slots__ = ("below", "edits", "terms")

    def __init__(self):
        self.below: dict[str, _Node] = {}
        self.terms: list[tuple[int, bool, int]] = []
        self.edits = 0  # the most a term from here on allows


class Trie:
    """Terms (text, whether a stem, edits allowed) by their letters."""

    def __init__(self, terms: list[tuple[str, bool, int]]):
        self.root = _Node()
        for k, (term, stem, edits) in enumerate(terms):
            node = self.root
            node.edits = max(node.edits, edits)
            for letter in term:
                node = node.below.setdefault(letter, _Node())
                node.edits = max(node.edits, edits)
            node.terms.append((k, stem, edits))

    def near_all(self, words: list[str], batch: int = 1 << 14) -> dict[str, list[tuple[int, int]]]:
        """Words with the terms (index, distance) within their allowed distance of the word, or of a beginning of it for stems."""
        found: dict[str, list[tuple[int, int]]] = {}
        for start in range(0, len(words), batch):
            part = words[start:start + batch]
            for at, term, edits in self._walk(part):
                for k in at.tolist():
                    found.setdefault(part[k], []).append((term, edits))
        return found

    def _walk(self, words: list[str]) -> Iterator[tuple[np.ndarray, int, int]]:
        """Places of the words that meet a term, the term, and the distance.

        Bit j of state e of a word says that e edits lead from what was read of the trie
        to the word's first j letters.
        """
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        width = int(sizes.max(initial=1))
        codes = np.array(words, f"U{width}").view(np.uint32).reshape(len(words), width)
        ends = np.uint64(1) << sizes.astype(np.uint64)
        bits = np.uint64(2) << np.arange(width, dtype=np.uint64)
        one = np.uint64(1)
        letters: dict[str, np.ndarray] = {}

        def places(letter: str) -> np.ndarray:
            if letter not in letters:
                letters[letter] = ((codes == ord(letter)) * bits).sum(axis=1, dtype=np.uint64)
            return letters[letter]

        # letters of the word may be put in before anything is read
        start = [np.minimum((one << np.uint64(e + 1)) - one, 2 * ends - one) for e in range(self.root.edits + 1)]
        stack = [(self.root, np.arange(len(words)), start)]
        while stack:
            node, at, states = stack.pop()
            for term, stem, edits in node.terms:
                left = np.arange(len(at))
                for e in range(edits + 1):
                    here = states[e][left] if stem else states[e][left] & ends[at[left]]
                    yield at[left[here > 0]], term, e
                    left = left[here == 0]
            for letter, below in node.below.items():
                step, limit = places(letter)[at], 2 * ends[at] - one
                made: list[np.ndarray] = []
                for e in range(below.edits + 1):
                    now = (states[e] << one) & step
                    if e:
                        # substituted, left out of the word, or put into it
                        now |= (states[e - 1] << one) | states[e - 1] | (made[e - 1] << one)
                    made.append(now & limit)
                alive = np.flatnonzero(made[-1])
                if len(alive):
                    stack.append((below, at[alive], [m[alive] for m in made]))


class Lexicon:
    """Terms (text, whether a stem, edits allowed), and the log odds of a document being toxic by term and distance (0 to 2)."""

    def __init__(self, terms: list[tuple[str, bool, int]], odds: np.ndarray):
        self.terms, self.odds, self.trie = terms, odds, Trie(terms)
        self.seen: set[str] = set()
        # term, distance and weight of the strongest term a word stands for
        self.hits: dict[str, tuple[int, int, float]] = {}

    def read(self, words: set[str]) -> None:
        """Look up words that were not met before."""
        fresh = words - self.seen
        if len(self.seen) + len(fresh) > MAX_WORDS:
            self.seen.clear(), self.hits.clear()
            fresh = words
        for word, near in self.trie.near_all(_usual(fresh)).items():
            weight, less, term = max((float(self.odds[k, e]), -e, -k) for k, e in near)
            if weight > 0:
                self.hits[word] = -term, -less, weight
        self.seen |= fresh


def _context(tokens: list[str], at: int) -> tuple[bool, float]:
    """Whether the match at a token is quoted, and how its window changes its weight."""
    left, right = tokens[max(0, at - WINDOW):at], tokens[at + 1:at + 1 + WINDOW]
    opened = sum(t in QUOTES for t in left) % 2 == 1
    quoted = opened and any(t in QUOTES for t in right)
    near = left + right
    factor = 1.0
    if any(t in REPORTING for t in near):
        quoted, factor = quoted or any(t in QUOTES for t in near), 0.6
    if any(t in ADDRESS for t in near):
        factor *= 1.25
    return quoted, factor


def _features(lexicon: Lexicon, lower: str, found: list[str]) -> list[float]:
    length = math.log1p(len(found))
    hits = lexicon.hits.keys() & set(found)
    if not hits:
        return [0.0, 0.0, 0.0, 0.0, 0.0, length]
    plain = quoted = strongest = 0.0
    tokens = TOKENS(lower)
    terms = set()
    for at, token in enumerate(tokens):
        if token in hits:
            term, _, weight = lexicon.hits[token]
            terms.add(term)
            inside, factor = _context(tokens, at)
            weight *= factor
            if inside:
                quoted += weight
            else:
                plain += weight
                strongest = max(strongest, weight)
    return [math.log1p(plain), math.log1p(quoted), strongest, math.log1p(100 * plain / len(found)), math.log1p(len(terms)), length]


def features(lexicon: Lexicon, texts: list[str | None]) -> list[list[float]]:
    """Features of each text; null and empty texts have zeros."""
    made: list[list[float]] = []
    for part in _stretches([(text or "").lower() for text in texts]):
        found = [WORDS(text) for text in part]
        lexicon.read(set().union(*found))
        made += [_features(lexicon, text, words) for text, words in zip(part, found, strict=True)]
    return made


def _stretches(texts: list[str], chars: int = 1 << 22) -> Iterator[list[str]]:
    """Texts in lists of a few million characters, so that words of many texts are looked up together."""
    part: list[str] = []
    size = 0
    for text in texts:
        part.append(text)
        size += len(text)
        if size >= chars:
            yield part
            part, size = [], 0
    if part:
        yield part


def _arrow(rows: DataFrame, run, schema: str) -> DataFrame:
    return rows.mapInArrow(run, schema)


def _labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """text and toxic (0 or 1) of about FIT_ROWS documents with a label; of several labels of an id the largest counts."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    marks = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    marks = common.stored(marks.join(texts.select("doc_id").distinct(), "doc_id", "left_semi"), "toxic-marks")
    share = FIT_ROWS / max(marks.count(), 1)
    if share < 1:
        marks = marks.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    # FIT_ROWS small rows, so that texts stay where they are
    return texts.join(F.broadcast(marks), "doc_id").where("text is not null").select("doc_id", "text", "toxic")


def term_counts(labelled: DataFrame) -> DataFrame:
    """term, stem, toxic, clean: documents of either label that hold a word or a word with that beginning.

    A term of no letters counts all documents.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[tuple[str, bool], list[int]] = {}

        def made() -> pa.RecordBatch:
            terms, stems = zip(*totals, strict=True)
            counts = np.array(list(totals.values()))
            return pa.RecordBatch.from_arrays(
                [pa.array(terms, pa.string()), pa.array(stems, pa.bool_()), pa.array(counts[:, 1]), pa.array(counts[:, 0])], ["term", "stem", "toxic", "clean"])

        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = {w for w in set(WORDS(text.lower())) if 3 <= len(w) <= LONGEST}
                mark = int(toxic > 0)
                found = {(w, False) for w in words}
                found |= {(w[:k], True) for w in words for k in STEMS if len(w) > k}
                found |= {(w, True) for w in words if len(w) in STEMS}
                found.add(("", False))
                for key in found:
                    own = totals.get(key)
                    if own is None:
                        own = totals[key] = [0, 0]
                    own[mark] += 1
                if len(totals) >= HELD_TERMS:
                    yield made()
                    totals.clear()
        if totals:
            yield made()

    counted = _arrow(labelled.select("text", "toxic"), run, "term string, stem boolean, toxic long, clean long")
    return counted.groupBy("term", "stem").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _ratio(toxic: Column, clean: Column, n_toxic: int, n_clean: int) -> Column:
    """Log-likelihood ratio of a term's documents against independence of the label."""
    n = n_toxic + n_clean
    cell = lambda seen, expected: F.when(seen > 0, 2 * seen * F.log(seen / expected)).otherwise(0.0)
    both, rest = toxic + clean, F.lit(n) - toxic - clean
    return (
        cell(toxic, both * n_toxic / n) + cell(clean, both * n_clean / n)
        + cell(F.lit(n_toxic) - toxic, rest * n_toxic / n) + cell(F.lit(n_clean) - clean, rest * n_clean / n)
    )


def _chosen(rows: list, n_toxic: int, n_clean: int) -> tuple[list[tuple[str, bool]], np.ndarray]:
    """Terms and document counts of those that say something a stronger one does not."""
    rows = sorted(rows, key=lambda r: (-round(r["ratio"], 6), r["stem"], -len(r["term"]), r["term"]))
    terms: dict[tuple[str, bool], tuple[int, int]] = {}
    for r in rows:
        term, stem = r["term"], r["stem"]
        # a word or stem within this one, with nearly all its toxic documents
        if stem and any(t.startswith(term) and c[0] >= 0.9 * r["toxic"] for (t, _), c in terms.items()):
            continue
        # a stem of this one that says as much
        if any((term[:k], True) in terms and terms[term[:k], True][1] * r["toxic"] <= r["clean"] * terms[term[:k], True][0] for k in STEMS):
            continue
        terms[term, stem] = r["toxic"], r["clean"]
    return list(terms), np.array(list(terms.values()), float).reshape(-1, 2)


def _odds(toxic, clean, n_toxic: int, n_clean: int):
    return np.log((toxic + 0.5) / (n_toxic + 1)) - np.log((clean + 0.5) / (n_clean + 1))


def near_counts(labelled: DataFrame, terms: list[tuple[str, bool, int]]) -> np.ndarray:
    """Documents by term, distance (1, 2) and label that hold a word at that distance of the term and no term itself within it."""
    sent = labelled.sparkSession.sparkContext.broadcast(terms)  # LEXICON terms at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie(sent.value)
        totals = np.zeros((len(sent.value), 3, 2), np.int64)
        seen: set[str] = set()
        known: dict[str, list[tuple[int, int]]] = {}
        for batch in batches:
            marks = iter(batch.column(1).to_pylist())
            for part in _stretches([text.lower() for text in batch.column(0).to_pylist()]):
                words = [set(WORDS(text)) for text in part]
                fresh = set().union(*words) - seen
                if len(seen) + len(fresh) > MAX_WORDS:
                    seen.clear(), known.clear()
                    fresh = set().union(*words)
                near = trie.near_all(_usual(fresh))
                known.update((word, found) for word, found in near.items() if all(e > 0 for _, e in found))
                seen |= fresh
                for own in words:
                    toxic = int(next(marks) > 0)
                    for k, e in {hit for word in known.keys() & own for hit in known[word]}:
                        totals[k, e, toxic] += 1
        at = np.argwhere(totals)
        yield pa.RecordBatch.from_arrays([*[pa.array(at[:, c]) for c in range(3)], pa.array(totals[tuple(at.T)])], ["term", "edits", "mark", "n"])

    counted = _arrow(labelled.select("text", "toxic"), run, "term long, edits long, mark long, n long")
    made = np.zeros((len(terms), 3, 2))
    for r in counted.groupBy("term", "edits", "mark").agg(F.sum("n").alias("n")).collect():  # six rows a term at most
        made[r["term"], r["edits"], r["mark"]] = r["n"]
    return made


def learn_lexicon(labelled: DataFrame) -> Lexicon:
    """The lexicon of ``labelled(text, toxic)``; without documents of both labels it is empty."""
    counts = common.stored(term_counts(labelled), "toxic-terms")
    totals = counts.where("term = '' and not stem").first()
    n_toxic, n_clean = (totals["toxic"], totals["clean"]) if totals else (0, 0)
    if not n_toxic or not n_clean:
        return Lexicon([], np.zeros((0, 3)))
    odds = F.log((F.col("toxic") + 0.5) / (n_toxic + 1)) - F.log((F.col("clean") + 0.5) / (n_clean + 1))
    told = counts.where((F.col("toxic") >= LEAST_DOCS) & (F.length("term") > 2)).withColumn("ratio", _ratio(F.col("toxic"), F.col("clean"), n_toxic, n_clean))
    told = told.where((odds >= LEAST_ODDS) & (F.col("ratio") >= LEAST_RATIO))
    rows = told.orderBy(F.desc("ratio"), F.asc("stem"), F.desc(F.length("term")), F.asc("term")).limit(LEXICON).collect()
    terms, seen = _chosen(rows, n_toxic, n_clean)
    if not terms:
        return Lexicon([], np.zeros((0, 3)))
    weights = np.zeros((len(terms), 3))
    weights[:, 0] = _odds(seen[:, 0], seen[:, 1], n_toxic, n_clean)
    terms = [(term, stem, allowed(term, stem, odds)) for (term, stem), odds in zip(terms, weights[:, 0].tolist(), strict=True)]
    near = near_counts(labelled, terms)
    for e in (1, 2):
        weights[:, e] = _odds(near[:, e, 1] + MISSPELLED ** e * seen[:, 0], near[:, e, 0], n_toxic, n_clean)
    return Lexicon(terms, np.minimum(weights, weights[:, :1]))


def fit(rows: np.ndarray, toxic: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Logistic weights (bias first) of rows that occur some times, drawn to PRIOR where data says little; Newton steps."""
    x = np.column_stack([np.ones(len(rows)), rows])
    weights = PRIOR.copy()
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        gradient = x.T @ (times * (p - toxic)) + STIFFNESS * (weights - PRIOR)
        hessian = (x * (times * p * (1 - p))[:, None]).T @ x + np.diag(STIFFNESS)
        step = np.linalg.solve(hessian, gradient)
        weights -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return weights


@dataclass
class Model:
    lexicon: Lexicon
    weights: np.ndarray

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """0 to 1 for each text; a text without a match has no more than its length to go by."""
        if not texts:
            return np.empty(0)
        z = self.weights[0] + np.array(features(self.lexicon, texts)) @ self.weights[1:]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """A model of ``docs(doc_id, text)`` and ``labels(doc_id, toxic)``; ids that repeat keep all their texts.

    Rows with a null id, text or label are left out. Without labels of both kinds the
    lexicon is empty and every text gets the same low score.
    """
    labelled = common.stored(_labelled(docs, labels), "toxic-labelled")
    lexicon = learn_lexicon(labelled)
    sent = docs.sparkSession.sparkContext.broadcast((lexicon.terms, lexicon.odds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Lexicon(*sent.value)
        for batch in batches:
            made = features(own, batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.list_(pa.float64())), batch.column(1).cast(pa.int64())], ["features", "toxic"])

    if not lexicon.terms:
        return Model(lexicon, PRIOR)
    # equal rows are one with a count, so an id that repeats without end is not brought here row by row
    made = _arrow(labelled.select("text", "toxic"), run, "features array<double>, toxic long")
    found = made.groupBy("features", "toxic").agg(F.count(F.lit(1)).alias("n")).toPandas()
    toxic, times = (found["toxic"].to_numpy() > 0).astype(float), found["n"].to_numpy().astype(float)
    order = np.lexsort(np.array(found["features"].tolist()).reshape(-1, len(FEATURES)).T)  # one order, whatever the partitions
    rows = np.array(found["features"].tolist()).reshape(-1, len(FEATURES))
    return Model(lexicon, fit(rows[order], toxic[order], times[order]))


def score(docs: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (doc_id by default) with score and predicted of ``text`` alone, a row per row.

    Null and empty texts and texts without a word get the score of no match.
    """
    keep = keep or ["doc_id"]
    sent = docs.sparkSession.sparkContext.broadcast((model.lexicon.terms, model.lexicon.odds, model.weights))
    rows = docs.select(*keep, F.col("text").cast("string").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, odds, weights = sent.value
        own = Model(Lexicon(terms, odds), weights)
        for batch in batches:
            scores = own.scores(batch.column(len(keep)).to_pylist())
            predicted = (scores >= TOXIC_AT).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                batch.columns[:len(keep)] + [pa.array(scores), pa.array(predicted)], batch.schema.names[:len(keep)] + ["score", "predicted"])

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(run, f"{kept}, score double, predicted int")
