"""Language identification as a mixture of languages, fitted per document.

A language's model is the frequency of hashed letter trigrams in its training texts.
A document is taken as drawn from a mixture of languages: expectation-maximisation
on its trigrams estimates each language's share, and the set of languages is the one
with the best likelihood after a penalty per language. The predicted language has
the largest share.

Learning counts trigrams of all training rows: a table of (language, bin) sums, which
is bounded by the languages and 2^15 bins, is all that reaches the driver and is sent
to the tasks. Prediction reads each text alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.llm import common

UNKNOWN = "und"
BITS = 15
# Each trigram overlaps the next two, so a document's evidence counts a third; the rest is the usual half log n per share.
PENALTY = 1.5
ROUNDS = 12

# A-Z folded; what is neither an ASCII letter nor part of a longer character separates words.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def bins(text: str) -> np.ndarray:
    """Hashed trigrams of a text's words, each with the space around it."""
    words = text.encode("utf-8", "surrogatepass").translate(_LETTERS).split()
    if not words:
        return np.empty(0, np.int64)
    letters = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8).astype(np.uint32)
    key = (letters[:-2] << np.uint32(16)) | (letters[1:-1] << np.uint32(8)) | letters[2:]
    return ((key * np.uint32(2654435761)) >> np.uint32(32 - BITS)).astype(np.int64)


@dataclass(frozen=True)
class Model:
    """Languages in alphabetical order and the log probability of each bin in each."""

    languages: list[str]
    log_p: np.ndarray

    def predict(self, text: str | None) -> tuple[str, float, list[str], list[float]]:
        """Language, score, and the selected languages with their shares, largest first.

        The score is the share; for a document of one language, its posterior against
        the others. Texts that are null or have no letter are ``und`` with score 0.
        """
        if not text or not any(map(str.isalpha, text)) or not self.languages:
            return UNKNOWN, 0.0, [], []
        found = bins(text)
        if not len(found):
            return UNKNOWN, 0.0, [], []
        kept, counts = np.unique(found, return_counts=True)
        log_p, counts = self.log_p[:, kept], counts.astype(float)
        n = counts.sum()
        top = log_p.max(axis=0)
        likelihood = np.exp(log_p - top)
        alone = log_p @ counts
        best = int(alone.argmax())
        base = float(top @ counts)
        penalty = 3 * PENALTY * np.log(n + 1)

        def fit(members: np.ndarray) -> tuple[np.ndarray, float]:
            p = likelihood[members]
            share = np.full(len(members), 1 / len(members))
            for _ in range(ROUNDS):
                share = share * (p @ (counts / (share @ p))) / n
            return share, base + float(np.log(share @ p) @ counts)

        members = np.arange(len(self.languages))
        shares, fitted = (np.ones(1), float(alone[best])) if len(members) == 1 else fit(members)
        if len(members) == 1 or fitted - penalty <= alone[best]:
            posterior = 1 / np.exp((alone - alone[best]) / 3).sum()
            return self.languages[best], float(posterior), [self.languages[best]], [1.0]
        value = fitted - penalty * len(members)
        while len(members) > 1:
            fewer = members[shares > max(1e-3, shares.min())] if len(members) > 2 else members[[int(shares.argmax())]]
            less, fitted = fit(fewer) if len(fewer) > 1 else (np.ones(1), float(alone[fewer[0]]))
            if fitted - penalty * len(fewer) < value:
                break
            members, shares, value = fewer, less, fitted - penalty * len(fewer)
        if len(members) == 1:
            members = np.array([best])
        order = np.argsort(-shares, kind="stable")
        names = [self.languages[members[k]] for k in order]
        return names[0], float(min(1.0, shares[order[0]])), names, [float(min(1.0, shares[k])) for k in order]


def learn(docs: DataFrame) -> Model:
    """Models of all languages in ``docs(text, lang)``; rows with a null in either are left out."""

    def count(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in rows:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = totals.setdefault(lang, np.zeros(1 << BITS, np.int64))
                found = bins(text)
                if len(found) > 4096:
                    own += np.bincount(found, minlength=len(own))
                else:
                    np.add.at(own, found, 1)
        for lang, own in totals.items():
            kept = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(kept), pa.string()), pa.array(kept), pa.array(own[kept])], ["lang", "bin", "n"])

    rows = docs.select(F.col("text").cast("string"), F.col("lang").cast("string")).where("text is not null and lang is not null")
    counted = rows.mapInArrow(count, "lang string, bin long, n long").groupBy("lang", "bin").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(set(counted["lang"]))
    table = np.zeros((len(languages), 1 << BITS))
    if languages:
        place = {lang: k for k, lang in enumerate(languages)}
        table[counted["lang"].map(place).to_numpy(), counted["bin"].to_numpy()] = counted["n"].to_numpy()
    smooth = table + 0.5
    return Model(languages, np.log(smooth / smooth.sum(axis=1, keepdims=True)))


def predict(docs: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (doc_id by default) with lang_pred, score, languages and shares, from ``text`` alone."""
    keep = keep or ["doc_id"]
    known = docs.sparkSession.sparkContext.broadcast(model)  # languages x 2^15 numbers
    rows = docs.select(*keep, F.col("text").cast("string").alias("_text"))

    def score(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            found = [known.value.predict(text) for text in batch.column(len(keep)).to_pylist()]
            langs, scores, sets, shares = zip(*found, strict=True) if found else ([], [], [], [])
            columns = [pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(sets, pa.list_(pa.string())), pa.array(shares, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(batch.columns[:len(keep)] + columns, batch.schema.names[:len(keep)] + ["lang_pred", "score", "languages", "shares"])

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(score, f"{kept}, lang_pred string, score double, languages array<string>, shares array<double>")


def fold(doc_id: str, parts: int) -> Column:
    """Which of ``parts`` folds an id falls into; a null id counts as an empty string."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % parts
