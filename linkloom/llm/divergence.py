"""Quality rules by how far a document's histograms lie from its language's.

Two histograms describe a document: classes of characters (by Unicode category and
script), and the language's most common words (with one bin for all other words). Each
is compared to the language's reference, the same histogram over all documents of the
language that pass the base rule, by the Jensen-Shannon distance: the square root of the
divergence to base 2, 0 for equal and 1 for disjoint histograms. A short text is far from
any reference by chance, so texts below a minimum length are not judged, and for the
others the distance expected from chance alone, which falls with the length, is taken off.
Where a language's common words cover little of its text, as without spaces between
words, its most common pairs of letters take the words' place.

Every document is judged against something. One whose language is not known is compared
to the nearest of the largest references; one of a language with too few documents for a
reference of its own by its character classes only, to the nearest of those and of all
languages together.

References are counted over all documents: word counts are combined in the tasks, summed
by (language, word hash), and only words above a share of the language's words are kept,
at most 1 / share per language. They are a table, a row per language. Those of the
languages with the most documents, a fixed number, are sent to the tasks; any further
language holds less than that fraction of the documents, and its documents are joined
to its row.
"""

from __future__ import annotations

import functools
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm import common
from linkloom.operators import history

SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

# Guards and limits of the verdict.
JUDGED_WORDS = 50
COMMON_WORDS = 100
WORD_SHARE = 1 / 5000
REFERENCE_DOCS = 20
# References sent to all tasks (a few kilobytes each), and those among them that a document without its own is compared to.
SENT_LANGUAGES = 5000
NEAREST = 32
MAX_CLASS_DISTANCE = 0.28
MAX_WORD_DISTANCE = 0.30
# Below this share of a language's words its common words say too little.
LEAST_COVERED = 0.05

# Character classes: categories of the Latin script and of all marks, then letters by script.
CLASSES = [
    "lower", "upper", "digit", "space", "mark", "symbol", "other letter", "control",
    "greek", "cyrillic", "semitic", "indic", "southeast asian", "hangul", "kana", "han", "other script",
]
_SCRIPTS = [  # first and last code point, class
    (0x0370, 0x03FF, 8), (0x1F00, 0x1FFF, 8), (0x0400, 0x052F, 9), (0x1C80, 0x1C8F, 9), (0x0590, 0x08FF, 10), (0xFB1D, 0xFDFF, 10), (0xFE70, 0xFEFE, 10),
    (0x0900, 0x0DFF, 11), (0x0E00, 0x109F, 12), (0x1780, 0x17FF, 12), (0x1100, 0x11FF, 13), (0x3130, 0x318F, 13), (0xAC00, 0xD7FF, 13),
    (0x3040, 0x30FF, 14), (0x31F0, 0x31FF, 14), (0x2E80, 0x2FDF, 15), (0x3400, 0x4DBF, 15), (0x4E00, 0x9FFF, 15), (0xF900, 0xFAFF, 15), (0x20000, 0x323AF, 15),
    (0x0530, 0x058F, 16), (0x10A0, 0x10FF, 16), (0x1200, 0x177F, 16), (0x1800, 0x1C7F, 16), (0x2C00, 0x2DDF, 16), (0xA000, 0xABFF, 16), (0x10000, 0x1D0FF, 16),
]
# Scripts that are written without spaces between words, or with few.
_UNSPACED = (12, 13, 14, 15)


def _ascii_class(c: str) -> int:
    if c.islower():
        return 0
    if c.isupper():
        return 1
    if c.isdigit():
        return 2
    if c in " \t\n\r\x0b\x0c":
        return 3
    return 4 if c in ".,;:!?'\"()-" else 5


@functools.cache
def _class_of() -> np.ndarray:
    """The class of every code point."""
    made = np.full(0x110000, 7, np.uint8)
    script = np.full(0x32400, 255, np.uint8)
    for first, last, kind in _SCRIPTS:
        script[first:last + 1] = kind
    by_category = {"Ll": 0, "Lu": 1, "Lt": 1, "L": 6, "M": 6, "N": 2, "Z": 3, "P": 4, "S": 5, "C": 7}
    for code in range(len(script)):
        c = chr(code)
        if code < 128:
            made[code] = _ascii_class(c)
            continue
        category = unicodedata.category(c)
        own = script[code] != 255 and category[0] in "LM"
        made[code] = script[code] if own else by_category.get(category, by_category[category[0]])
    return made


def characters(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Counts of the classes, and hashes of neighbouring letters of scripts without spaces."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = _class_of()[codes]
    counts = np.bincount(kinds, minlength=len(CLASSES))
    if not counts[list(_UNSPACED)].any():
        return counts, np.empty(0, np.uint64)
    dense = np.isin(kinds, _UNSPACED)
    at = np.flatnonzero(dense[:-1] & dense[1:])
    return counts, common.mix((codes[at].astype(np.uint64) << np.uint64(32)) | codes[at + 1])


def base_figures(text: str | None) -> tuple[list[bytes], np.ndarray, dict]:
    """Words, their hashes, and the base rule's figures. Null counts as empty."""
    data = (text or "").encode("utf-8", "surrogatepass")
    found = data.split()
    hashed = common.hashes(found)
    # continuation bytes 10xxxxxx do not begin a character
    continued = np.count_nonzero((np.frombuffer(data, np.uint8) & 0xC0) == 0x80)
    spaces = len(data) - sum(map(len, found))
    lines = [line for line in data.split(b"\n") if line.strip()]
    repeated = 0
    if len(hashed) > 5:
        _, place, count = np.unique(common.windows(hashed, 5), return_inverse=True, return_counts=True)
        starts = np.flatnonzero(count[place] > 1)
        edge = np.zeros(len(hashed) + 1, np.int64)
        np.add.at(edge, starts, 1)
        np.add.at(edge, starts + 5, -1)
        repeated = int(np.count_nonzero(np.cumsum(edge)[:-1]))
    n = len(found)
    return found, hashed, {
        "n_words": n, "word_chars": len(data) - spaces - continued, "n_symbols": len(data) - len(data.translate(None, SYMBOLS)),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": repeated,
        "base_failed": n < MIN_WORDS or 100 * repeated > MAX_REPEAT_PERCENT * n,
    }


def distance(counts: np.ndarray, reference: np.ndarray) -> float:
    """Jensen-Shannon distance of a document's counts to a reference, less what chance explains.

    A sample of n from the reference itself has an expected divergence of about
    (bins - 1) / (8 n ln 2); it is taken off before the root.
    """
    n = counts.sum()
    if not n or not reference.sum():
        return 0.0
    p, q = counts / n, reference / reference.sum()
    both = (p + q) / 2
    entropy = lambda x: -float((x[x > 0] * np.log2(x[x > 0])).sum())
    divergence = entropy(both) - (entropy(p) + entropy(q)) / 2
    bins = np.count_nonzero(both)
    return float(np.sqrt(max(0.0, divergence - (bins - 1) / (8 * n * np.log(2)))))


@dataclass(frozen=True)
class Reference:
    """A language's class counts, and the hashes of its common words (or pairs of letters) with their counts and all others'."""

    classes: np.ndarray
    words: np.ndarray
    counts: np.ndarray
    pairs: bool = False

    def class_distance(self, shown: np.ndarray) -> float:
        return distance(shown, self.classes)

    def distances(self, shown: np.ndarray, hashed: np.ndarray, paired: np.ndarray) -> tuple[float, float]:
        if not len(self.words):
            return self.class_distance(shown), 0.0
        hashed = paired if self.pairs else hashed
        place = np.searchsorted(self.words, hashed)
        place[place == len(self.words)] = 0
        known = self.words[place] == hashed
        counts = np.bincount(np.where(known, place, len(self.words)), minlength=len(self.words) + 1)
        return self.class_distance(shown), distance(counts, self.counts)


@dataclass(frozen=True)
class References:
    """References of all languages that have one.

    ``sent``: of the languages with the most documents, by language, most documents first.
    ``table``: lang and reference of the others, None if there are none. ``pooled``: the
    class counts of all documents together, None if they are too few.
    """

    sent: dict[str, Reference]
    table: DataFrame | None
    pooled: np.ndarray | None


_REFERENCE = "classes array<bigint>, words array<bigint>, counts array<bigint>, pairs boolean"
# kinds of counted rows
DOCUMENTS, CHARACTERS, WORDS, ALL_WORDS, PAIRS, ALL_PAIRS = range(6)


def _made(row) -> Reference:
    """A table's row: words come in any order."""
    words = np.array(row["words"], np.int64).view(np.uint64)
    order = np.argsort(words)
    counts = np.array(row["counts"], np.int64)
    return Reference(np.array(row["classes"], np.int64), words[order], np.append(counts[:len(words)][order], counts[len(words):]), bool(row["pairs"]))


def _counted(lang: str, kind: int, keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([lang] * len(keys), pa.string()), pa.array(np.full(len(keys), kind, np.int32)), pa.array(keys.astype(np.int64)), pa.array(counts)],
        ["lang", "kind", "key", "n"],
    )


def reference_counts(docs: DataFrame) -> DataFrame:
    """lang, kind, key, n: what the documents that pass the base rule hold."""

    def count(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        figures: dict[str, np.ndarray] = {}
        seen: dict[str, Counter] = {}
        pairs: dict[str, list[np.ndarray]] = {}
        held = 0

        def flushed() -> Iterator[pa.RecordBatch]:
            for name, words in seen.items():
                yield _counted(name, WORDS, common.hashes(list(words)).view(np.int64), np.fromiter(words.values(), np.int64, len(words)))
            for name, parts in pairs.items():
                keys, n = np.unique(np.concatenate(parts), return_counts=True)
                yield _counted(name, PAIRS, keys.view(np.int64), n)
            for name, own in figures.items():
                yield _counted(name, DOCUMENTS, np.array([0]), own[:1])
                yield _counted(name, ALL_WORDS, np.array([0]), own[1:2])
                yield _counted(name, ALL_PAIRS, np.array([0]), own[2:3])
                yield _counted(name, CHARACTERS, np.arange(len(CLASSES)), own[3:])
            seen.clear(), pairs.clear(), figures.clear()

        for batch in rows:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found, hashed, base = base_figures(text)
                if base["base_failed"]:
                    continue
                shown, paired = characters(text)
                own = figures.setdefault(lang, np.zeros(3 + len(CLASSES), np.int64))
                own += np.concatenate([[1, len(found), len(paired)], shown])
                counter = seen.setdefault(lang, Counter())
                held -= len(counter)
                counter.update(found)
                held += len(counter) + 1
                if len(paired):
                    pairs.setdefault(lang, []).append(paired)
                    held += len(paired)
                if held > 150_000:
                    yield from flushed()
                    held = 0
        yield from flushed()

    rows = docs.select(F.col("text").cast("string"), F.col("lang").cast("string")).where("lang is not null")
    return rows.mapInArrow(count, "lang string, kind int, key long, n long").groupBy("lang", "kind", "key").agg(F.sum("n").alias("n"))


def reference_table(counts: DataFrame, common_words: int = COMMON_WORDS, word_share: float = WORD_SHARE) -> DataFrame:
    """lang, documents, classes, words, counts, pairs of every language with enough documents; counts end with that of all other words."""
    of = lambda kind: F.sum(F.when(F.col("kind") == kind, F.col("n")))
    shown = [F.coalesce(F.sum(F.when((F.col("kind") == CHARACTERS) & (F.col("key") == k), F.col("n"))), F.lit(0)) for k in range(len(CLASSES))]
    totals = counts.where(~F.col("kind").isin(WORDS, PAIRS)).groupBy("lang").agg(
        of(DOCUMENTS).alias("documents"), of(ALL_WORDS).alias("_words"), of(ALL_PAIRS).alias("_pairs"), F.array(*shown).alias("classes"))
    totals = common.stored(totals.where(F.col("documents") >= REFERENCE_DOCS), "reference-totals")
    bounds = totals.select("lang", F.explode(F.array(
        F.struct(F.lit(WORDS).alias("kind"), F.col("_words").alias("all")), F.struct(F.lit(PAIRS).alias("kind"), F.col("_pairs").alias("all")))).alias("_b"))
    bounds = history.broadcast_if_small(bounds.select("lang", "_b.*"))
    often = counts.where(F.col("kind").isin(WORDS, PAIRS)).join(bounds, ["lang", "kind"]).where(F.col("n") >= F.col("all") * word_share)
    # at most 1 / share rows a language and kind; the first by count, then key
    ranked = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "key"))), 1, common_words)
    top = often.groupBy("lang", "kind", "all").agg(ranked.alias("_top")).select(
        "lang", "kind", "all", F.transform("_top", lambda t: t["key"]).alias("words"), F.transform("_top", lambda t: -t["n"]).alias("counts"))
    top = top.withColumn("_sum", F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x))
    top = top.select("lang", "kind", "words", F.array_append("counts", F.col("all") - F.col("_sum")).alias("counts"), (F.col("_sum") / F.col("all")).alias("_covered"))
    words = top.where(F.col("kind") == WORDS).drop("kind")
    pairs = top.where(F.col("kind") == PAIRS).select("lang", F.struct("words", "counts").alias("_by_pairs"))
    both = totals.join(words, "lang", "left").join(pairs, "lang", "left")
    paired = F.col("_by_pairs").isNotNull() & (F.coalesce("_covered", F.lit(0.0)) < LEAST_COVERED)
    none = F.array().cast("array<bigint>")
    return both.select(
        "lang", "documents", "classes", F.coalesce(F.when(paired, F.col("_by_pairs.words")).otherwise(F.col("words")), none).alias("words"),
        F.coalesce(F.when(paired, F.col("_by_pairs.counts")).otherwise(F.col("counts")), F.array(F.col("_words"))).alias("counts"), paired.alias("pairs"),
    )


def references(docs: DataFrame, common_words: int = COMMON_WORDS, word_share: float = WORD_SHARE) -> References:
    """References of the languages in ``docs(text, lang)``, however many, with enough documents that pass the base rule."""
    counts = common.stored(reference_counts(docs), "reference-counts")
    made = common.stored(reference_table(counts, common_words, word_share), "references")
    first = made.orderBy(F.desc("documents"), "lang").limit(SENT_LANGUAGES).collect()
    sent = {row["lang"]: _made(row) for row in first}
    table = None
    if len(sent) == SENT_LANGUAGES:
        rest = made.join(F.broadcast(docs.sparkSession.createDataFrame([(name,) for name in sent], "lang string")), "lang", "left_anti")
        table = None if rest.isEmpty() else rest.drop("documents")
    pooled = np.zeros(len(CLASSES), np.int64)
    documents = 0
    for row in counts.where(F.col("kind").isin(DOCUMENTS, CHARACTERS)).groupBy("kind", "key").agg(F.sum("n").alias("n")).collect():
        if row["kind"] == DOCUMENTS:
            documents = row["n"]
        else:
            pooled[row["key"]] = row["n"]
    return References(sent, table, pooled if documents >= REFERENCE_DOCS else None)


def judge(docs: DataFrame, known: References, keep: list[str] | None = None,
          max_class: float = MAX_CLASS_DISTANCE, max_word: float = MAX_WORD_DISTANCE, judged_words: int = JUDGED_WORDS) -> DataFrame:
    """``keep`` columns (doc_id by default), the base figures, both distances and the verdict ``kept``.

    Null texts count as empty and fail the base rule. A document that passes it is kept
    unjudged if it is below ``judged_words`` or too few documents passed to compare it to.
    Distances are null where there is no reference: both in the latter case, that of the
    words for a document of a language without a reference of its own.
    """
    keep = keep or ["doc_id"]
    nearest = list(known.sent.values())[:NEAREST]
    sent = docs.sparkSession.sparkContext.broadcast((known.sent, nearest, known.pooled))  # SENT_LANGUAGES at most
    rows = docs.select(*keep, F.col("text").cast("string").alias("_text"), F.col("lang").cast("string").alias("_lang"))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-2])
    shape = f"struct<{', '.join(part.replace(' ', ':', 1) for part in _REFERENCE.split(', '))}>"
    own = F.lit(None).cast(shape).alias("_own")
    if known.table is None:
        rows = rows.select("*", own)
    else:
        # languages beyond those sent hold less than one part in SENT_LANGUAGES of the documents each
        others = known.table.select(F.col("lang").alias("_lang"), F.struct("classes", "words", "counts", "pairs").cast(shape).alias("_own"))
        names = F.broadcast(docs.sparkSession.createDataFrame([(name,) for name in known.sent], "_lang string"))
        common_ones = rows.join(names, "_lang", "left_semi").unionByName(rows.where("_lang is null"))
        rare = rows.where("_lang is not null").join(names, "_lang", "left_anti").join(others, "_lang", "left")
        rows = common_ones.select("*", own).unionByName(rare.select(*common_ones.columns, "_own"))
        rows = rows.select(*keep, "_text", "_lang", "_own")
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "class_distance", "word_distance", "kept"]
    kinds = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.float64(), pa.bool_()]

    def far(text: str, lang: str | None, own: dict | None, hashed: np.ndarray) -> tuple[float | None, float | None]:
        known, nearest, pooled = sent.value
        shown, paired = characters(text)
        reference = known.get(lang) if own is None else _made(own)
        if reference is not None:
            return reference.distances(shown, hashed, paired)
        if lang is None:
            return min((one.distances(shown, hashed, paired) for one in nearest), key=sum, default=(None, None))
        against = [one.class_distance(shown) for one in nearest] + ([] if pooled is None else [distance(shown, pooled)])
        return min(against, default=None), None

    def score(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            out = []
            for text, lang, own in zip(*(batch.column(len(keep) + k).to_pylist() for k in range(3)), strict=True):
                _, hashed, base = base_figures(text)
                by_class, by_word = far(text or "", lang, own, hashed)
                odd = base["n_words"] >= judged_words and ((by_class or 0) > max_class or (by_word or 0) > max_word)
                out.append([*base.values(), by_class, by_word, not base["base_failed"] and not odd])
            columns = [pa.array([row[k] for row in out], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(batch.columns[:len(keep)] + columns, batch.schema.names[:len(keep)] + names)

    return rows.mapInArrow(
        score, f"{kept}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
        "class_distance double, word_distance double, kept boolean",
    )
