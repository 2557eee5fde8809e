"""Small tables with the awkward rows every operator has to take."""

from __future__ import annotations

from pyspark.sql import types as T

# Names the operators use themselves; inputs may bring columns of the same name.
CLASHING = ["ids", "node", "bands", "start", "length", "row_key", "held", "_text", "lang_pred", "component_id", "block", "kept", "shares"]

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])


def documents(spark, rows, clashing=True):
    """Documents from (doc_id, text) or (doc_id, text, lang), with clashing extra columns."""
    made = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", None if r[1] is None else len(r[1])) for r in rows]
    df = spark.createDataFrame(made, DOCUMENTS)
    if clashing:
        from pyspark.sql import functions as F

        df = df.withColumns({name: F.lit("x") for name in CLASHING})
    return df


def words_of(seed: int, n: int, vocabulary: int = 400) -> list[str]:
    import random

    rng = random.Random(seed)
    return ["w%d" % rng.randrange(vocabulary) for _ in range(n)]


LONG = " ".join(words_of(99, 30_000, 5000))
AWKWARD = [
    (1, "One text, of some words.\nAnd more of them."), (2, None), (3, ""), (4, "   \n\t "), (5, LONG), (6, "é ü 日本 😀 <|endoftext|>"),
    (7, "a"), (7, "a"), (8, "a"), (None, "no id here"), (9, "  two  spaces \n\n and\tmore "), (10, "12345 !!! ***"),
]
