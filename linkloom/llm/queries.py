"""One query per operator over its whole table, and SQL where SQL can state it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.llm import collocations, dac, divergence, hyperminhash, interpolation, langid, mincut, packing, pieces, pivots, tokens, toxicity, warc, whitening

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL_TEXT: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(build: Query) -> Query:
        QUERIES[name] = build
        if sql is not None:
            SQL_TEXT[name] = sql
        return build

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def definition(name: str) -> str:
    return tokens.definition_of(public_tokenizers.path(name))


@query(
    "op1_index_merge",
    """
    WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
    d AS (SELECT page_id, strlen(payload) AS payload_bytes, sha1(payload) AS hex FROM p),
    r AS (SELECT *, min(page_id) OVER (PARTITION BY hex) AS first_id FROM d)
    SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
      list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((
        ((strpos('0123456789abcdef', substr(hex, 1 + CAST(5 * i // 4 AS INTEGER), 1)) - 1) * 16
         + CASE WHEN 5 * i // 4 + 1 < 40 THEN strpos('0123456789abcdef', substr(hex, 2 + CAST(5 * i // 4 AS INTEGER), 1)) - 1 ELSE 0 END)
        >> CAST(3 - (5 * i) % 4 AS INTEGER)) & 31 AS INTEGER), 1)), 'string_agg', '') AS payload_digest,
      CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
      CASE WHEN page_id <> first_id THEN first_id END AS refers_to
    FROM r
    """,
)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.archive_pages(table(spark, sf_dir, "pages"))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query(
    "op2_hyperminhash",
    r"""
    WITH RECURSIVE w AS (
      SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents
    ),
    s AS (
      SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
        ELSE list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) END) AS shingle FROM w
    ),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
    links AS (SELECT x, y FROM shared JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 85 * (a.n + b.n - c)),
    reach(x, y) AS (SELECT x, y FROM links UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x),
    top AS (SELECT x AS doc_id, min(least(x, y)) AS top FROM reach GROUP BY x)
    SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(top, doc_id) AS component_id, coalesce(top, doc_id) = doc_id AS kept
    FROM w LEFT JOIN n USING (doc_id) LEFT JOIN top USING (doc_id)
    """,
)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hyperminhash.near_groups(table(spark, sf_dir, "documents"), hyperminhash.Rule(words=3, percent=85)).drop("first")


@query("op3_addressable_codes")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = dac.write_shards(table(spark, sf_dir, "documents"), definition("byte_bpe_50k.json"), literal=False)
    return dac.read_documents(manifest)


@query("op4_minimum_cut")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mincut.extract(table(spark, sf_dir, "pages"))


@query("op5_sum_of_squares")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.stored_pieces(table(spark, sf_dir, "documents"), definition("word_bpe_49k.json"), literal=False)
    return packing.pack(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query("op6_language_mixture")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", langid.fold("doc_id", 3) == 1)
    model = langid.learn(docs.where(~F.col("held_out")))
    return langid.predict(docs, model, ["doc_id", "held_out"])


@query("op7_deleted_interpolation")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return interpolation.score_documents(docs.withColumn("held_out", langid.fold("doc_id", 7) == 2))


@query(
    "op8_pivot_annuli",
    """
    WITH v AS (
      SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS c
      FROM embeddings WHERE embedding IS NOT NULL AND list_count(embedding) = len(embedding)
        AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0
    ),
    s AS (
      SELECT q.vec_id AS query_id, v.vec_id,
        CAST(list_sum(list_transform(range(1, len(q.c) + 1), lambda i: q.c[i] * v.c[i])) AS BIGINT) AS score
      FROM v q, v WHERE q.vec_id % 50 = 0 AND q.vec_id <> v.vec_id
    ),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
    SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
    """,
)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivots.search(table(spark, sf_dir, "embeddings"), F.pmod("vec_id", F.lit(50)) == 0, 5)


@query("op9_piece_backend")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = pieces.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return encoded.drop("ids")


@query("op10_divergence")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return divergence.judge(docs, divergence.references(docs))


@query(
    "op12_top_order_rollup",
    r"""
    WITH p AS (
      SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
      FROM documents
    ),
    w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM p),
    g AS (
      SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS phrase
      FROM w, (VALUES (1), (2), (3)) AS sizes(k)
    ),
    f AS (SELECT lang, k, phrase, count(*)::HUGEINT AS f FROM g GROUP BY ALL),
    t AS (SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang),
    c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1 AND f >= 10),
    cuts AS (
      SELECT c.lang, c.k, c.phrase, a, cut, l.f AS l, r.f AS r, (1000000 * a * a) // (l.f * r.f) AS score
      FROM (SELECT *, unnest(range(1, k)) AS cut FROM c) c
      JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.ws[1:cut], ' ')
      JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.ws[cut + 1:c.k], ' ')
    ),
    s AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
    inside AS (
      SELECT lang, phrase, max(a) AS longest
      FROM (SELECT lang, a, unnest([array_to_string(ws[1:2], ' '), array_to_string(ws[2:3], ' ')]) AS phrase FROM c WHERE k = 3) GROUP BY ALL
    ),
    o AS (
      SELECT s.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
      FROM s LEFT JOIN inside USING (lang, phrase) WHERE longest IS NULL OR 100 * longest < 50 * a
    )
    SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
    FROM o JOIN t USING (lang) WHERE rank <= 2000
    """,
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"))


@query("op13_rank_one_whitening")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@query("op11_levenshtein_lexicon")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", langid.fold("doc_id", 3) == 1)
    model = toxicity.learn(docs.where(~F.col("held_out")), table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, ["doc_id", "held_out"])
