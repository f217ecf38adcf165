"""The registered query of each operator, over the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martmill.llm import align, html, jaccard, langid, mix, mixlm, nra, pack, secretscan, shard, syncmers, topk, warc
from martmill.llm.ship import shipped
from martmill.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE[fn.__name__] = sql.strip()
        return fn

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return shipped(tune(spark)).read.parquet(f"{sf_dir}/{name}.parquet")


def _held(key: str, modulus: int):
    """crc32 of the id as text, modulo; an id that is null counts as the empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % modulus


@_query("""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
)
SELECT * FROM r WHERE rank <= 5
""")
def op1_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest vectors by integer inner product of every vector whose id is divisible by 50."""
    vectors = topk.integer_vectors(_table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return topk.top_k(vectors.where(F.col("id") % 50 == 0), vectors)


@_query()
def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = _table(spark, sf_dir, "pages")
    return html.extract(pages, html.fitted(pages))


@_query()
def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards by key."""
    return shard.shard_rows(_table(spark, sf_dir, "documents"))


@_query()
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those whose remainder is not 1."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang", (_held("doc_id", 3) == 1).alias("held_out"))
    langs, vectors = langid.prototypes(docs.where(~F.col("held_out")))
    return langid.predict(docs.drop("lang"), langs, vectors).select("row.doc_id", "row.held_out", "lang_pred", "score")


@_query()
def op5_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A metadata record and a plain-text conversion record of every page's response."""
    return warc.derive(warc.responses(_table(spark, sf_dir, "pages")), keep=("page_id", "url"))


@_query()
def op6_syncmer_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    return syncmers.fingerprints(_table(spark, sf_dir, "documents"))


@_query(r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM w
), e AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM s
), links AS (
  SELECT a.doc_id AS u, b.doc_id AS v FROM e a JOIN e b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 75 * (any_value(a.n) + any_value(b.n) - count(*))
), reach AS (
  SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, l.v FROM reach r JOIN links l ON r.other = l.u
)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, m.component_id
FROM s JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) m USING (doc_id)
""")
def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The component of every document under shingle similarity of 0.75."""
    return jaccard.join_components(_table(spark, sf_dir, "documents"))


@_query()
def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log probability of every document, learned from those whose remainder is not 0."""
    return mixlm.scores(_table(spark, sf_dir, "documents"), _held("doc_id", 10) == 0)


@_query()
def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken of every document by the mix of sources."""
    return mix.mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@_query()
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as pieces of sequences of at most 2048 tokens."""
    return pack.pack(pack.cut(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")))


@_query(r"""
WITH d AS (
  SELECT row_number() OVER () AS uid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents
), q AS (
  SELECT row_number() OVER () AS qid, item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM benchmark
), s AS (SELECT count(*) AS n, CAST(sum(len(w)) AS BIGINT) AS l FROM d WHERE len(w) > 0
), t AS (SELECT uid, term, count(*) AS tf FROM (SELECT uid, unnest(w) AS term FROM d) GROUP BY ALL
), f AS (SELECT term, CAST(floor(1000 * ln((2 * s.n + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM t, s GROUP BY term, s.n
), r AS (
  SELECT a.qid, a.item_id, d.doc_id, CAST(sum(f.w * ((1000000000 * t.tf) // (1000 * t.tf + 8 * (10 + (90 * len(d.w) * s.n) // s.l)))) AS BIGINT) AS score
  FROM (SELECT DISTINCT qid, item_id, unnest(w) AS term FROM q) a JOIN f USING (term) JOIN t USING (term) JOIN d USING (uid), s
  GROUP BY a.qid, a.item_id, t.uid, d.doc_id
), o AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM r WHERE score > 0
)
SELECT * FROM o WHERE rank <= 10
""")
def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 documents that score highest for every benchmark item."""
    return nra.search(nra.index(_table(spark, sf_dir, "documents")), nra.queries_of(_table(spark, sf_dir, "benchmark")))


def secrets_digest(scanned: DataFrame) -> DataFrame:
    """The base spans' counts and digest, and all spans as text, of ``secretscan.scan``'s rows."""
    count = lambda kind: F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")
    return scanned.select("row.doc_id", *map(count, secretscan.KINDS), F.sha2(secretscan.joined(F.col("spans"), True), 256).alias("base_sha256"), secretscan.joined(F.col("spans")).alias("spans"))


@_query()
def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Credentials of every document: by rule, and by the formats learned from these."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scanned = secretscan.scan(docs, secretscan.fitted(docs))
    return secrets_digest(scanned)


@_query()
def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids aligned with piece ids in every document."""
    return align.align(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
