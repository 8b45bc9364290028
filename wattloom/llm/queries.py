"""Registered queries: each operator over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.llm import (
    common,
    decontaminate,
    grid_join,
    html_blocks,
    maxscore,
    pack,
    pii,
    preference,
    resample,
    simhash,
    token_files,
    toxicity,
    warc,
    whiten,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]):
    QUERIES[function.__name__] = function
    return function


@query
def op2_grid_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid_join.groups(common.table(common.prepare(spark), sf_dir, "embeddings"))


@query
def op3_prefix_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    common.prepare(spark)
    found = decontaminate.report(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


@query
def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.groups(common.table(common.prepare(spark), sf_dir, "documents"))
    return found.withColumn("fingerprint", simhash.hexadecimal(F.col("fingerprint")))


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op5_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = pack.pieces(common.table(common.prepare(spark), sf_dir, "documents"), vocabulary())
    return cut.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@query
def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = token_files.round_trip(common.table(common.prepare(spark), sf_dir, "documents"), vocabulary())
    return back.select(F.col("key").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op10_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = preference.replaced_replies(common.table(common.prepare(spark), sf_dir, "conversations"))
    return (
        preference.format_pairs(turns)
        .withColumn("chosen_mask", preference.mask_text("chosen_mask"))
        .withColumn("rejected_mask", preference.mask_text("rejected_mask"))
    )


SQL["op10_preference"] = """
WITH marked AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
         coalesce(role, '') = 'assistant' AND row_number() OVER (
           PARTITION BY conv_id, coalesce(role, '') ORDER BY turn DESC NULLS LAST, coalesce(text, '') DESC) = 1 AS last
  FROM conversations WHERE conv_id IS NOT NULL),
sides AS (
  SELECT conv_id AS pair_id, 0 AS side, conv_id, turn, role, text FROM marked
  UNION ALL
  SELECT m.conv_id, 1, coalesce(l.conv_id, m.conv_id), m.turn, m.role,
         CASE WHEN m.last THEN coalesce(l.text, '') ELSE m.text END
  FROM marked m LEFT JOIN (SELECT * FROM marked WHERE last) l ON l.conv_id = xor(m.conv_id, 1)),
turns AS (
  SELECT *, '<|im_start|>' || role || chr(10) AS head,
         '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) AS rendered
  FROM sides),
placed AS (
  SELECT *, row_number() OVER w AS k, sum(length(rendered)) OVER w AS stop FROM turns
  WINDOW w AS (PARTITION BY pair_id, side ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING)),
lengths AS (
  SELECT pair_id, max(conv_id) FILTER (side = 0) AS chosen_id, max(conv_id) FILTER (side = 1) AS rejected_id,
         least(count(*) FILTER (side = 0), count(*) FILTER (side = 1)) AS shorter
  FROM placed GROUP BY pair_id),
differing AS (
  SELECT c.pair_id, min(c.k) AS k FROM placed c JOIN placed r ON c.pair_id = r.pair_id AND c.k = r.k
  WHERE c.side = 0 AND r.side = 1 AND (c.role <> r.role OR c.text <> r.text) GROUP BY c.pair_id),
common AS (
  SELECT l.*, coalesce(d.k - 1, l.shorter) AS n_common FROM lengths l LEFT JOIN differing d USING (pair_id)),
ends AS (
  SELECT c.*, coalesce(max(p.stop), 0) AS before FROM common c
  LEFT JOIN placed p ON p.pair_id = c.pair_id AND p.side = 0 AND p.k <= c.n_common
  GROUP BY ALL)
SELECT e.pair_id, e.chosen_id, e.rejected_id, e.n_common,
  coalesce(string_agg(rendered, '' ORDER BY k) FILTER (side = 0 AND k <= n_common), '') AS prompt,
  coalesce(string_agg(rendered, '' ORDER BY k) FILTER (side = 0 AND k > n_common), '') AS chosen,
  coalesce(string_agg(rendered, '' ORDER BY k) FILTER (side = 1 AND k > n_common), '') AS rejected,
  coalesce(string_agg(cast(stop - length(rendered) + length(head) - before AS BIGINT) || ':' || cast(stop - 1 - before AS BIGINT), ',' ORDER BY k)
    FILTER (side = 0 AND k > n_common AND role = 'assistant'), '') AS chosen_mask,
  coalesce(string_agg(cast(stop - length(rendered) + length(head) - before AS BIGINT) || ':' || cast(stop - 1 - before AS BIGINT), ',' ORDER BY k)
    FILTER (side = 1 AND k > n_common AND role = 'assistant'), '') AS rejected_mask
FROM ends e JOIN placed p ON p.pair_id = e.pair_id
GROUP BY e.pair_id, e.chosen_id, e.rejected_id, e.n_common, e.before
"""


@query
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.round_trip(common.table(common.prepare(spark), sf_dir, "pages"))
    return found.where("kind = 'record'").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL["op8_warc"] = """
WITH facts AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
  FROM pages),
shared AS (
  SELECT payload_digest, max(page_id) AS response FROM facts WHERE payload_bytes >= 1000
  GROUP BY payload_digest HAVING count(*) > 1)
SELECT f.page_id, cast(f.payload_bytes AS BIGINT) AS payload_bytes, f.payload_digest,
  CASE WHEN s.response IS NOT NULL AND s.response IS DISTINCT FROM f.page_id AND f.payload_bytes >= 1000
       THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN s.response IS DISTINCT FROM f.page_id AND f.payload_bytes >= 1000 THEN s.response END AS refers_to
FROM facts f LEFT JOIN shared s USING (payload_digest)
"""


@query
def op1_weak_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    common.prepare(spark)
    docs = common.table(spark, sf_dir, "documents")
    model = toxicity.train(docs, common.table(spark, sf_dir, "labels"))
    return toxicity.scored(docs, model, ["doc_id"]).select(
        "doc_id",
        toxicity.held_out("doc_id").alias("held_out"),
        F.col("_score").alias("score"),
        (F.col("_score") >= 0.5).cast("int").alias("predicted"),
    )


@query
def op7_html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = common.table(common.prepare(spark), sf_dir, "pages")
    found = html_blocks.main_text(pages, ["page_id", "url"]).withColumnRenamed("_text", "text")
    return found.withColumn("n_chars", F.length("text").cast("long"))


@query
def op6_bootstrapped_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.spans(common.table(common.prepare(spark), sf_dir, "documents"))
    of_kind = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id",
        *map(of_kind, pii.KINDS),
        F.sha2(pii.digest_text("base"), 256).alias("base_sha256"),
        pii.digest_text("spans").alias("spans"),
    )


@query
def op11_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = common.table(common.prepare(spark), sf_dir, "embeddings")
    return maxscore.top_k(vectors, F.col("_id") % 100 == 0)


SQL["op11_maxscore"] = """
WITH vectors AS (
  SELECT vec_id, [floor(1024 * cast(c AS DOUBLE)) FOR c IN embedding] AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([c FOR c IN embedding IF c IS NULL OR NOT isfinite(c)]) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, cast(list_inner_product(q.x, c.x) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON c.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, cast(row_number() OVER w AS INTEGER) AS rank, vec_id, score FROM scored
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY rank <= 10
"""


@query
def op12_qd_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten.whitened(common.table(common.prepare(spark), sf_dir, "embeddings"))


@query
def op13_interned_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    common.prepare(spark)
    return resample.resampled(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))
