"""Registered queries of the operators, each over the whole of its tables."""

from __future__ import annotations

import importlib.util
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shroud.llm.common import table
from shroud.llm.decontaminate import contaminated_documents
from shroud.llm.exact_dedup import dedup_groups
from shroud.llm.language_id import languages
from shroud.llm.line_dedup import line_decisions
from shroud.llm.merkle import tamper_check
from shroud.llm.periodic_runs import run_digest, with_planted_repeat
from shroud.llm.quality import quality_scores
from shroud.llm.secret_scan import secret_digest
from shroud.llm.sentencepiece_codec import encode_documents
from shroud.llm.sharding import shard_rows
from shroud.llm.simhash import simhash_groups
from shroud.llm.token_counts import token_counts
from shroud.llm.url_filter import filter_urls

SHARDS = 8
# The rules that judge a URL first.
URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
             ("block", "net/es/"), ("block", "net/fr/")]


def tokenizer_file(name: str) -> str:
    """The place of a public tokenizer's file: in $SHROUD_TOKENIZERS, else where the
    ``public_tokenizers`` package has it.  Executors need it at the same place."""
    folder = os.environ.get("SHROUD_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    if importlib.util.find_spec("public_tokenizers") is not None:
        import public_tokenizers

        return public_tokenizers.path(name)
    return os.path.join("/opt/tokenizers", name)


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    coded = encode_documents(docs, tokenizer_file("piece_bpe_32k.model"), decoded_name="decoded")
    return coded.select("doc_id", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids",
                        (F.col("decoded") == F.col("text")).alias("round_trip"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contaminated_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumn("item_ids", F.array_join("item_ids", ","))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_groups(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages(table(spark, sf_dir, "documents"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shard_rows(table(spark, sf_dir, "documents"), SHARDS)
    return rows.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_digest(table(spark, sf_dir, "documents"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_decisions(table(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tamper_check(table(spark, sf_dir, "documents"))


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"), URL_RULES)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return run_digest(docs.select("doc_id", with_planted_repeat(docs).alias("text")))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_sentencepiece, op2_token_counts, op3_decontaminate, op4_simhash, op5_exact_dedup,
        op6_language_id, op7_sharding, op8_secret_scan, op9_line_dedup, op10_quality,
        op11_merkle, op12_url_filter, op13_periodic_runs, pipeline)
}

def _merkle_sql() -> str:
    """The manifest by recursion over levels; the crc32 of an id is computed bit by bit
    (fixed value: 3988292384 is the reflected polynomial of CRC-32)."""
    def field(c: str) -> str:
        return f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || {c} END"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    return f"""
WITH RECURSIVE ids AS (SELECT DISTINCT CAST(doc_id AS VARCHAR) AS d FROM documents WHERE doc_id IS NOT NULL),
crc AS (
  SELECT d, 0 AS i, CAST(4294967295 AS BIGINT) AS c FROM ids
  UNION ALL
  SELECT d, i + 1, CASE WHEN i % 9 = 0 THEN xor(c, ascii(substr(d, i // 9 + 1, 1)))
                        ELSE xor(c >> 1, 3988292384 * (c & 1)) END
  FROM crc WHERE i < 9 * length(d)),
odd AS (SELECT d FROM crc WHERE i = 9 * length(d) AND xor(c, 4294967295) % 2 = 1),
leaves AS (
  SELECT doc_id, source, {leaf('text')} AS leaf,
         CASE WHEN CAST(doc_id AS VARCHAR) IN (SELECT d FROM odd) THEN {leaf('text')}
              ELSE {leaf("replace(text, chr(10), '')")} END AS shown,
         dense_rank() OVER (ORDER BY source NULLS FIRST) AS grp FROM documents),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
         count(*) OVER (PARTITION BY grp) AS n FROM leaves),
up AS (
  SELECT grp, 0 AS lvl, idx, n, leaf AS h FROM placed
  UNION ALL
  SELECT grp, lvl + 1, idx // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY idx))
  FROM up WHERE n > 1 GROUP BY grp, lvl, idx // 3, n),
subroots AS (SELECT grp, h, lvl AS top, row_number() OVER (ORDER BY grp) - 1 AS idx,
                   count(*) OVER () AS n FROM up WHERE n = 1),
above AS (
  SELECT 0 AS lvl, idx, n, h FROM subroots
  UNION ALL
  SELECT lvl + 1, idx // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY idx))
  FROM above WHERE n > 1 GROUP BY lvl, idx // 3, n),
nodes AS (
  SELECT grp, lvl, idx, h FROM up WHERE n > 1
  UNION ALL
  SELECT s.grp, s.top + a.lvl, a.idx, a.h FROM above a, subroots s
  WHERE a.n > 1 AND a.idx // 3 = s.idx // CAST(pow(3, a.lvl + 1) AS BIGINT)),
walk AS (
  SELECT p.grp, p.idx AS leaf_idx, 0 AS lvl, CASE WHEN s.top = 0 THEN s.idx ELSE p.idx END AS at,
         p.shown AS acc, '' AS proof FROM placed p JOIN subroots s ON s.grp = p.grp
  UNION ALL
  SELECT w.grp, w.leaf_idx, w.lvl + 1,
         CASE WHEN w.lvl + 1 = s.top THEN s.idx ELSE w.at // 3 END,
         sha256(coalesce(string_agg(k.h, '' ORDER BY k.idx) FILTER (k.idx < w.at), '') || w.acc ||
                coalesce(string_agg(k.h, '' ORDER BY k.idx) FILTER (k.idx > w.at), '')),
         w.proof || coalesce(string_agg(k.h, '' ORDER BY k.idx) FILTER (k.idx <> w.at), '')
  FROM walk w JOIN nodes k ON k.grp = w.grp AND k.lvl = w.lvl AND k.idx // 3 = w.at // 3
  JOIN subroots s ON s.grp = w.grp
  GROUP BY w.grp, w.leaf_idx, w.lvl, w.at, w.acc, w.proof, s.top, s.idx),
folded AS (SELECT grp, leaf_idx, arg_max(acc, lvl) AS acc, arg_max(proof, lvl) AS proof FROM walk GROUP BY ALL)
SELECT p.doc_id, p.leaf, s.h AS subroot, r.h AS root, sha256(f.proof) AS proof_sha256,
       f.acc AS folded_root, f.acc = r.h AS verified
FROM placed p JOIN folded f ON f.grp = p.grp AND f.leaf_idx = p.idx
JOIN subroots s ON s.grp = p.grp, (SELECT h FROM above WHERE n = 1) r
"""


def _containment_sql() -> str:
    """Exact containment from all shingles of both tables."""
    def words(table: str, id_col: str) -> str:
        return f"""SELECT row_number() OVER () AS r, {id_col},
                     regexp_extract_all(lower(coalesce(text, '')), '[0-9a-z\\x{{80}}-\\x{{10ffff}}]+') AS w
                   FROM {table}"""

    def shingled(table: str) -> str:
        return f"""SELECT DISTINCT r, array_to_string(w[p:p + 4], ' ') AS s
                   FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS p FROM {table})"""

    return f"""
        WITH docs AS ({words("documents", "doc_id")}), items AS ({words("benchmark", "item_id")}),
        doc_shingles AS ({shingled("docs")}), item_shingles AS ({shingled("items")}),
        sizes AS (SELECT r, count(*) AS n FROM item_shingles GROUP BY r),
        common AS (SELECT d.r, i.r AS i, count(*) AS both
                   FROM doc_shingles d JOIN item_shingles i USING (s) GROUP BY d.r, i.r),
        hits AS (SELECT c.r, items.item_id, c.both / n AS share
                 FROM common c JOIN sizes ON sizes.r = c.i JOIN items ON items.r = c.i WHERE c.both / n >= 0.8),
        found AS (SELECT r, count(*) AS n_items, max(share) AS containment,
                    string_agg(item_id, ',' ORDER BY item_id) AS item_ids FROM hits GROUP BY r)
        SELECT doc_id, n_items IS NOT NULL AS contaminated, coalesce(n_items, 0) AS n_items,
               coalesce(item_ids, '') AS item_ids, coalesce(containment, 0.0) AS containment
        FROM docs LEFT JOIN found USING (r)"""


ORACLE_SQL: dict[str, str] = {
    "op3_decontaminate": _containment_sql(),
    "op5_exact_dedup": """
        WITH normed AS (
          SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                   'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents)
        SELECT doc_id, max(doc_id) OVER (PARTITION BY norm) AS keep_id,
               count(*) OVER (PARTITION BY norm) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY norm) AS kept,
               sha256(norm) AS text_sha256
        FROM normed""",
    "op11_merkle": _merkle_sql(),
}
