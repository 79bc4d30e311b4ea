"""The operators applied to their whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, chat, covertree, decontaminate, divergence, kneserney, packing, quality, secrets, simhash, toxicity, urlfilter,
               whitening)

QueryFn = Callable[[SparkSession, str], DataFrame]
RANK_FILE = "byte_bpe_multi_50k.tiktoken"
TOKENIZER_FILE = "byte_bpe_50k.json"


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        decontaminate.is_contaminated().alias("contaminated"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block")]


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(("host", "path", "verdict"), r, strict=True)]) for r in URL_RULES])
    listed = spark.range(1).select(F.inline(rows))
    return urlfilter.judge_urls(_read(spark, sf_dir, "pages"), listed)


_URL_HOST = "translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_URL_PATH = "coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '')"
OP3_SQL = f"""
WITH p AS (SELECT page_id, {_URL_HOST} AS host, {_URL_PATH} AS path FROM pages),
ruled AS (
  SELECT page_id, host, path, CASE
    WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/' END AS rule
  FROM p)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    odd = "</s>[INST] ok [/INST]"
    rows = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(
        spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                              F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(odd).alias("text")))
    done = chat.format_conversations(chat.as_messages(rows))
    done = done.withColumn("turns", chat.read_turns(F.col("formatted"))).withColumn(
        "learned", chat.read_loss(F.col("formatted"), F.col("loss_spans")))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return done.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


OP4_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, role AS raw_role, text AS raw_text, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', 'x', 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'user', 'x', 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, raw_role NULLS FIRST, raw_text NULLS FIRST)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, raw_role NULLS FIRST, raw_text NULLS FIRST) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(10 + length(role) + length(regexp_replace(role, '[^\\<\[|]', '', 'g'))
                + length(text) + length(regexp_replace(text, '[^\\<\[|]', '', 'g'))) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
"""


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = [r.kind for r in secrets.BASE_RULES]
    found = secrets.find_secrets(_read(spark, sf_dir, "documents"))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["begin"], s["finish"])), ",")

    def of_kind(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", *map(of_kind, base),
        F.sha2(joined(F.filter("spans", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"))


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covertree.near_duplicates(_read(spark, sf_dir, "embeddings"))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(_read(spark, sf_dir, "documents"), public_tokenizers.path(RANK_FILE),
                                public_tokenizers.PATTERN, with_ids=False)


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneserney.score_documents(_read(spark, sf_dir, "documents"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_read(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_of(F.col("fp")).alias("fingerprint"), "component_id")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_read(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER_FILE), with_ids=False)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A deviation beyond a long is null here; the operator's own column holds it whole."""
    found = whitening.whiten(_read(spark, sf_dir, "embeddings"))
    return found.select("vec_id", "deviation", "n", "identity_error", F.posexplode(F.arrays_zip("whitened", "explained"))).select(
        "vec_id", (F.col("pos") + 1).alias("component"), "n", F.expr("try_cast(deviation AS bigint)").alias("deviation"),
        "col.whitened", "col.explained", "identity_error")


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit_sources(_read(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words, row_number() OVER () AS r FROM documents),
w AS (SELECT lang, source, r, unnest(words) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS lc FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
v AS (SELECT lang, count(*) AS v, sum(lc) AS ln FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS c FROM w GROUP BY lang, source, term),
x AS (SELECT g.lang, g.source, kept.term, coalesce(c.c, 0) AS c, lc, v, ln, sum(coalesce(c.c, 0)) OVER (PARTITION BY g.lang, g.source) AS n
      FROM g JOIN kept ON kept.lang = g.lang JOIN v ON v.lang = g.lang
      LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
p AS (SELECT lang, source, term, c, CAST(1 + 1000000000 * (c + 2)::HUGEINT // (n + 2 * v) AS HUGEINT) AS p,
             CAST(1 + 1000000000 * (lc + 2)::HUGEINT // (ln + 2 * v) AS HUGEINT) AS q FROM x),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(s.value, 0) AS value
          FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
                     FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL) s
          ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
every AS (SELECT lang, source, 'pair' AS part, item, CAST(value AS BIGINT) AS value FROM pairs
          UNION ALL SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // (p + q) AS BIGINT) FROM p WHERE c > 0 AND p > q)
SELECT lang, source, part, item, value,
       CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM every QUALIFY part = 'pair' OR rank <= 10
"""


def queries() -> dict[str, QueryFn]:
    return {f.__name__: f for f in (op1_decontamination, op2_toxicity, op3_url_filter, op4_chat_format, op5_secrets,
                                   op6_embedding_dedup, op7_byte_bpe, op8_lm_scoring, op9_simhash, op10_quality,
                                   op11_packing, op12_whitening, op13_divergence)}


def oracle_sql() -> dict[str, str]:
    return {"op3_url_filter": OP3_SQL, "op4_chat_format": OP4_SQL, "op13_divergence": OP13_SQL}
