"""The registered queries of this package, and their DuckDB SQL where SQL can
express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import alignment, ann, bpe, langid, omh, packing, periodic, prefix_bpe, rp_forest, substring, toxicity, training_order, url_filter
from tidemark.llm.common import read_table
from tidemark.session import scratch_path


def op1_ads_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return ann.search(rows, rows.where("vec_id % 20 = 0"), 20)


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def language_model(docs: DataFrame) -> langid.Model:
    """Learned from documents whose crc32 modulo 3 is not 1."""
    return langid.fit(docs.where(toxicity.fold("doc_id", 3) != 1).select("text", "lang"))


def op3_language_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = F.coalesce(toxicity.fold("doc_id", 3) == 1, F.lit(False))
    done = langid.predict(docs.select("doc_id", "text"), language_model(docs))
    return done.select("doc_id", held.alias("held_out"), "lang_pred", "score")


URL_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]


def op4_url_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op5_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return omh.near_duplicates(read_table(spark, sf_dir, "documents"))


def op6_substring_doubling(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = substring.remove_repeats(read_table(spark, sf_dir, "documents").select("doc_id", "text"), 35)
    return done.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def packed(docs: DataFrame) -> DataFrame:
    return packing.pack(docs.select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


def op7_kk_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(read_table(spark, sf_dir, "documents"))


def op8_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    out = scratch_path(spark, "training-order")
    manifest = training_order.write(docs, out, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
    return training_order.slots(spark, out, manifest)


def op9_rp_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rp_forest.links(read_table(spark, sf_dir, "embeddings"), 0.98)


def toxicity_model(spark: SparkSession, sf_dir: str, docs: DataFrame) -> toxicity.Model:
    """Learned from labelled documents whose crc32 modulo 5 is not 0."""
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "toxic")
    labels = toxicity.bounded(labels.where(toxicity.fold("doc_id", 5) != 0).where("toxic IS NOT NULL"))
    return toxicity.fit(toxicity.labelled(docs.select("doc_id", "text"), labels))


def op10_toxicity_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity_model(spark, sf_dir, docs))
    held = F.coalesce(toxicity.fold("doc_id", 5) == 0, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op11_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_bpe.digests(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return alignment.align(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN, public_tokenizers.path("piece_bpe_32k.model"))


def repeated_tails(docs: DataFrame) -> DataFrame:
    """(doc_id, text): with h the crc32 of the decimal doc_id and g = h div 10,
    the n words of a text whose h ends in 0 repeat from word a = g mod n on the
    1 + (n - a) div (3 + g mod 8) words that stand there."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = docs.select("doc_id", "text", h.alias("h"), F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)).alias("w"))
    parts = words.selectExpr("doc_id", "text", "h", "w", "size(w) AS n", "CAST(pmod(h div 10, greatest(size(w), 1)) AS INT) AS a", "CAST(3 + (h div 10) % 8 AS INT) AS k")
    tail = "slice(w, a + 1, 1 + (n - a) div k)"
    text = f"array_join(concat(slice(w, 1, a), slice(flatten(array_repeat({tail}, k)), 1, n - a)), ' ')"
    return parts.selectExpr("doc_id", f"CASE WHEN h % 10 = 0 AND n > 0 THEN {text} ELSE text END AS text")


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = periodic.find_runs(repeated_tails(read_table(spark, sf_dir, "documents").select("doc_id", "text")))
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    return done.select("doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
                       F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
                       F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


QUERIES = {f.__name__: f for f in (op1_ads_search, op2_byte_bpe, op3_language_crf, op4_url_automaton, op5_order_minhash, op6_substring_doubling, op7_kk_packing, op8_training_order,
                              op9_rp_forest, op10_toxicity_fm, op11_prefix_bpe, op12_tokenizer_alignment, op13_periodic_runs)}

ORACLE_SQL = {
    "op4_url_automaton": """
WITH u AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), p AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u
), r AS (
  SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule FROM p
)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM r
""",
}
