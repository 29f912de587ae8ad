"""The registered queries of this package, one per operator, each over its whole table, and the
DuckDB SQL of those that SQL can express. The operators keep their own interfaces in their own
modules; a query derives the digest columns from what its operator returns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oeeflow.llm import sql
from oeeflow.llm.common import table, word_count


def op1_mix_to_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    from oeeflow.llm.mixing import mix_to_weights
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", word_count(F.col("text")).alias("size"))
    return mix_to_weights(docs).select("doc_id", "size", "source_size", "target", "taken")


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from oeeflow.llm.packing import best_fit_pack, pieces
    docs = table(spark, sf_dir, "documents")
    return best_fit_pack(pieces(docs, public_tokenizers.path("word_bpe_49k.json")))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from oeeflow.llm.quality import quality_rules
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                                      "n_repeat_words", "base_failed", "kept")


def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    from oeeflow.llm.pii import find_personal_data
    found = find_personal_data(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone",
                        F.sha2(F.col("base_spans").cast("binary"), 256).alias("base_sha256"), "spans")


def op5_imatch_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from oeeflow.llm.fingerprints import compare_with_edited
    return compare_with_edited(table(spark, sf_dir, "documents"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from oeeflow.llm.warc import archived_pages, page_number
    read = archived_pages(table(spark, sf_dir, "pages"))
    return read.select(page_number(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                       page_number(F.col("refers_to")).alias("refers_to"))


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from oeeflow.llm.simjoin import near_duplicates
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=4, threshold=0.85)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from oeeflow.llm.toxicity import fit_toxicity, held_out, score_toxicity
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return score_toxicity(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    from oeeflow.llm.licenses import scan_licenses
    return scan_licenses(table(spark, sf_dir, "documents"))


def op10_trie_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    from oeeflow.llm.lm import fit_trie, held_out, score_texts
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_trie(docs.filter(~held_out(F.col("doc_id"))), min_pair=1, order=3)
    return score_texts(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known",
        F.lit(model.n).cast("long").alias("train_tokens"), "base_score", "score")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from oeeflow.llm.negatives import hard_negatives
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings"), label=moved)


def op12_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from oeeflow.llm.ann import nearest
    return nearest(table(spark, sf_dir, "embeddings"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from oeeflow.llm.prefixes import prefix_trie
    return prefix_trie(table(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (
    op1_mix_to_weights, op2_personal_data, op3_best_fit_packing, op4_quality_rules, op5_imatch_fingerprints, op6_warc,
    op7_ngram_jaccard, op8_toxicity, op9_licenses, op10_trie_scores, op11_hard_negatives, op12_nearest, op13_prefix_trie)}
SQL: dict[str, str] = {"op1_mix_to_weights": sql.mixing(), "op4_quality_rules": sql.quality(), "op7_ngram_jaccard": sql.near_duplicates(),
                       "op9_licenses": sql.licenses(), "op11_hard_negatives": sql.hard_negatives(),
                       "op13_prefix_trie": sql.prefix_trie()}
