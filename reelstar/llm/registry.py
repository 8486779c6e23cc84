"""The queries of this subpackage, with production parameters on whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import line_rules, merkle_log, ranked_search
from .bottom_k import fingerprint_edits
from .common import table
from .crf_language import identify
from .fuzzy_lines import dedup_lines
from .lexicon_bpe import encode_decode
from .ngram_join import jaccard_groups
from .nbsvm import quality_scores
from .packing import pack
from .parameters import BYTE_BPE, PII_KEY, WORD_BPE
from .rp_forest import nearest
from .surrogates import replace_pii
from .token_files import token_table


def op1_rp_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op2_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replace_pii(table(spark, sf_dir, "documents").select("doc_id", "text"), PII_KEY)


def op3_nbsvm_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_bottom_k_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_edits(table(spark, sf_dir, "documents"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_table(spark, table(spark, sf_dir, "documents"), BYTE_BPE, end_id=2)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), BYTE_BPE, end_id=0).drop("token_ids")


def op7_crf_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents")).drop("runs")


def op8_lexicon_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode(table(spark, sf_dir, "documents"), WORD_BPE)


def op9_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "text", "lines_removed")


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_groups(table(spark, sf_dir, "documents"), width=4, percent=85)


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_merkle_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_log.prove_tampered(spark, table(spark, sf_dir, "documents"))


def op13_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_rules.clean_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.drop("text", "clean_text")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_rp_forest, op2_pii_surrogates, op3_nbsvm_quality, op4_bottom_k_fingerprints, op5_token_files, op6_packing, op7_crf_language, op8_lexicon_bpe, op9_fuzzy_lines, op10_ngram_join, op11_ranked_search, op12_merkle_log, op13_line_rules)
}
ORACLE: dict[str, str] = {"op11_ranked_search": ranked_search.SQL, "op12_merkle_log": merkle_log.SQL, "op13_line_rules": line_rules.SQL}
