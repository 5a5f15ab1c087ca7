"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aisleframe.llm import sql
from aisleframe.llm.collocations import collocations
from aisleframe.llm.decontamination import leaks
from aisleframe.llm.encoding import encode
from aisleframe.llm.extraction import extract_pages
from aisleframe.llm.language_id import predict_languages
from aisleframe.llm.lexical_search import ranked_documents
from aisleframe.llm.license_scan import license_findings
from aisleframe.llm.lm_score import score_texts
from aisleframe.llm.ngram_join import near_duplicate_groups
from aisleframe.llm.quality import quality_verdicts
from aisleframe.llm.substring_dedup import remove_repeats
from aisleframe.llm.toxicity import toxicity_scores
from aisleframe.llm.url_filter import judge_urls


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(_table(spark, sf_dir, "pages"))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(_table(spark, sf_dir, "pages"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_verdicts(_table(spark, sf_dir, "documents"))


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_groups(_table(spark, sf_dir, "documents"), n=4, percent=85)


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(_table(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), short_items=True)


def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(_table(spark, sf_dir, "documents"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_findings(_table(spark, sf_dir, "documents"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(_table(spark, sf_dir, "documents"), with_text=False)


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(_table(spark, sf_dir, "documents"))


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    return predict_languages(_table(spark, sf_dir, "documents"), held_out)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_url_filter": op2_url_filter,
    "op3_html_extraction": op3_html_extraction,
    "op4_quality_rules": op4_quality_rules,
    "op5_ngram_jaccard": op5_ngram_jaccard,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_decontamination": op7_decontamination,
    "op8_lm_score": op8_lm_score,
    "op9_license_scan": op9_license_scan,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_lexical_search": op11_lexical_search,
    "op12_phrase_mining": op12_phrase_mining,
    "op13_language_id": op13_language_id,
}
SQL: dict[str, str] = {
    "op2_url_filter": sql.URL_FILTER,
    "op5_ngram_jaccard": sql.NGRAM_JACCARD,
    "op7_decontamination": sql.DECONTAMINATION,
    "op10_substring_dedup": sql.SUBSTRING_DEDUP,
    "op11_lexical_search": sql.LEXICAL_SEARCH,
    "op12_phrase_mining": sql.COLLOCATIONS,
}
