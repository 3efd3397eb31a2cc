"""The registered queries of this package: each applies one operator to the whole of its table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import collocations, decontaminate, html_text, jaccard, language, line_dedup, pieces, quality, secrets, simhash, spelling, token_files, url_filter
from .common import staged, table


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.leaks(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))
    model = language.train(docs.filter("doc_id IS NOT NULL").filter(~held_out))
    found = language.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected", "cross_entropy")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return line_dedup.drop_boilerplate(docs, removed="n_removed").select("doc_id", "n_removed", "text")


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    measured = staged(quality.measure(docs, "m").drop("text"), "measured")
    judged = quality.judge(measured, "m", "kept")
    return judged.select("doc_id", *(f"m.{c}" for c in quality.MEASURES), F.col("m.base_failed"), "kept")


def op6_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return secrets.scan(docs, secrets.train(docs)).drop("text")


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), digest=True)


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    weights = url_filter.train(url_filter.labelled_urls())
    return url_filter.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), weights)


def op10_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    folder = token_files.token_folder(spark)
    index = token_files.write_tokens(docs, folder)
    return token_files.read_tokens(index, folder)


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents").select("lang", "text"))


def op13_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_copies(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {
    "op1_benchmark_decontamination": op1_benchmark_decontamination,
    "op2_language_id": op2_language_id,
    "op3_line_dedup": op3_line_dedup,
    "op4_html_extraction": op4_html_extraction,
    "op5_quality_rules": op5_quality_rules,
    "op6_secret_scans": op6_secret_scans,
    "op7_ngram_jaccard_join": op7_ngram_jaccard_join,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_url_filters": op9_url_filters,
    "op10_token_ids": op10_token_ids,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_collocations": op12_collocations,
    "op13_simhash_near_dedup": op13_simhash_near_dedup,
}
