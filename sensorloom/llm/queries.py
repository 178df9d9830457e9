"""The registered queries of this folder's operators and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.llm import cube_mix, decontaminate, hilbert_shards, html_text, line_dedup, passages, perplexity_rules, quality_fm, ranked_search, spelling_variants, token_counts, warc_audit
from sensorloom.llm.common import table
from sensorloom.llm.near_dedup import near_duplicates
from sensorloom.llm.oracles import ORACLES  # noqa: F401


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.near_duplicate_lines(table(spark, sf_dir, "documents"))


def op2_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_fm.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    counter = token_counts.load(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
    return token_counts.token_counts(table(spark, sf_dir, "documents"), counter)


def op4_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert_shards.placed(table(spark, sf_dir, "documents"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_cube_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cube_mix.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=3, percent=85)


def op8_perplexity_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perplexity_rules.rules(table(spark, sf_dir, "documents"))


def op9_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(table(spark, sf_dir, "documents"))


def op10_warc_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages' records against a replica that was damaged as the first digits of md5(url) say.

    00: a byte of the text is another one; 01: the record is lost; 02: it is cut short.
    """
    found = warc_audit.records(table(spark, sf_dir, "pages"))
    digits = table(spark, sf_dir, "pages").select(
        F.col("page_id").cast("long"), F.substring(F.md5(F.coalesce("url", F.lit(""))), 1, 2).alias("digits"),
        warc_audit.record(F.col("url"), F.col("html"), F.col("page_id")).alias("record"),
    )
    whole = warc_audit.manifest(found)
    size, bytes_ = F.length("record"), F.col("record")
    flipped = F.concat(F.substring(bytes_, 1, size - 5), F.lit("~").cast("binary"), F.substring(bytes_, size - 3, F.lit(4)))
    damaged = F.when(F.col("digits") == "00", flipped).when(F.col("digits") == "02", F.substring(bytes_, F.lit(1), size - 100))
    kept = digits.where("digits <> '01'").select(
        "page_id", F.length(F.coalesce(damaged, bytes_)).cast("long").alias("length"),
        F.unhex(F.sha2(F.coalesce(damaged, bytes_), 256)).alias("digest"),
    )
    places = whole.select("page_id", "segment", "offset")
    return warc_audit.audit(whole, kept.join(places, "page_id").select(whole.columns))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(table(spark, sf_dir, "pages"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.variants(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_quality_fm": op2_quality_fm,
    "op3_token_counts": op3_token_counts,
    "op4_hilbert_shards": op4_hilbert_shards,
    "op5_decontaminate": op5_decontaminate,
    "op6_cube_mix": op6_cube_mix,
    "op7_near_dedup": op7_near_dedup,
    "op8_perplexity_rules": op8_perplexity_rules,
    "op9_passages": op9_passages,
    "op10_warc_audit": op10_warc_audit,
    "op11_ranked_search": op11_ranked_search,
    "op12_html_text": op12_html_text,
    "op13_spelling_variants": op13_spelling_variants,
}
