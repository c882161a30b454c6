"""The operators' queries over the test tables, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import (
    embedding_dedup, html_extract, jaccard_join, license_scan, mixing, packing, periodic_runs, pii, prefix_trie, quality,
    substring_dedup, toxicity, url_filter,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_text(table(spark, sf_dir, "pages"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages")).drop("matched")


def op3_embedding_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.embedding_duplicates(table(spark, sf_dir, "embeddings"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_join(table(spark, sf_dir, "documents"))


def op6_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeat_digest(table(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted, rejected = (table(spark, sf_dir, "labels").where(f"quality = {q}").select("doc_id") for q in (1, 0))
    return quality.quality_rules(table(spark, sf_dir, "documents"), trusted, rejected=rejected)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(table(spark, sf_dir, "documents"))


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in the mixture."""
    mixed = mixing.mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "mix_source", "mix_phase", "mix_block", "mix_slot", "mix_place")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(table(spark, sf_dir, "documents"), order=periodic_runs.repeated_tail)
    return periodic_runs.run_digest(found)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = prefix_trie.sequences(table(spark, sf_dir, "conversations"))
    return prefix_trie.trie_nodes(prefix_trie.rebuilt(said))


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.label_digest(license_scan.license_scan(table(spark, sf_dir, "documents")))


QUERIES = {
    f.__name__: f
    for f in (
        op1_html_text, op2_url_filter, op3_embedding_duplicates, op4_toxicity, op5_jaccard_join, op6_repeated_passages,
        op7_quality_rules, op8_packing, op9_personal_data, op10_mix_sources, op11_periodic_runs, op12_prefix_trie,
        op13_license_scan,
    )
}
ORACLE = {"op2_url_filter": url_filter.url_filter_sql(), "op12_prefix_trie": prefix_trie.prefix_trie_sql()}
