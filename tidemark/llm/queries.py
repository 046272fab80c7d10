"""Registered queries of the operators: whole tables in, result digests out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import collocations, decontaminate, jaccard_join, kn_quality, langid, license_scan, packing, periodic_runs, secret_scan, substring_dedup, suffix_tree, topk, url_filter
from tidemark.session import ship_package


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship_package(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kn_quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = substring_dedup.removed(table(spark, sf_dir, "documents"), digest=True)
    return done.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.scan(table(spark, sf_dir, "documents")))


def op4_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", langid.held_out("doc_id", 4))
    model = langid.learn(docs.where(~F.col("held_out")))
    found = langid.identify(docs.withColumn("key", F.struct("doc_id", "held_out")), model, key="key")
    return found.select("key.doc_id", "key.held_out", "lang_pred", "score")


def op6_suffix_tree_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = langid.held_out("doc_id", 7)
    model = suffix_tree.learn(docs.where(~held_out))
    return suffix_tree.score(docs, model, held_out=held_out).drop("vocabulary")


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(table(spark, sf_dir, "documents")).drop("cid")


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.digest(license_scan.scan(table(spark, sf_dir, "documents")))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontaminate.digest(found)


def op10_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pieces(table(spark, sf_dir, "documents"), with_ids=False)


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"))


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.digest(periodic_runs.detect(periodic_runs.planted(table(spark, sf_dir, "documents"))))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_secret_scan": op3_secret_scan,
    "op4_topk_search": op4_topk_search,
    "op5_language_id": op5_language_id,
    "op6_suffix_tree_score": op6_suffix_tree_score,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_license_scan": op8_license_scan,
    "op9_decontaminate": op9_decontaminate,
    "op10_pack": op10_pack,
    "op11_collocations": op11_collocations,
    "op12_url_filter": op12_url_filter,
    "op13_periodic_runs": op13_periodic_runs,
}
