"""The pN_ queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..runtime import spread, table
from . import p01_split_overlap, p02_language, p03_leximin, p04_grouped_split, p05_contributor_cap, p06_canonical, p07_stable_sample, p08_tokenize, p09_packing, p10_spam


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return p01_split_overlap.overlaps(spread(table(spark, d, "labeled_manifest")))


def p1_report(spark: SparkSession, d: str) -> DataFrame:
    return p01_split_overlap.report(spread(table(spark, d, "labeled_manifest")))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return p02_language.wrong_labels(
        spread(table(spark, d, "documents")), spread(table(spark, d, "labeled_manifest")), table(spark, d, "language_seed"))


def p2_labels(spark: SparkSession, d: str) -> DataFrame:
    return p02_language.all_labels(
        spread(table(spark, d, "documents")), spread(table(spark, d, "labeled_manifest")), table(spark, d, "language_seed"))


def p2_segments(spark: SparkSession, d: str) -> DataFrame:
    return p02_language.mixed_segments(spread(table(spark, d, "documents")), table(spark, d, "language_seed"))


def p3_ranking(spark: SparkSession, d: str) -> DataFrame:
    return p03_leximin.rank_clips(table(spark, d, "quality_features"), table(spark, d, "overlap_features"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return p04_grouped_split.straddling(table(spark, d, "labeled_manifest"))


def p4_split(spark: SparkSession, d: str) -> DataFrame:
    return p04_grouped_split.assign(table(spark, d, "labeled_manifest")).select("line_number", "split")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return p05_contributor_cap.over_cap(table(spark, d, "ssl_candidates"))


def p5_kept(spark: SparkSession, d: str) -> DataFrame:
    return p05_contributor_cap.kept(table(spark, d, "ssl_candidates"))


def p5_share(spark: SparkSession, d: str) -> DataFrame:
    return p05_contributor_cap.over_share(table(spark, d, "ssl_candidates"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return p06_canonical.same_looking_pairs(spread(table(spark, d, "documents")))


def p6_texts(spark: SparkSession, d: str) -> DataFrame:
    documents = p06_canonical.canonicalize(spread(table(spark, d, "documents")), "doc_id").select(
        F.lit("documents").alias("record_table"), F.col("doc_id").alias("record_id"), "text")
    manifest = p06_canonical.canonicalize(spread(table(spark, d, "labeled_manifest")), "line_number").select(
        F.lit("labeled_manifest").alias("record_table"), F.col("line_number").alias("record_id"), "text")
    return documents.unionByName(manifest)


def p7_sample(spark: SparkSession, d: str) -> DataFrame:
    ssl = p07_stable_sample.sample(table(spark, d, "ssl_candidates")).select(
        F.lit("ssl_candidates").alias("record_table"), "audio_id", "clip", "delivered_at")
    labeled = p07_stable_sample.sample(table(spark, d, "labeled_manifest")).select(
        F.lit("labeled_manifest").alias("record_table"), "audio_id", "clip", "delivered_at")
    return ssl.unionByName(labeled)


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return p08_tokenize.encode(spread(table(spark, d, "documents")), "doc_id")


def p8_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """The texts again, from their ids."""
    return p08_tokenize.decode(p8_ids(spark, d), "doc_id")


def p9_containers(spark: SparkSession, d: str) -> DataFrame:
    return p09_packing.pack_documents(spread(table(spark, d, "documents")))


def p9_fill(spark: SparkSession, d: str) -> DataFrame:
    return p09_packing.fill(p9_containers(spark, d))


def p9_check(spark: SparkSession, d: str) -> DataFrame:
    return p09_packing.check(p9_containers(spark, d), table(spark, d, "documents"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return p10_spam.spam(spread(table(spark, d, "documents")), table(spark, d, "language_seed"))


def p10_shares(spark: SparkSession, d: str) -> DataFrame:
    return p10_spam.spam_shares(spread(table(spark, d, "documents")), table(spark, d, "language_seed"))


QUERIES = (
    p1_found, p1_report, p2_found, p2_labels, p2_segments, p3_ranking, p4_found, p4_split, p5_found, p5_kept, p5_share, p6_found, p6_texts, p7_sample, p8_ids, p8_round_trip, p9_containers, p9_fill, p9_check,
    p10_found, p10_shares,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    from .sql import SQL

    return dict(SQL)
