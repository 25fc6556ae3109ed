"""The registered queries of this subpackage: each applies one operator to whole tables."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stallworks.llm import (
    alignment,
    decontamination,
    line_chunks,
    mixing,
    near_dups,
    packing,
    periodic_runs,
    quality_rules,
    repeats,
    secrets,
    target_ratio,
    toxicity,
    winnowing,
)
from stallworks.llm.common import fold, labelled_sample

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place among sequences of 4096 tokens."""
    return packing.pack_documents(documents(spark, sf_dir), TOKENIZER, digest=True)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's lines without the chunks that stand elsewhere before."""
    rows = line_chunks.remove_repeated_lines(documents(spark, sf_dir).select("doc_id", "text"))
    text = F.coalesce("text", F.lit(""))
    return rows.select("doc_id", "n_lines", "n_removed_chunks", "n_removed_lines", F.sha2(text, 256).alias("kept_sha256"))


def op3_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text's fingerprint, and its likeness to an edited text and to the next one's."""
    rows = winnowing.compared(documents(spark, sf_dir))
    return rows.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        winnowing.spelled(F.col("hashes")).alias("fingerprint"),
        winnowing.spelled(F.col("edited_hashes")).alias("edited_fingerprint"),
        winnowing.likeness(F.col("hashes"), F.col("edited_hashes")).alias("near_edited"),
        winnowing.likeness(F.col("hashes"), F.col("next_hashes")).alias("near_next"),
    )


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality by the rules that labelled rows support."""
    docs = documents(spark, sf_dir)
    sample = labelled_sample(labels(spark, sf_dir), "quality", fold(F.col("doc_id"), 5) != 0)
    scored = quality_rules.score(docs.select("doc_id", "text"), quality_rules.fit(docs, sample))
    return scored.select(
        "doc_id",
        (fold(F.col("doc_id"), 5) == 0).alias("held_out"),
        F.col("quality").alias("score"),
        (F.col("quality") >= 0.3).cast("int").alias("predicted"),
    )


def op5_minhash_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's near-duplicate component over sets of three-word shingles: a row for each row."""
    docs = documents(spark, sf_dir)
    found = near_dups.near_duplicates(docs, shingle=3, percent=85)
    rows = found.withColumn("row", F.explode(F.sequence(F.lit(1), F.col("n_rows"))))
    rows = rows.select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))
    return rows.unionByName(near_dups.unnamed(docs, shingle=3))


def toxic_model(docs: DataFrame, all_labels: DataFrame) -> toxicity.ToxicModel:
    """A model from the labelled rows that may be learned from."""
    return toxicity.fit(docs, labelled_sample(all_labels, "toxic", fold(F.col("doc_id"), 3) != 1))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity, with the number of its significant passages."""
    docs = documents(spark, sf_dir)
    scored = toxicity.score(docs.select("doc_id", "text"), toxic_model(docs, labels(spark, sf_dir)))
    return scored.select(
        "doc_id",
        (fold(F.col("doc_id"), 3) == 1).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.7).cast("int").alias("predicted"),
        F.size("toxic_passages").alias("n_passages"),
    )


def op7_target_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts of every document, and whether it resembles the trusted target."""
    docs = documents(spark, sf_dir)
    trusted = labels(spark, sf_dir).where("quality = 1")
    table = target_ratio.ratios(target_ratio.gram_counts(docs, trusted))
    scored = target_ratio.score(target_ratio.base_statistics(docs), table)
    return scored.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & (F.col("target_ratio") >= target_ratio.THRESHOLD)).alias("kept"),
        "target_ratio",
    )


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's base spans, digested, and all spans."""
    found = secrets.scan(documents(spark, sf_dir))

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(secrets.spelled(F.col("base")), 256).alias("base_sha256"),
        secrets.spelled(F.col("spans")).alias("spans"),
    )


def op10_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 50-byte strings that an earlier document has."""
    found = repeats.remove_repeats(documents(spark, sf_dir))
    return found.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's copies and place when no source is repeated more than four times."""
    docs = documents(spark, sf_dir).select("doc_id", "source", "text")
    return mixing.mix_sources(docs, repetition=4.0).drop("text")


def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens by two tokenizers, aligned and weighed by corpus counts."""
    path_a, path_b = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    found = alignment.align_tokenizers(documents(spark, sf_dir), path_a, path_b, digest=True)
    return found.withColumnRenamed("groups", "groups_sha256")


def op12_training_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's words that stand in windows of benchmark items."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontamination.contamination(documents(spark, sf_dir), benchmark)
    items = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(items, 256).alias("items_sha256"), "contaminated"
    )


def periodic_tail(doc_id: int | None, n: int) -> np.ndarray | None:
    """The order of words of a text whose tail is made periodic: one in ten ids."""
    code = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if code % 10 or not n:
        return None
    at = code // 10 % n
    period = 1 + (n - at) // (3 + code // 10 % 8)
    order = np.arange(n)
    order[at:] = at + (order[at:] - at) % period
    return order


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's periodic runs of words, and its text with one period of each."""
    found = periodic_runs.find_runs(documents(spark, sf_dir), reorder=periodic_tail)
    best = periodic_runs.longest(F.col("runs"))
    return found.select("doc_id", "runs", "collapsed", best.alias("best")).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(periodic_runs.spelled(F.col("runs")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_line_dedup": op2_line_dedup,
    "op3_winnowing": op3_winnowing,
    "op4_quality_rules": op4_quality_rules,
    "op5_minhash_near_dups": op5_minhash_near_dups,
    "op6_toxicity": op6_toxicity,
    "op7_target_ratio": op7_target_ratio,
    "op8_source_mixing": op8_source_mixing,
    "op9_secret_scan": op9_secret_scan,
    "op10_suffix_repeats": op10_suffix_repeats,
    "op11_tokenizer_alignment": op11_tokenizer_alignment,
    "op12_training_suffixes": op12_training_suffixes,
    "op13_periodic_runs": op13_periodic_runs,
}

SQL: dict[str, str] = {"op2_line_dedup": line_chunks.SQL, "op12_training_suffixes": decontamination.SQL}
