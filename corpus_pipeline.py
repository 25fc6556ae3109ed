"""A corpus from documents to packed sequences, stage by stage.

Each stage takes ``(spark, docs, sf_dir)`` and returns the rows that the next one reads
back from Parquet. All but the last return the columns of ``documents``. Rows whose
``doc_id`` is null pass the near-duplicate stage as they are; every other defined result is
that of the operators.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stallworks.llm import line_chunks, mixing, near_dups, packing, toxicity
from stallworks.llm.common import fold, labelled_sample
from stallworks.session import scratch_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
TOXIC = 0.7
REPETITION = 1.5
#: 24 bands of 4 find a pair of similarity 0.8 but for one in 300,000.
BANDS, ROWS = 24, 4


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxic passages are not significant enough to reject them."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    sample = labelled_sample(labels, "toxic", fold(F.col("doc_id"), 3) != 1)
    model = toxicity.fit(docs, sample)
    return toxicity.score(docs.select(*COLUMNS), model).where(F.col("toxicity") < TOXIC).select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without chunks of lines that stand before; those with nothing left go."""
    rows = line_chunks.remove_repeated_lines(docs.select(*COLUMNS))
    left = (F.col("n_removed_lines") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]")
    rows = rows.where(F.coalesce(left, F.lit(True)))
    return rows.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near-duplicates: five-word shingles, 0.8 or more.

    Rows that repeat the ``doc_id`` and text of a kept document go as well: of them the one
    with the least language, source and length stays. Rows without a ``doc_id`` all stay.
    """
    found = near_dups.near_duplicates(docs, shingle=5, percent=80, bands=BANDS, rows=ROWS)
    kept = found.where("kept").select("doc_id", "key")
    rows = docs.select(*COLUMNS)
    key = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    named = rows.withColumn("key", key).join(kept, ["doc_id", "key"])
    rest = [c for c in COLUMNS if c != "doc_id"]
    order = F.struct(F.col("text").isNull(), "lang", "source", "n_chars")
    one = named.groupBy("doc_id", "key").agg(F.min_by(F.struct(*rest), order).alias("row"))
    return one.select("doc_id", "row.*").unionByName(rows.where("doc_id IS NULL"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once at least, and those of small sources more often."""
    return mixing.repeated(mixing.mix_sources(docs.select(*COLUMNS), repetition=REPETITION))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their token ids and places in sequences."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack_documents(docs, path, block_rows=8192)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("source_mixing", mix_sources),
    ("packing", pack_sequences),
]

#: The toxicity model and the packing cannot be put in SQL; tests hold the stages against
#: brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    folder = scratch_path(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
