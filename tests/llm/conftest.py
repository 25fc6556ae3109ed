"""Documents with everything that may go wrong in them."""

import random

import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use for columns of their own.
CLASHES = (
    "key anchor bytes start end length piece ids sequence_id offset toxicity quality words score label rep bucket "
    "component signature hashes digest range tokens block place weight mix_weight mix_copies mix_block mix_place n_lines found kept next spans"
).split()


def prose(seed: int, words: int, vocabulary: int = 400) -> str:
    rnd = random.Random(seed)
    return " ".join(f"w{rnd.randrange(vocabulary)}x" for _ in range(words))


def odd_rows():
    long_text = prose(1, 30_000)
    rows = [
        (1, prose(2, 80), "en", "a", 1),
        (2, None, "en", "a", None),
        (3, "", None, "a", 0),
        (4, long_text, "en", "a", 1),
        (5, long_text + " tail", "en", None, 1),
        (6, prose(2, 80), "de", "b", 1),
        (7, " \t\n\x0b ", "de", "b", 1),
        (8, "word", "de", "b", 1),
        (9, "x" * 50_000, "de", "b", 1),
        (10, "ünïcödé 東京 😀 text\n" * 5, None, None, None),
        (12, prose(2, 79) + " other", "en", "a", 1),
    ]
    return rows + [rows[0]]


@pytest.fixture(scope="session")
def odd(spark):
    df = spark.createDataFrame(odd_rows(), SCHEMA)
    return df.withColumns({c: F.lit("clash") for c in CLASHES})


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def small_labels(spark):
    return spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
