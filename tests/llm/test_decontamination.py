import hashlib
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from stallworks.llm import decontamination, queries

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, window=10):
    out = []
    for doc_id, text in docs:
        own = words(text)
        hit, found, longest = set(), set(), 0
        for item_id, item in items:
            test = words(item)
            width = min(window, len(test))
            for j in range(len(test) - width + 1 if test else 0):
                for i in range(len(own) - width + 1):
                    if own[i : i + width] == test[j : j + width]:
                        hit |= set(range(i, i + width))
                        if item_id is not None:
                            found.add(item_id)
                        size = width
                        while i + size < len(own) and j + size < len(test) and own[i + size] == test[j + size]:
                            size += 1
                        longest = max(longest, size)
        out.append((doc_id, len(own), len(hit), sorted(found), longest, bool(hit)))
    return out


def rows(found):
    return [(r["doc_id"], r["n_words"], r["n_hit"], list(r["items"]), r["longest"], r["contaminated"]) for r in found.collect()]


def key(row):
    return row[0] is None, row[0] or 0, row[1:]


ITEMS = [
    (1, "one two three four five six seven eight nine ten eleven twelve"),
    (2, "Short Item"),
    (2, "short, item!"),
    (3, None),
    (4, " . "),
    (None, "an item without an id but with ten words in all"),
    (5, "zero one two three four five six seven eight nine ten"),
    (6, "été ÉTÉ été 東京 x"),
    (7, "a a a a a a a a a a a a"),
]
DOCS = [
    (1, "ZERO one-two three_four five six seven eight nine ten eleven no one two three four five six seven eight nine ten eleven twelve"),
    (2, "a short item. short item"),
    (3, None),
    (4, ""),
    (None, "an item without an id but with ten words in all, short item"),
    (5, "a " * 30),
    (6, "x été ÉTÉ été 東京 x y"),
    (6, "two three four five six seven eight nine ten"),
    (7, "one two three four five six seven eight nine"),
    (7, "one two three four five six seven eight nine"),
    (8, "ten eleven twelve one two three four five six seven eight nine ten"),
]


@pytest.fixture(scope="module")
def made(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string").repartition(3)
    docs = docs.withColumns({c: F.lit("clash") for c in ("words", "spans", "items", "longest", "_hit_digest_", "digest")})
    return docs, spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("words", F.lit(1))


@pytest.mark.parametrize("block_bytes", [1 << 20, 100])
def test_odd_texts_by_brute_force(made, block_bytes):
    docs, items = made
    got = rows(decontamination.contamination(docs, items, block_bytes=block_bytes))
    assert sorted(got, key=key) == sorted(brute(DOCS, ITEMS), key=key)


def test_given_tables_by_brute_force(spark, small):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    docs = small.where("n_chars < 4000")
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()], [tuple(r) for r in items.select("item_id", "text").collect()])
    assert sorted(rows(decontamination.contamination(docs, items)), key=key) == sorted(want, key=key)
    assert any(r[-1] for r in want)


def test_longest_match_may_lie_across_items_windows(spark):
    item = " ".join(f"t{i}" for i in range(40))
    docs = spark.createDataFrame([(1, "x " + " ".join(f"t{i}" for i in range(5, 33)) + " y"), (2, item + " " + item)], "doc_id long, text string")
    found = decontamination.contamination(docs, spark.createDataFrame([(9, item)], "item_id long, text string"))
    got = {r["doc_id"]: (r["longest"], r["longest_start"], [tuple(s) for s in r["spans"]]) for r in found.collect()}
    assert got == {1: (28, 1, [(1, 29)]), 2: (40, 0, [(0, 80)])}


def test_removal_keeps_clean_rows_and_their_columns(made):
    docs, items = made
    kept = decontamination.decontaminate(docs, items)
    assert kept.columns == docs.columns
    want = [r[0] for r in brute(DOCS, ITEMS) if not r[-1]]
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted(want, key=str)


def test_no_benchmark_and_no_documents(spark, small, none):
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.contamination(small, nothing).where("contaminated").count() == 0
    assert decontamination.contamination(none, nothing).collect() == []


def test_odd_rows(odd, spark):
    items = spark.createDataFrame([(1, "w"), (2, "text")], "item_id long, text string")
    docs = [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]
    got = [r[:4] + r[5:] for r in rows(decontamination.contamination(odd, items))]
    assert sorted(got, key=key) == sorted((r[:4] + r[5:] for r in brute(docs, [(1, "w"), (2, "text")])), key=key)


def test_query_and_sql_give_the_same_rows(spark):
    folder = "/root/testdata/sf0.001"
    db = duckdb.connect()
    for name in ("documents", "benchmark"):
        db.sql(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    found = queries.op12_training_suffixes(spark, folder)
    assert sorted(map(tuple, found.collect())) == sorted(db.sql(decontamination.SQL).fetchall())
    assert hashlib.sha256(b"").hexdigest() in {r["items_sha256"] for r in found.collect()}
