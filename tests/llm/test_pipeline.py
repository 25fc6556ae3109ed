"""The stages one by one, and how queries are registered."""

import collections

import corpus_pipeline
import public_tokenizers
import pytest
from conftest import SCHEMA, odd_rows
from pyspark.sql import functions as F
from test_near_dups import brute as brute_groups
from test_packing import check as check_packing
from test_texts import without_repeats

import __spark_entry__
from stallworks.llm import mixing, toxicity
from stallworks.llm.common import fold, labelled_sample

SF = "/root/testdata/sf0.001"
NATIVE = ["op2_line_dedup", "op3_winnowing", "op7_target_ratio", "op8_source_mixing", "op9_secret_scan"]


def rows_of(df):
    return collections.Counter(tuple(r) for r in df.select(*corpus_pipeline.COLUMNS).collect())


@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory):
    """What every stage took and returned."""
    folder = tmp_path_factory.mktemp("stages")
    odd = [(r[0] + 1000, *r[1:]) for r in odd_rows()]
    docs = spark.read.parquet(f"{SF}/documents.parquet").unionByName(spark.createDataFrame(odd, SCHEMA))
    docs.write.parquet(f"{folder}/0")
    out = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        taken = spark.read.parquet(f"{folder}/{k}")
        stage(spark, taken, SF).write.parquet(f"{folder}/{k + 1}")
        out.append((name, taken, spark.read.parquet(f"{folder}/{k + 1}")))
    return out


def test_stages_are_the_five(staged):
    assert [name for name, *_ in staged] == ["toxicity", "line_dedup", "near_dedup", "source_mixing", "packing"]
    for _, taken, given in staged[:-1]:
        assert given.dtypes == taken.dtypes


def test_toxic_documents_go(spark, staged):
    _, taken, given = staged[0]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = toxicity.fit(taken, labelled_sample(labels, "toxic", fold(F.col("doc_id"), 3) != 1))
    kept = [r for r in toxicity.score(taken, model).collect() if r["toxicity"] < 0.7]
    assert rows_of(given) == collections.Counter(tuple(r[c] for c in corpus_pipeline.COLUMNS) for r in kept)
    assert given.count() > 0.8 * taken.count()


def test_repeated_chunks_go(staged):
    _, taken, given = staged[1]
    rows = taken.select(*corpus_pipeline.COLUMNS).collect()
    want = without_repeats([(r["doc_id"], r["text"] or "") for r in rows])
    left = collections.Counter()
    for r in rows:
        text, gone = want[r["doc_id"], r["text"] or ""]
        if not gone or text.strip(" \t\n\x0b\x0c\r"):
            left[r["doc_id"], text if gone else r["text"], r["lang"], r["source"], None if r["text"] is None else len(text)] += 1
    assert rows_of(given) == left


def test_one_of_each_group_stays(staged):
    _, taken, given = staged[2]
    groups = brute_groups([(r["doc_id"], r["text"]) for r in taken.select("doc_id", "text").collect()], 5, 80)
    kept = {k for k, (_, _, first) in groups.items() if first}
    assert rows_of(given) == rows_of(taken.where(F.col("doc_id").isin(list(kept))).dropDuplicates(["doc_id"]))
    assert given.count() == len(kept) < taken.select("doc_id").count()


def test_every_document_is_mixed_in(staged):
    _, taken, given = staged[3]
    copies = {tuple(r[c] for c in corpus_pipeline.COLUMNS): r["mix_copies"] for r in mixing.mix_sources(taken, repetition=1.5).collect()}
    once = rows_of(taken)
    assert rows_of(given) == collections.Counter({k: n * copies[k] for k, n in once.items()})
    assert min(copies.values()) >= 1


def test_sequences_hold_every_document(staged):
    _, taken, given = staged[4]
    docs = [(r["doc_id"], r["text"]) for r in taken.collect()]
    check_packing([r.asDict() for r in given.collect()], docs, 4096)
    assert public_tokenizers.path("word_bpe_49k.json")


def test_queries_are_registered(spark):
    queries, sql = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    ours = [q for q in queries if q.startswith("op") and q[2].isdigit()]
    assert sorted(int(q[2:].split("_")[0]) for q in ours) == list(range(1, 14)) and "pipeline" in queries
    assert "op2_line_dedup" in sql and corpus_pipeline.ORACLE_SQL is None


@pytest.mark.parametrize("name", NATIVE)
def test_native_queries_have_no_python_in_their_plan(spark, name):
    plan = __spark_entry__.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in ("Python", "Pandas", "Arrow") if x in plan]
