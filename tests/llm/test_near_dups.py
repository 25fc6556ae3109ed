import random
import re
from pathlib import Path

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
from conftest import SCHEMA, prose

from stallworks.llm import near_dups, queries


def sets_of(rows, size):
    out = {}
    for doc_id, text in rows:
        low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        w = re.findall(r"[^\x20\x09-\x0D]+", low)
        out[doc_id] = {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()
    return out


def brute(rows, size, percent):
    sets = sets_of(rows, size)
    root = {k: k for k in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    return {k: (len(sets[k]), find(k), find(k) == k) for k in sets}


def result(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect()}


def test_odd_documents(odd):
    rows = [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]
    assert result(near_dups.near_duplicates(odd, 3, 85)) == brute(rows, 3, 85)


def test_null_ids_and_no_documents(spark, none):
    assert near_dups.near_duplicates(none).collect() == []
    rows = spark.createDataFrame([(None, "a b c d e f", "", "", 0), (1, None, "", "", 0)], SCHEMA)
    assert result(near_dups.near_duplicates(rows)) == {1: (0, 1, True)}


def test_texts_that_share_an_id_and_rows_without_one(spark, tmp_path):
    """Each text of an id is judged; no document without an id is lost."""
    one, two, three = prose(1, 90), prose(2, 90), prose(3, 90)
    rows = [(1, one), (1, two), (2, two + " end"), (3, three), (4, two), (None, one), (None, one), (None, prose(4, 90))]
    df = spark.createDataFrame([(i, t, "", "", 0) for i, t in rows], SCHEMA)
    got = [tuple(r) for r in near_dups.near_duplicates(df).select("doc_id", "component_id", "kept").collect()]
    assert sorted(got) == [(1, 1, True), (1, 1, True), (2, 1, False), (3, 3, True), (4, 1, False)]
    assert [r["n_rows"] for r in near_dups.near_duplicates(df.unionByName(df)).collect()] == [2] * 5
    left = [(r["doc_id"], r["text"]) for r in corpus_pipeline.drop_near_duplicates(spark, df, "").collect()]
    assert sorted(left, key=str) == sorted([(1, one), (1, two), (3, three), *rows[5:]], key=str)
    df.write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op5_minhash_near_dups(spark, str(tmp_path)).collect()
    assert len(found) == len(rows) and sum(r["kept"] for r in found) == 6


@pytest.mark.parametrize("block", [8, 1024])
def test_a_large_group_of_copies_that_drift(spark, monkeypatch, block):
    """Copies of copies: many are linked through others, many to none."""
    monkeypatch.setattr(near_dups, "BLOCK", block)
    rnd = random.Random(5)
    texts = [prose(9, 120).split()]
    for _ in range(140):
        words = list(rnd.choice(texts))
        for _ in range(rnd.choice([1, 1, 2, 6, 9])):
            words[rnd.randrange(len(words))] = f"n{rnd.randrange(10**6)}"
        texts.append(words)
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)] + [(500 + i, texts[3] and " ".join(texts[3])) for i in range(20)]
    df = spark.createDataFrame([(i, t, "", "", 0) for i, t in rows], SCHEMA)
    assert result(near_dups.near_duplicates(df, 3, 85)) == brute(rows, 3, 85)


def test_given_documents(small):
    rows = [(r["doc_id"], r["text"]) for r in small.collect()]
    assert result(near_dups.near_duplicates(small, 5, 80, bands=24)) == brute(rows, 5, 80)


def test_bounds_of_the_sequential_test():
    needed = near_dups.least_matches(0.85, 64, 8, near_dups.MISS)
    assert needed == sorted(needed) and needed[-1] < 0.85 * 64
    rng = np.random.default_rng(1)
    left = rng.integers(0, 1 << 32, (4000, 64), dtype=np.uint32)
    right = np.where(rng.random((4000, 64)) < 0.85, left, left + 1).astype(np.uint32)
    assert len(near_dups.survivors(left, right, needed, 8)) == 4000
    assert len(near_dups.survivors(left, left + 1, needed, 8)) == 0


def test_one_row_for_each_input_row(spark, tmp_path):
    one = prose(1, 90)
    rows = [(5, one)] * 3 + [(5, one + " end"), (7, one), (None, one), (None, one)]
    spark.createDataFrame([(i, t, "", "", 0) for i, t in rows], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op5_minhash_near_dups(spark, str(tmp_path)).collect()
    got = sorted(((r["doc_id"], r["component_id"], r["kept"]) for r in found), key=str)
    assert got == sorted([(5, 5, True)] * 4 + [(7, 5, False)] + [(None, None, True)] * 2, key=str)


def test_one_row_of_a_repeated_document_stays(spark):
    one, other = prose(1, 90), prose(2, 90)
    rows = [(5, one, "en", "b", 1), (5, one, "de", "a", 1), (5, one, None, "a", 1), (6, one, "en", "b", 1), (8, None, "x", "y", 0), (8, "", "x", "y", 0), (9, other, "en", "b", 1)]
    left = corpus_pipeline.drop_near_duplicates(spark, spark.createDataFrame(rows, SCHEMA), "").collect()
    assert sorted(map(tuple, left)) == [(5, one, None, "a", 1), (8, "", "x", "y", 0), (9, other, "en", "b", 1)]


def test_links_are_thinned_without_loss(spark):
    rnd = random.Random(4)
    links = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(260)]
    root = list(range(300))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = near_dups.components(spark.createDataFrame(links, "a long, b long").repartition(5))
    want = {x: find(x) for pair in links if pair[0] != pair[1] for x in pair}
    assert {r["rep"]: r["component"] for r in got.collect()} == want


def test_a_task_gives_back_what_arrow_held(spark, monkeypatch):
    """An idle worker keeps no memory of its last texts."""

    def held():
        pages = re.findall(r"\nPss_Anon:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text())
        return int(pages[0]) / 1024

    df, taken = spark.createDataFrame([(1, "a", "", "", 1)], SCHEMA), []
    monkeypatch.setattr(type(df), "mapInArrow", lambda rows, run, schema: taken.append(run) or rows)
    near_dups.signatures(df, 5)
    texts = [" ".join(f"w{i * k % 9973}x{k}" for k in range(500)) for i in range(6000)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(6000)), "key": list(range(6000)), "text": texts})
    list(taken[0](iter([batch.slice(0, 1000)])))
    pa.default_memory_pool().release_unused()
    before = held()
    assert sum(len(part) for part in taken[0](iter([batch]))) == 6000
    assert held() - before < 10
