import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from stallworks.llm import periodic_runs, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(words, least=12):
    """All runs by comparing the words with themselves at every distance."""
    found, seen = [], set()
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i < len(words) - q:
            j = i
            while j < len(words) - q and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, 2 * q) and j > i and (i, j + q) not in seen:
                seen.add((i, j + q))
                found.append((i, j + q, q))
            i = j + 1 if j == i else j
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for start, end, q in runs for i in range(start + q, end)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def made_documents(rnd):
    for _ in range(rnd.randrange(1, 5)):
        k = rnd.choice([1, 2, 3, 5, 50])
        n = rnd.randrange(0, 90)
        words = [rnd.randrange(k) for _ in range(n)]
        if rnd.random() < 0.6 and n:
            at = rnd.randrange(n)
            period = 1 + (n - at) // rnd.randrange(3, 10)
            words = words[:at] + [words[at + (i - at) % period] for i in range(at, n)] + [rnd.randrange(k) for _ in range(rnd.randrange(5))]
        yield words + words if rnd.random() < 0.2 else words


@pytest.mark.parametrize("seed", range(4))
def test_all_maximal_runs_by_brute_force(seed):
    rnd = random.Random(seed)
    for _ in range(120):
        docs = list(made_documents(rnd))
        docs += [list(docs[0])] * rnd.randrange(3)
        bounds = np.cumsum([0, *map(len, docs)])
        codes = np.asarray([w for d in docs for w in d], np.int64)
        want = [(s + b, e + b, q) for d, b in zip(docs, bounds.tolist()) for s, e, q in brute(d)]
        assert [tuple(r) for r in periodic_runs.runs_of(codes, bounds, 60).T.tolist()] == want


def test_words_that_nest_and_words_without_squares():
    a, b = [0], [0, 1]
    while len(b) < 400:
        a, b = b, b + a  # Fibonacci words hold as many runs as words can
    codes = np.asarray(b, np.int64)
    assert [tuple(r) for r in periodic_runs.runs_of(codes, np.asarray([0, len(codes)]), 2).T.tolist()] == brute(b)
    codes = np.arange(500)
    assert periodic_runs.runs_of(codes, np.asarray([0, 500]), 500).shape == (3, 0)


def test_grammar_derives_its_documents():
    rnd = random.Random(3)
    docs = list(made_documents(rnd)) + [[1] * 77, []]
    bounds = np.cumsum([0, *map(len, docs)])
    codes = np.asarray([w for d in docs for w in d], np.int64)
    grammar = periodic_runs.repair(codes, bounds, 60)

    def words(symbol):
        if symbol < grammar.words:
            return [symbol]
        return words(grammar.left[symbol - grammar.words]) + words(grammar.right[symbol - grammar.words])

    assert [words(s) for s in grammar.roots.tolist()] == [d for d in docs if d]
    assert grammar.length[grammar.roots].tolist() == [len(d) for d in docs if d]


def test_hashes_that_fail_are_drawn_anew(monkeypatch):
    codes = np.asarray(([0, 1, 2] * 20 + [3, 4] * 11), np.int64)
    honest = periodic_runs.Stretches.equal
    calls = []

    def equal(self, a, b, size):
        calls.append(len(a))
        return honest(self, a, b, size) if len(calls) > 40 else np.ones(len(a), bool)

    monkeypatch.setattr(periodic_runs.Stretches, "equal", equal)
    found = periodic_runs.runs_of(codes, np.asarray([0, len(codes)]), 5)
    assert [tuple(r) for r in found.T.tolist()] == brute(codes.tolist())


def expected(doc_id, text, least=12):
    words = WORD.findall(text or "")
    order = queries.periodic_tail(doc_id, len(words))
    words = words if order is None else [words[i] for i in order.tolist()]
    runs = brute(words, least)
    best = min(runs, key=lambda r: (r[0] - r[1], r[0], r[2]), default=None)
    lines = "".join(f"{s},{e - s},{q}\n" for s, e, q in runs)
    top = (best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2]) if best else (None,) * 4
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(runs), *top, sha(lines), sha(collapsed(words, runs)))


def key(row):
    return tuple((x is None, x or 0) if not isinstance(x, str) else (False, x) for x in row)


def test_query_by_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    got = sorted(map(tuple, queries.op13_periodic_runs(spark, folder).collect()), key=key)
    assert got == sorted((expected(*r) for r in docs), key=key)
    assert sum(r[1] > 0 for r in got) > 10


def test_odd_rows(spark, odd):
    rows = [(20, "a b " * 3), (20, "a b " * 6), (21, " ".join(["x"] * 12)), (None, "y " * 40), (22, "a b c d e f g " * 2)]
    docs = odd.unionByName(spark.createDataFrame(rows, "doc_id long, text string"), allowMissingColumns=True).repartition(3)
    found = periodic_runs.find_runs(docs.where("length(text) < 100000 OR text IS NULL"))
    got = sorted(((r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in found.collect()), key=str)
    want = []
    for r in docs.where("length(text) < 100000 OR text IS NULL").select("doc_id", "text").collect():
        words = WORD.findall(r["text"] or "")
        runs = brute(words)
        want.append((r["doc_id"], len(words), [(s, e - s, q) for s, e, q in runs], collapsed(words, runs)))
    assert got == sorted(want, key=str)


def test_a_very_long_text_of_one_period(spark):
    docs = spark.range(1).select(F.lit(1).cast("long").alias("doc_id"), F.expr("concat('z ', repeat('p q r ', 200000))").alias("text"))
    row = periodic_runs.find_runs(docs).first()
    assert [tuple(r) for r in row["runs"]] == [(1, 600_000, 3)] and row["collapsed"] == "z p q r"


def test_no_documents(none):
    assert periodic_runs.find_runs(none).collect() == []
