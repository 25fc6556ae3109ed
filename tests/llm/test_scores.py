"""Toxicity and quality models, and the target ratio: held-out accuracy and odd rows."""

import collections
import random
import re
import time

import numpy as np
import pytest
from conftest import odd_rows
from pyspark.sql import functions as F

from stallworks.llm import quality_rules, queries, target_ratio, toxicity
from stallworks.llm.common import LABEL_BOUND, fold, labelled_sample


def accuracy(scored, labels, name, label, held, bar):
    truth = labels.select("doc_id", F.col(label).alias("truth"))
    rows = scored.join(truth, "doc_id").where(held).select(name, "truth").collect()
    good = sum((r[name] >= bar) == (r["truth"] > 0) for r in rows)
    return good / max(1, len(rows))


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet("/root/testdata/sf0.01/labels.parquet")


def test_toxicity_held_out(docs, labels, odd, none):
    held = fold(F.col("doc_id"), 3) == 1
    model = toxicity.fit(docs, labelled_sample(labels, "toxic", ~held))
    scored = toxicity.score(docs, model)
    assert accuracy(scored, labels, "toxicity", "toxic", held, 0.7) > 0.93
    rows = toxicity.score(odd, model).collect()
    assert len(rows) == len(odd_rows()) and all(0 <= r["toxicity"] <= 1 for r in rows)
    by_id = collections.defaultdict(set)
    for r in rows:
        by_id[r["doc_id"]].add(r["toxicity"])
    assert len(by_id[1]) == 1 and by_id[2] == by_id[3]
    assert toxicity.score(none, model).collect() == []


def test_toxicity_without_labels(docs, labels, small):
    sample = labelled_sample(labels.where("toxic < 0"), "toxic", F.lit(True))
    model = toxicity.fit(docs, sample)
    assert {r["toxicity"] >= 0.7 for r in toxicity.score(small, model).collect()} == {False}


def test_toxic_class_held_out(spark):
    """Recall and precision of the toxic class, not of all rows, nine in ten of which are clean."""
    folder = "/root/testdata/sf0.1"
    truth = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    rows = queries.op6_toxicity(spark, folder).join(truth, "doc_id").where("held_out AND toxic IS NOT NULL")
    got = collections.Counter((r["toxic"], r["predicted"]) for r in rows.collect())
    assert got[1, 1] > 0.93 * (got[1, 1] + got[1, 0])
    assert got[1, 1] > 0.93 * (got[1, 1] + got[0, 1])


def test_log_odds_against_definition(spark):
    """Every token, frequent or rare, seen in either class, in both or in none."""
    rnd = random.Random(5)
    words = [f"word{chr(97 + k)}" for k in range(12)] + ["a", "be", "Wordabc", "(be)", "77", "stemming", "stemmed"]
    texts = [(k, " ".join(rnd.choices(words[: 8 + k % 11], k=9)), int(k % 4 == 0)) for k in range(40)]
    docs = spark.createDataFrame(texts, "doc_id long, text string, label int")
    model = toxicity.fit(docs.select("doc_id", "text"), docs.select("doc_id", "label"))
    held = [({u for w in t.split() for u in toxicity.units(w) if u}, y) for _, t, y in texts]
    share = sum(y for _, y in held) / len(held)

    def posterior(unit, prior, strength):
        n = [sum(unit in u and y == c for u, y in held) for c in (0, 1)]
        n = n if unit and sum(n) >= toxicity.LEAST_TEXTS else [0, 0]
        return (n[1] + strength * prior) / (sum(n) + strength)

    def logit(x):
        return np.log(x / (1 - x))

    for word in [*words, "unseen", "stemless", "77", "be!"]:
        bare, stem = toxicity.units(word)
        by_word = posterior(bare, posterior(stem, share, toxicity.STEM_PRIOR), toxicity.WORD_PRIOR)
        want = logit(by_word) - logit(share) if bare else 0.0
        assert model.log_odds([word])[0] == pytest.approx(want, abs=1e-9)
    scores = model.log_odds(words)
    assert min(scores) < 0 < max(scores)
    rest = model.without(0)
    assert rest.texts.sum() + model.texts[0].sum() == len({t for _, t, _ in texts})


def test_segments_are_those_of_all_tokens():
    """Stretches of one sign stand for their tokens; texts do not run into each other."""
    rnd = random.Random(8)
    texts = [[rnd.choice([-2.5, -1.25, 0.0, 1.5, 3.0]) + rnd.random() / 1000 for _ in range(n)] for n in (0, 1, 7, 30, 0, 12, 0)]
    bounds = np.cumsum([0] + [len(t) for t in texts])
    got = list(toxicity.ToxicModel().segments_of(np.array(sum(texts, [])), bounds))
    assert [n for n, _ in got] == [len(t) for t in texts]
    for (_, spans), scores in zip(got, texts, strict=True):
        want = toxicity.maximal_segments(scores)
        # neighbouring hits of one stretch are one segment by definition
        assert [(a, b) for a, b, _ in spans] == [(a, b) for a, b, _ in want]
        assert [s for *_, s in spans] == pytest.approx([s for *_, s in want])


def test_extreme_values_against_definition():
    """``lambda`` solves its equation; the level's segments are as many as expected; E falls by it."""
    tokens = {-64: 90_000, -32: 9_000, 64: 600, 160: 400}
    segments = {64: 120, 160: 6}
    scale, constant = toxicity.extreme_values(tokens, segments)
    assert sum(n * np.exp(scale * b / 64) for b, n in tokens.items()) == pytest.approx(100_000, rel=1e-6)
    assert constant * 100_000 * np.exp(-scale * 160 / 64) == pytest.approx(7)
    model = toxicity.ToxicModel(scale=scale, constant=constant)
    spans = [(0, 3, 0.5), (5, 9, 11.0)]
    want = [(a, b, s, constant * 50 * np.exp(-scale * s)) for a, b, s in spans]
    want = [x for x in want if x[3] <= toxicity.SIGNIFICANT]
    assert len(want) == 1 and [x[:3] for x in model.passages(50, spans)] == [x[:3] for x in want]
    assert [x[3] for x in model.passages(50, spans)] == pytest.approx([x[3] for x in want])
    assert model.statistic(model.passages(50, spans)) == pytest.approx(-sum(np.log(x[3]) for x in want))
    assert toxicity.extreme_values({}, {}) == (1.0, 1.0)


def test_maximal_segments_against_definition():
    rnd = random.Random(2)

    def brute(scores):
        """The best segment, then the best of what is left on either side."""
        best = None
        for a in range(len(scores)):
            for b in range(a + 1, len(scores) + 1):
                s = sum(scores[a:b])
                if s > 0 and (best is None or s > best[2] or (s == best[2] and b - a < best[1] - best[0])):
                    best = (a, b, s)
        if best is None:
            return []
        a, b, _ = best
        right = [(x + b, y + b, s) for x, y, s in brute(scores[b:])]
        return brute(scores[:a]) + [best] + right

    for _ in range(150):
        scores = [float(rnd.choice([-7, -5, -3.01, 2.003, 4.0301, 9.1107]) + rnd.random() / 1000) for _ in range(rnd.randrange(0, 14))]
        got = toxicity.maximal_segments(scores)
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in brute(scores)]


def test_quality_held_out(docs, labels, odd, none):
    held = fold(F.col("doc_id"), 5) == 0
    model = quality_rules.fit(docs, labelled_sample(labels, "quality", ~held))
    scored = quality_rules.score(docs, model)
    assert model.rules and accuracy(scored, labels, "quality", "quality", held, 0.3) > 0.95
    rows = quality_rules.score(odd, model).collect()
    assert len(rows) == len(odd_rows()) and all(0 <= r["quality"] <= 1 for r in rows)
    assert quality_rules.score(none, model).collect() == []


def test_rules_are_the_columns_they_say(spark):
    rule = quality_rules.Rule((("upper", True, 0.5), ("digit", False, 0.1)), 2.0)
    model = quality_rules.RuleModel((rule,), -1.0)
    rows = spark.createDataFrame([(0.5, 0.2), (0.6, 0.2), (0.1, 0.1)], "upper double, digit double")
    got = [r[0] for r in rows.select(model.score()).collect()]
    assert got == pytest.approx([1 / (1 + np.exp(-1)), 1 / (1 + np.exp(1)), 1 / (1 + np.exp(1))])


def test_quality_without_labels(docs, labels, small):
    model = quality_rules.fit(docs, labelled_sample(labels.where("quality < 0"), "quality", F.lit(True)))
    assert {r["quality"] for r in quality_rules.score(small, model).collect()} == {0.5}


def base(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = collections.Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = {k for i in range(len(w) - 7) if grams[tuple(w[i : i + 8])] > 1 for k in range(i, i + 8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed


def test_base_statistics(odd, docs, none):
    for df in (odd, docs):
        texts = df.select("doc_id", "text").collect()
        names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
        got = collections.Counter((r["doc_id"], *(r[n] for n in names)) for r in target_ratio.base_statistics(df).collect())
        assert got == collections.Counter((r["doc_id"], *base(r["text"])) for r in texts)
    assert target_ratio.base_statistics(none).collect() == []


def test_target_counts_all_trusted_rows(spark, tmp_path):
    """One more than the classifiers' bound, each with a text of its own."""
    n = LABEL_BOUND + 1
    ids = spark.range(n).select(F.col("id").alias("doc_id"))
    ids.withColumn("text", F.concat(F.lit("word w"), "doc_id")).write.parquet(f"{tmp_path}/documents.parquet")
    ids.withColumn("quality", F.lit(1)).withColumn("toxic", F.lit(0)).write.parquet(f"{tmp_path}/labels.parquet")
    rows = queries.op7_target_ratio(spark, str(tmp_path))
    # the target is the corpus, so no n-gram is rarer in either
    assert rows.count() == n and rows.where("abs(target_ratio) > 1e-12").isEmpty()


def test_ratio_of_every_document(docs, labels, odd, none):
    trusted = labelled_sample(labels, "quality", F.col("quality") == 1)
    counts = target_ratio.gram_counts(docs, trusted)
    table = target_ratio.ratios(counts)
    words = sum(len(re.findall(r"[^\x20\x09-\x0D]+", r["text"])) for r in docs.collect())
    grams = counts.agg(F.sum("raw")).first()[0]
    assert words < grams <= 2 * words
    scored = target_ratio.score(target_ratio.base_statistics(docs), table).join(labels, "doc_id")
    fine = scored.where("NOT base_failed AND quality = 1").collect()
    kept = sum(r["target_ratio"] >= target_ratio.THRESHOLD for r in fine)
    assert kept > 0.98 * len(fine)
    assert len(target_ratio.score(target_ratio.base_statistics(odd), table).collect()) == len(odd_rows())
    assert set(target_ratio.ratios(target_ratio.gram_counts(none, trusted))) == {0.0}


def test_maximal_segments_take_linear_time():
    """Falling totals leave every segment open; each must be passed once, not by all later ones."""

    def taken(n):
        began = time.process_time()
        assert len(toxicity.maximal_segments([1.0, -2.0] * n)) == n
        return time.process_time() - began

    assert min(taken(64_000) for _ in range(3)) < 1
