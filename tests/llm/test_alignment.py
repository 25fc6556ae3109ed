import collections
import hashlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from stallworks.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")

#: White space of all kinds, marks, special tokens, the sign that stands for a space, and bytes that B spells out.
ODD = [
    None, "", " ", "  ", "a", " a", "a ", "a  b  ", "\n", "x\n y\n\n  z", "tab\t x\t\ty", "▁", "x▁ y", "a▁b c",
    "<|endoftext|> <s> </s> <unk>", "　 x　  y", "😀 東京 ünḯ cödé", "a\x00b \x00", "x" * 3000, "it's  don't 'LL we're 123 4567",
    "  nb sp ", "<0x41> ﻿ x", "ﬁ ligature Å Å", "\x7f \x1c a\x85 b  c", "end​ zero", "é x", "Ärger, über; ÿ! ß",
]


def token_spans(ids, spelled):
    spans, at = [], 0
    for i in ids:
        spans.append((at, at + len(spelled[i]), i))
        at = spans[-1][1]
    return spans


def brute(rows):
    pair = alignment.TwoTokenizers(A, B)
    counts, docs = collections.Counter(), []
    for doc_id, text in rows:
        raw = b" " + (text or "").encode()
        a = token_spans(pair.a.encode(" " + (text or ""), add_special_tokens=False).ids, pair.bytes_a)
        b = token_spans(pair.b.encode(text or ""), pair.bytes_b)
        same = all(b"".join(s[i] for _, _, i in t) == raw for t, s in ((a, pair.bytes_a), (b, pair.bytes_b)))
        if not text or not same:
            docs.append((doc_id, None))
            continue
        links = [(x[2], y[2]) for x in a for y in b if max(x[0], y[0]) < min(x[1], y[1])] if len(a) < 400 else merged(a, b)
        groups, low = [], 0
        for cut in sorted({x[1] for x in a} & {y[1] for y in b}):
            sides = [",".join(str(i) for s, e, i in t if low <= s and e <= cut) for t in (a, b)] if len(a) < 400 else None
            groups.append("|".join(sides) if sides else cut)
            low = cut
        if len(a) >= 400:
            groups = grouped(a, b, groups)
        counts.update(links)
        docs.append((doc_id, (len(a), len(b), len(groups), links, ";".join(groups))))
    most = collections.Counter()
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    for doc_id, found in docs:
        if found is None:
            yield doc_id, 0, 0, 0, 0, 0, 0, ""
            continue
        n_a, n_b, n_groups, links, text = found
        best = sum(counts[link] == most[link[1]] for link in links)
        digest = hashlib.sha256(text.encode()).hexdigest()
        yield doc_id, n_a, n_b, n_groups, len(links), best, sum(counts[link] for link in links), digest


def merged(a, b):
    """Overlapping pairs of long texts by a walk along both sides."""
    links, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        links.append((a[i][2], b[j][2]))
        x, y = a[i][1], b[j][1]
        i, j = i + (x <= y), j + (y <= x)
    return links


def grouped(a, b, cuts):
    groups, i, j = [], 0, 0
    for cut in cuts:
        own = [[], []]
        while i < len(a) and a[i][1] <= cut:
            own[0].append(str(a[i][2]))
            i += 1
        while j < len(b) and b[j][1] <= cut:
            own[1].append(str(b[j][2]))
            j += 1
        groups.append("|".join(",".join(x) for x in own))
    return groups


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, *r[1:]))


def test_odd_texts_repeated_rows_and_clashing_columns(spark, odd):
    extra = spark.createDataFrame([(100 + i, t) for i, t in enumerate(ODD)] + [(None, "no id"), (100, None)], "doc_id long, text string")
    docs = odd.unionByName(extra, allowMissingColumns=True).repartition(3)
    got = alignment.align_tokenizers(docs, A, B, digest=True).collect()
    want = list(brute([tuple(r) for r in docs.select("doc_id", "text").collect()]))
    assert ordered(got) == ordered(want)


def test_given_documents(spark, small):
    got = alignment.align_tokenizers(small, A, B, digest=True).collect()
    assert ordered(got) == ordered(brute([tuple(r) for r in small.select("doc_id", "text").collect()]))


def test_groups_themselves_and_several_slices(small, monkeypatch):
    whole = ordered(alignment.align_tokenizers(small, A, B).collect())
    assert any(";" in r[-1] for r in whole)
    parts = alignment.align_tokenizers(small.repartition(7, F.hash("doc_id")), A, B).collect()
    assert ordered(parts) == whole


def test_units_join_up_to_their_texts(spark):
    import pyarrow as pa

    texts = [t for t in ODD if t]
    units, codes, bounds = alignment.cut_units(pa.array(texts))
    for text, low, high in zip(texts, bounds[:-1], bounds[1:]):
        assert " ".join(units[c] for c in codes[low:high]) == text


@pytest.mark.parametrize("entry", ["n_a", "groups"])
def test_no_documents(none, entry):
    assert alignment.align_tokenizers(none, A, B).select(entry).collect() == []
