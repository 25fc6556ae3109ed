import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from stallworks.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def ids_of(text, tokenizer):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def check(rows, docs, length):
    tokenizer = Tokenizer.from_file(PATH)
    want = []
    for doc_id, text in docs:
        ids = ids_of(text, tokenizer)
        for piece, start in enumerate(range(0, len(ids), length)):
            part = ids[start : start + length]
            want.append((doc_id, piece, start, len(part), np.asarray(part, "<u4").tobytes()))
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    got = sorted(((r["doc_id"], r["piece"], r["start"], r["length"], bytes(r["ids"])) for r in rows), key=key)
    assert got == sorted(want, key=key)
    places = {}
    for r in rows:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in places.values():
        spans.sort()
        assert spans[0][0] == 0 and all(a + b == c for (a, b), (c, _) in zip(spans, spans[1:]))
        assert sum(spans[-1]) <= length
    return places


def test_ids_pieces_and_places_of_odd_documents(odd):
    rows = packing.pack_documents(odd, PATH, sequence_length=64, block_rows=4).collect()
    check(rows, [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()], 64)


def test_given_documents_fill_their_sequences(small):
    rows = packing.pack_documents(small, PATH).collect()
    places = check(rows, [(r["doc_id"], r["text"]) for r in small.collect()], 4096)
    assert len(places) <= 1.03 * -(-sum(r["length"] for r in rows) // 4096) + 1
    digests = packing.pack_documents(small, PATH, digest=True).collect()
    want = {(r["doc_id"], r["piece"]): zlib.crc32(bytes(r["ids"])) for r in rows}
    assert {(r["doc_id"], r["piece"]): r["ids_crc32"] for r in digests} == want


def test_no_documents(none):
    assert packing.pack_documents(none, PATH).collect() == []


def test_words_are_encoded_as_the_tokenizer_does():
    texts = ["It's <|endoftext|> Ünder ÅNGSTRÖM's don't!!", "a　b ʼn İstanbul ß ẞ", "x1y2 $$%% 'LL we'RE", "é   tab\tnew\nline", ""]
    tokenizer = Tokenizer.from_file(PATH)
    ids, bounds = packing.WordEncoder(PATH).texts(pa.array(texts))
    for text, a, b in zip(texts, bounds[:-1], bounds[1:]):
        assert ids[a:b].tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_sum_of_squares_takes_the_least_change():
    rng = np.random.default_rng(3)
    lengths = rng.integers(1, 20, 200)
    sequence, offset = packing.sum_of_squares(lengths, 20)
    gaps = {}
    total = lambda: sum(n * n for n in np.bincount([g for g in gaps.values() if g], minlength=1))
    for s, own, at in zip(lengths, sequence, offset):
        options = []
        for bin_, gap in [*gaps.items(), (-1, 20)]:
            if gap >= s:
                before = dict(gaps)
                gaps[bin_] = gap - s
                options.append(total())
                gaps.clear()
                gaps.update(before)
        assert at == (20 - gaps[own] if own in gaps else 0)
        gaps[own] = gaps.get(own, 20) - s
        assert total() == min(options)


def test_a_block_holds_its_pieces_once():
    names = ["doc_id", "piece", "start", "length", "ids", "sequence_id", "offset"]

    def batches():
        lengths = np.full(1500, 2000)
        lengths[0] = 4096
        ids = [bytes(4 * n) for n in lengths]
        cols = [pa.array(np.arange(1500)), pa.array(np.zeros(1500, np.int32)), pa.array(np.zeros(1500, np.int64)), pa.array(lengths), pa.array(ids)]
        yield pa.RecordBatch.from_arrays(cols, names[:5])

    before = pa.total_allocated_bytes()
    rows, most = 0, 0
    for part in packing._block(batches(), 3, 4096, 0, names):
        rows += len(part)
        if part.column(3)[0].as_py() < 4096:
            most = max(most, pa.total_allocated_bytes() - before - part.nbytes)
    assert rows == 1500 and most < 1.6 * 4 * 2000 * 1500
