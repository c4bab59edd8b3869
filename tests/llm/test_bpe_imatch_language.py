"""Ops 5, 8 and 10."""

from __future__ import annotations

import hashlib
import random
import struct
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from haltwerk.llm import bpe, gru, imatch


@pytest.fixture(scope="module")
def coder():
    ranks = bpe.read_ranks(public_tokenizers.path(bpe.RANKS))
    return bpe.ByteBpe(ranks, bpe.merges_of(ranks), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def other():
    ranks = bpe.read_ranks(public_tokenizers.path(bpe.RANKS))
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_the_other_library(docs, odd, none, other):
    for df in (docs, odd):
        want = Counter()
        for r in df.collect():
            ids = other.encode_ordinary(r.text or "")
            want[r.doc_id, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()] += 1
        assert Counter(tuple(r)[:4] for r in bpe.bpe_digests(df).collect()) == want
    assert bpe.bpe_digests(none).collect() == []


def test_bpe_of_random_characters_and_in_pieces(coder, other, monkeypatch):
    rng = random.Random(2)
    kinds = [lambda: rng.randrange(0x20, 0x7F), lambda: rng.randrange(0x80, 0xD7FF), lambda: rng.randrange(0xE000, 0x110000), lambda: rng.choice([9, 10, 32, 0x1C, 0x85, 0xA0])]
    for size in (bpe.PIECES, 7):
        monkeypatch.setattr(bpe, "PIECES", size)
        for _ in range(300):
            text = "".join(chr(rng.choice(kinds)()) for _ in range(30))
            ids = coder.encode(text)
            assert np.frombuffer(ids, "<u4").tolist() == other.encode_ordinary(text) and coder.decode(ids) == text.encode()


def test_offsets_cover_the_text_and_split_characters(coder):
    text = "Zwölf \U0001f600\U0001f60f!"
    ids = coder.encode(text)
    spans = coder.offsets(text, ids)
    assert spans[0, 0] == 0 and spans[-1, 1] == len(text) and (spans[1:, 0] <= spans[:-1, 1]).all()
    assert coder.offsets("", b"").shape == (0, 2)


def test_encode_and_decode_frames(odd):
    encoded = bpe.bpe_encode(odd.where("doc_id <> 4"), offsets=True)
    assert all(len(r.ids) == len(r.starts) == len(r.ends) for r in encoded.collect())
    back = Counter((r.doc_id, bytes(r.bytes)) for r in bpe.bpe_decode(encoded).collect())
    assert back == Counter((r.doc_id, (r.text or "").encode()) for r in odd.where("doc_id <> 4").collect())


def _edited(rows):
    """(doc_id, edited text, next text) in descending order of ids, NULL last."""
    rows = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = []
    for i, (d, t) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        half = len(t) // 2
        out.append((d, t[: len(t) - half] + after[:half], after))
    return out


@pytest.mark.parametrize("size", [imatch.RANGE_BYTES, 20_000])
def test_edited_texts_and_fingerprints(docs, texts, size, monkeypatch):
    monkeypatch.setattr(imatch, "RANGE_BYTES", size)
    got = {r.doc_id: r for r in imatch.fingerprint_edits(docs).collect()}
    terms, n = imatch.lexicon(docs.select("text"))
    frequency = Counter(t for x in texts.values() for t in set(x.lower().split()))
    assert n == len(texts) and terms == sorted(t for t, c in frequency.items() if imatch.LOW * n <= c <= imatch.HIGH * n)
    prints = imatch.Fingerprints(terms)
    spelt = lambda p: "".join(x or "-" * 8 for x in p)
    assert len(got) == len(texts)
    for d, edited, after in _edited(list(texts.items())):
        own, new = prints.of(texts[d]), prints.of(edited)
        assert tuple(got[d])[1:] == (
            len(texts[d]),
            hashlib.sha256(edited.encode()).hexdigest(),
            spelt(own),
            spelt(new),
            imatch.likeness(own, new),
            imatch.likeness(own, prints.of(after)),
        )
    by_text = {}
    assert all(by_text.setdefault(texts[d], r.fingerprint) == r.fingerprint for d, r in got.items())
    assert np.mean([r.near_edited for r in got.values()]) > 10 * np.mean([r.near_next for r in got.values()])


def test_lexicon_is_exact_however_documents_are_dealt(docs, monkeypatch):
    whole = imatch.lexicon(docs.select("text"), 0.02)
    monkeypatch.setattr(imatch, "COUNTED", 100)
    assert imatch.lexicon(docs.repartition(7).select("text"), 0.02) == whole


def test_fingerprints_of_odd_rows(odd, none, spark):
    got = imatch.fingerprint_edits(odd).collect()
    assert len(got) == odd.count() and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    prints = {r.fingerprint for r in got if r.n_chars == 0}
    assert len(prints) == 1
    assert imatch.fingerprint_edits(none).collect() == []
    alone = imatch.fingerprint_edits(spark.createDataFrame([(5, "one two three")], "doc_id long, text string")).head()
    assert (alone.near_next, alone.edited_sha256) == (1.0, hashlib.sha256(b"one twoone tw").hexdigest())


def test_back_propagation_agrees_with_differences():
    rng = np.random.default_rng(0)
    d = gru.Direction.drawn(rng, 3)
    steps = rng.integers(0, 5, (6, 4))
    weigh = rng.normal(size=(6, 3, 4)).astype(np.float32)
    loss = lambda: float((gru._forward(d, steps)[0].astype(np.float64) * weigh).sum())
    grads = gru._backward(d, steps, gru._forward(d, steps)[1], weigh)
    for p, g in zip(d.parameters(), grads, strict=True):
        for at in [(0, 0), (1, 2), (2, 1)]:
            keep, e = p[at], np.float32(1e-2)
            p[at] = keep + e
            up = loss()
            p[at] = keep - e
            down = loss()
            p[at] = keep
            assert (up - down) / 0.02 == pytest.approx(float(g[at]), rel=0.03, abs=0.01)


def test_reading_equals_the_training_network():
    rng = np.random.default_rng(1)
    model = gru.Model(["a", "b"], gru.Direction.drawn(rng, 4), gru.Direction.drawn(rng, 4), rng.normal(size=(2, 9)).astype(np.float32))
    text = bytes(rng.integers(1, 255, 200).tolist())
    cells, _ = gru._stretches([text], gru.STRETCH)
    x = cells.T.astype(np.intp)
    ahead, back = gru._forward(model.ahead, x)[0], gru._forward(model.back, x[::-1])[0][::-1]
    logits = np.einsum("lh,thn->tln", model.out, np.concatenate([ahead, back, np.ones((len(x), 1, x.shape[1]))], axis=1))
    p = np.exp(logits)
    p /= p.sum(axis=1, keepdims=True)
    want = p.transpose(1, 2, 0).reshape(2, -1)[:, (x.T != gru.PAD).ravel()].mean(axis=1)
    assert gru.Reader(model).read([text, b""])[0] == pytest.approx(np.array([want, [0, 0]]), abs=1e-4)


def test_languages_of_rows_that_were_held_out(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: r for r in gru.identify_language(df).collect()}
    true = {r.doc_id: r.lang for r in df.collect()}
    assert got.keys() == true.keys() and all((zlib.crc32(str(d).encode()) % 3 == 1) == r.held_out for d, r in got.items())
    assert np.mean([r.lang_pred == true[d] for d, r in got.items() if r.held_out]) > 0.97


def test_languages_of_odd_rows(odd, none, docs):
    model = gru.fit(docs, sample_docs=20)
    got = gru.identify_language(odd, model).collect()
    assert len(got) == odd.count()
    assert all(0 <= r.score <= 1 for r in got)
    assert Counter(r.lang_pred == "und" for r in got)[True] == 5  # two NULL, one empty, one blank, one without letters
    assert {r.lang_pred for r in gru.identify_language(odd.drop("lang").selectExpr("*", "CAST(NULL AS STRING) AS lang")).collect()} == {"und"}
    assert gru.identify_language(none).collect() == []
    kept = gru.accepted_languages(odd, model)
    assert kept.columns == odd.columns and kept.count() == odd.count() - 5
