from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import compare
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece

from haltwerk.llm import codes, phrases, piece, queries

SF = "/root/testdata/sf0.001"
RAW = open(public_tokenizers.path(piece.MODEL), "rb").read()


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_proto=RAW)


# pieces ----------------------------------------------------------------------------------------


def _texts():
    rng = random.Random(3)
    yield from ["", " ", "  a  b", "a\nb", "▁x ▁ y", "▁", "▁▁ ", " ▁", "<s>hi</s>", "<0x41>", "​\x00a", "ﬁ １ é é", " " * 1000, "a" * 5000, "ab" * 3000 + " c"]
    for _ in range(400):
        yield "".join(rng.choice("ab  th eing\né日\U0001f600▁.") for _ in range(rng.randint(1, 90)))
        yield "".join(chr(rng.choice([rng.randint(32, 126), rng.randint(0, 0x2FFF), rng.randint(0x10000, 0x1FFFF)])) for _ in range(40))


def test_pieces_equal_the_library(library, texts):
    coder = piece.PieceBpe(RAW, check=True)
    for text in [*_texts(), *filter(None, texts.values())]:
        ids = library.encode(text)
        assert coder.encode(text) == ids
        assert coder.decode(ids).decode() == library.decode(ids)
    coder.compare()
    assert not coder.differs


def test_a_full_cache_loses_no_word_of_the_texts_at_hand(monkeypatch, library):
    monkeypatch.setattr(piece, "CACHE", 40)
    coder, alone = piece.PieceBpe(RAW, check=True), []
    new = coder._new
    monkeypatch.setattr(coder, "_new", lambda word: (alone.append(word), new(word))[1])
    for k in range(0, 200, 10):
        texts = [" ".join(f"word{i} common text" for i in range(k, k + 30)), "", " common"]
        for text, (n, decimals, back) in zip(texts, coder.coded_all(texts), strict=True):
            ids = library.encode(text)
            assert (n, decimals, back) == (len(ids), ",".join(map(str, ids)), text.encode())
    coder.compare()
    assert not alone and not coder.differs


def test_a_full_cache_keeps_the_words_of_the_texts_at_hand(monkeypatch, library):
    monkeypatch.setattr(piece, "CACHE", 40)
    coder, learnt = piece.PieceBpe(RAW, check=True), []
    learn = coder.learn
    monkeypatch.setattr(coder, "learn", lambda words: (learnt.append(set(words)), learn(words))[1])
    first = " ".join(f"word{i}" for i in range(50))
    for text in (first, first + " more\nwords 日\U0001f600"):
        ids = library.encode(text)
        assert list(coder.coded_all([text])) == [(len(ids), ",".join(map(str, ids)), text.encode())]
    coder.compare()
    assert len(learnt[0]) == 50 and learnt[1] == {"▁more\nwords", "▁日\U0001f600"} and not coder.differs


def test_a_worker_keeps_its_coder(spark):
    make = piece._coder(spark, None, True)

    def known(batches):
        for batch in batches:
            coder = make()
            yield pa.RecordBatch.from_arrays([pa.array([len(coder._cache)] * batch.num_rows, pa.int64())], names=["n"])
            list(coder.encode_all(["some words"]))

    met = [r.n for r in spark.range(0, 64, 1, 64).mapInArrow(known, "n long").collect()]
    assert len(met) == 64 and set(met) == {0, 2}


def test_any_ids_decode_as_in_the_library(library):
    coder, rng = piece.PieceBpe(RAW), random.Random(5)
    for _ in range(500):
        ids = [rng.choice([rng.randrange(32000), rng.randrange(3, 259), rng.randrange(3)]) for _ in range(rng.randint(0, 12))]
        assert coder.decode(ids).decode() == library.decode(ids)


def test_long_texts_go_in_blocks(monkeypatch, library):
    coder, text = piece.PieceBpe(RAW), "one two  three\nfour " * 50
    monkeypatch.setattr(piece, "WORDS", 7)
    assert coder.encode(text) == library.encode(text)


def test_unused_pieces_go_back_to_their_parts():
    coder = piece.PieceBpe(RAW)
    coder._unused = {"▁the", "he"}
    # "▁the" was made of "▁t" and "he", and "he" of "h" and "e".
    assert coder._split("▁the") == ["▁t", "h", "e"]


def test_a_wrong_word_is_noted(spark):
    coder = piece.PieceBpe(RAW, check=True)
    coder.encode("right wrong")
    coder._fresh = [(w, ids if w != "▁wrong" else (1,)) for w, ids in coder._fresh]
    coder.compare()
    assert coder.differs == {"▁wrong"}


def test_other_models_are_refused():
    with pytest.raises(ValueError):
        piece.PieceBpe(RAW + b"\x1a\x02\x20\x01")  # the normaliser removes spaces


def test_pieces_of_odd_rows(spark, odd, none, library):
    got = sorted(map(tuple, piece.piece_digests(odd).collect()), key=str)
    want = []
    for r in odd.collect():
        ids = library.encode(r.text or "")
        back = library.decode(ids).encode()
        want.append((r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(back).hexdigest(), len(back), True))
    assert got == sorted(want, key=str)
    assert piece.piece_digests(none).isEmpty()


def test_pieces_round_trip(spark, odd):
    back = piece.piece_decode(piece.piece_encode(odd))
    assert sorted((r.doc_id, r.text) for r in back.collect() if r.doc_id) == sorted((r.doc_id, r.text or "") for r in odd.collect() if r.doc_id)


# codes -----------------------------------------------------------------------------------------


@pytest.mark.parametrize(("n", "m", "d"), [(1, 1, 3), (5, 3, 2), (100, 16, 8), (700, 7, 4), (300, 16, 1)])
@pytest.mark.parametrize("spread", [1, 3, 100_000])
def test_nearest_equals_all_pairs(n, m, d, spread):
    rng = np.random.default_rng(n + spread)
    x = rng.integers(-spread, spread + 1, (n, d))
    entries = x[rng.integers(0, n, m)]
    tree = codes.Tree.built(x, 4)
    label, total, count, _ = codes.nearest(tree, entries)
    want = ((tree.points[:, None] - entries[None]) ** 2).sum(2).argmin(1)
    sums = np.zeros_like(entries)
    np.add.at(sums, want, tree.points)
    assert (label == want).all() and (total == sums).all() and (count == np.bincount(want, minlength=m)).all()


def test_clusters_are_assigned_as_wholes():
    rng = np.random.default_rng(1)
    centres = rng.integers(-10_000, 10_000, (8, 4))
    x = np.repeat(centres, 100, axis=0) + rng.integers(-5, 6, (800, 4))
    *_, compared = codes.nearest(codes.Tree.built(x, 8), centres)
    assert compared < 100


def _brute(rows):
    """Codes by all distances; rows in any order."""
    rows = [r for r in rows if r[1] is not None and all(v is not None and np.isfinite(v) for v in r[1])]
    if not rows:
        return [], None
    x = np.array([[int(np.floor(4096 * v)) for v in r[1]] for r in rows], dtype=np.int64)
    x = x.reshape(len(rows), 8, -1)
    first = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, rows[i][1]))[:16]
    books = x[first].transpose(1, 0, 2).copy()
    away = lambda p: ((x[:, p, None] - books[p][None]) ** 2).sum(2)
    for _ in range(6):
        for p in range(8):
            label = away(p).argmin(1)
            for e in set(label.tolist()):
                books[p, e] = x[label == e, p].sum(0) // (label == e).sum()
    last = [away(p) for p in range(8)]
    code = ["".join(f"{last[p][i].argmin():02x}" for p in range(8)) for i in range(len(rows))]
    error = [int(sum(last[p][i].min() for p in range(8))) for i in range(len(rows))]
    by_label = Counter()
    for r, e in zip(rows, error, strict=True):
        by_label[r[2]] += e
    text = hashlib.sha256(",".join(str(v) for v in books.ravel().tolist()).encode()).hexdigest()
    return [(r[0], c, e, by_label[r[2]], text, r[2]) for r, c, e in zip(rows, code, error, strict=True)], text


VECTORS = "vec_id long, embedding array<float>, label int, trees string, salt int, code string"


def _vectors(spark, rows):
    return spark.createDataFrame([(*r, "t", 1, "c") for r in rows], VECTORS)


def _odd_vectors():
    rng = random.Random(9)
    rows = [(i, [rng.uniform(-2, 2) for _ in range(16)], i % 3) for i in range(60)]
    rows += [(0, rows[0][1], 0), (7, rows[3][1], None), (None, rows[5][1], None), (None, None, None), (61, None, 1)]
    rows += [(62, [None] + [0.0] * 15, 1), (63, [float("nan")] + [0.0] * 15, 1), (64, [float("inf")] + [0.0] * 15, 1), (65, [-float("inf")] * 16, 1)]
    return rows + [(100 + i, [0.25] * 16, 5) for i in range(40)]


def test_codes_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(codes, "BLOCK", 16)
    df = _vectors(spark, _odd_vectors()).repartition(3)
    rows = [(r.vec_id, r.embedding, r.label) for r in df.collect()]
    want, _ = _brute(rows)
    assert sorted(map(tuple, codes.code_vectors(df).collect()), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("n", [0, 1, 5])
def test_codes_of_few_rows(spark, n):
    rows = [(i, [0.5 * i] * 8, None) for i in range(n)]
    got = codes.code_vectors(_vectors(spark, rows))
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256", "label"]
    assert sorted(map(tuple, got.collect())) == sorted(_brute(rows)[0])


def test_codes_refuse_what_they_cannot_state(spark):
    for rows in ([(1, [1.0] * 7, 1)], [(1, [1.0] * 8, 1), (2, [1.0] * 16, 1)], [(1, [3e30] * 8, 1)]):
        with pytest.raises(Exception, match="equal parts|another length|too large"):
            codes.code_vectors(_vectors(spark, rows)).collect()


# phrases ---------------------------------------------------------------------------------------


def _pieces(text):
    for part in re.split(r"[.,;:!?\x0A-\x0D]", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")):
        if words := re.findall(r"[^\x20\x09]+", part):
            yield words


def _frequencies(rows, longest):
    f = defaultdict(Counter)
    for text, lang in rows:
        for words in _pieces(text):
            for n in range(1, longest + 1):
                f["und" if lang is None else lang].update(" ".join(words[i : i + n]) for i in range(len(words) - n + 1))
    return f


def _collocations(rows, longest=3, least=10, share=50, top=2000):
    out = []
    for lang, f in _frequencies(rows, longest).items():
        total = sum(c for p, c in f.items() if " " not in p)
        found = {p: a for p, a in f.items() if " " in p and a >= least}
        gone = set()
        for p, a in found.items():
            w = p.split(" ")
            for i in range(len(w)):
                for j in range(i + 2, len(w) + 1):
                    inner = " ".join(w[i:j])
                    if j - i < len(w) and 100 * a >= share * found.get(inner, 10**18):
                        gone.add(inner)
        scored = []
        for p, a in found.items():
            if p in gone:
                continue
            w = p.split(" ")
            cuts = [(1_000_000 * a * a // (f[" ".join(w[:k])] * f[" ".join(w[k:])]), k) for k in range(1, len(w))]
            s, k = min(cuts)
            scored.append((-s, -a, p.encode(), f[" ".join(w[:k])], f[" ".join(w[k:])]))
        for rank, (s, a, p, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, total, -s))
    return sorted(out)


@pytest.mark.parametrize("every", [1, 3, 16])
@pytest.mark.parametrize("overlap", [1, 2, 4])
def test_chunks_hold_every_start_once(every, overlap):
    rng = random.Random(every)
    for n in (0, 1, 2, 50):
        words = phrases.words_of(" ".join(rng.choice(["a", "b", "c.", "Ä!?"]) for _ in range(n)))
        chunks = [c.split(b" ") for c in phrases.cut(words, overlap, every)]
        assert [w for c in chunks for w in c[:-overlap]] == words
        closed = words + [phrases.STOP] * overlap
        at = 0
        for c in chunks:
            assert closed[at : at + len(c)] == c
            at += len(c) - overlap


def test_words_and_pieces():
    assert phrases.words_of("A b.\n C\t É, ,d;") == [b"a", b"b", b",", b"c", "É".encode(), b",", b",", b"d", b","]  # an empty piece stays


@pytest.fixture(scope="module")
def repeated():
    rng = random.Random(11)
    langs = ["en", None, "und", "de"]
    rows = []
    for i in range(120):
        some = ["new", "york", "city", "the", "of", "É", "x_%s" % rng.randrange(5), "a,b", "New", "end."]
        rows.append((" ".join(rng.choice(some) for _ in range(rng.randrange(40))), langs[i % 4]))
    return rows + [("new york city " * 500, "en"), (None, None), ("", "fr"), (" .,\t\n", "de"), ("a" * 100_000, "en")] + [rows[0]] * 30


def test_collocations_equal_brute_force(spark, repeated, monkeypatch):
    monkeypatch.setattr(phrases, "TOGETHER", 500)
    monkeypatch.setattr(phrases, "BUCKET_BYTES", 1 << 12)
    df = spark.createDataFrame([(t, g, 1, "p") for t, g in repeated], "text string, lang string, a int, phrase string").repartition(5)
    for options in ({}, {"longest": 2}, {"longest": 4, "least": 3, "share": 30, "top": 7}):
        assert sorted(map(tuple, phrases.collocations(df, **options).collect())) == _collocations(repeated, **options)


def test_collocations_of_nothing(spark, odd, none):
    assert phrases.collocations(none).isEmpty()
    want = _collocations([(r.text, r.lang) for r in odd.collect()])
    assert sorted(map(tuple, phrases.collocations(odd).collect())) == want


def test_counts_past_64_bits_stay_exact(spark, monkeypatch):
    """a = 5e9 gives products of 2.5e25."""
    big = [("en", None, 0, 10**10), ("en", "x", 1, 6_000_000_001), ("en", "y", 1, 5_000_000_003), ("en", "x y", 2, 4_999_999_999)]
    monkeypatch.setattr(phrases, "phrase_counts", lambda *_: spark.createDataFrame(big, "lang string, phrase string, size long, f long"))
    (row,) = phrases.collocations(None).collect()
    assert row.score == 1_000_000 * 4_999_999_999**2 // (6_000_000_001 * 5_000_000_003)


# queries ---------------------------------------------------------------------------------------


@pytest.mark.parametrize("name", ["op12_vector_codes", "op13_collocations"])
def test_query_equals_sql(spark, name):
    assert compare.difference(spark, compare.connect(SF), queries.queries()[name], queries.oracle_sql()[name], SF) is None
