"""Op 6 and the pipeline."""

from __future__ import annotations

import random
import re
import tracemalloc
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from haltwerk.llm import gru, jaccard, shingles
from haltwerk.llm.components import components
from haltwerk.llm.trie import links_in_trie


def _set(text, n=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if len(words) >= n else frozenset([tuple(words)] if words else [])


def _classes(sets, percent=80):
    """The least key of each key's component, all pairs that share an item looked at."""
    up = {d: d for d in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    holders = defaultdict(list)
    for d in sorted(sets):
        for e, k in Counter(e for s in sets[d] for e in holders[s]).items():
            if 100 * k >= percent * (len(sets[d]) + len(sets[e]) - k):
                a, b = root(d), root(e)
                up[max(a, b)] = min(a, b)
        for s in sets[d]:
            holders[s].append(d)
    return {d: root(d) for d in sets}


def _check(df, **options):
    sets = {r.doc_id: _set(r.text) for r in df.collect()}
    classes = _classes(sets)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(df, **options).collect()}
    assert got == {d: (len(s), classes[d]) for d, s in sets.items()}
    return classes


def test_classes_of_the_table(docs, monkeypatch):
    assert len(set(_check(docs).values())) < docs.count()
    monkeypatch.setattr(jaccard, "CHUNK_SHINGLES", 3000)
    monkeypatch.setattr(jaccard, "COUNTED", 20_000)
    _check(docs, tree_shingles=2000)


@pytest.mark.parametrize("tree", [jaccard.TREE_SHINGLES, 400])
def test_classes_of_many_close_texts(spark, tree):
    rng = random.Random(3)
    base = [" ".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 50))) for _ in range(15)]
    rows = []
    for i in range(300):
        words = rng.choice(base).split()
        for _ in range(rng.randint(0, 3)):
            if words:
                words[rng.randrange(len(words))] = rng.choice("abcdefghi")
        rows.append((i, " ".join(words)))
    _check(spark.createDataFrame(rows, "doc_id long, text string"), tree_shingles=tree, tree_sets=jaccard.TREE_SETS if tree > 400 else 20)


def test_trees_of_texts_of_common_passages_grow_with_the_rows(spark, monkeypatch):
    dealt, walk = [], jaccard._walk_trees

    def counted(rows, percent):
        dealt[-1] += rows.count()
        each = rows.join(sizes, "key").groupBy("comp", "tree").agg(F.sum("size").alias("size"), F.count("*").alias("c")).agg(F.max("size"), F.max("c")).head()
        # Parts are dealt by hash, so two may pass the bound a little.
        assert each[0] < 1.5 * 4000 and each[1] < 1.5 * 60
        return walk(rows, percent)

    monkeypatch.setattr(jaccard, "_walk_trees", counted)
    for rows in (300, 600):
        rng = random.Random(7)
        passages = [" ".join(f"w{rng.randrange(5000)}" for _ in range(20)) for _ in range(40)]
        texts = [" ".join(rng.sample(passages, 5)) for _ in range(rows)]
        texts[5] = texts[200] + " one more"
        found = [shingles.shingle_set(t.encode()) for t in texts]
        sizes = spark.createDataFrame([(jaccard.set_key(s), len(s)) for s in found], "key long, size int")
        dealt.append(0)
        classes = _check(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), tree_shingles=4000, tree_sets=60)
        assert classes[200] == 5
    assert dealt[1] < 2.5 * dealt[0] and dealt[0] < 10 * 300


def test_leaves_of_a_tree_ask_few_sets():
    """Sets with one common item: work grows with their number, and links are found."""
    rng = np.random.default_rng(5)
    sets = [np.sort(np.r_[0, 1 + rng.choice(500_000, 9, replace=False)]) for _ in range(3000)]
    sets[17] = np.sort(np.r_[sets[2000][:9], 600_000])
    values = np.unique(np.concatenate(sets))
    labels = links_in_trie([np.searchsorted(values, s) for s in sets])
    assert labels[17] == labels[2000] and len(set(labels.tolist())) == 2999


def test_classes_of_odd_rows(odd, none):
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.near_duplicates(odd).collect())
    long = len(_set("Word number one. " * 60_000))
    assert got == Counter(
        {(1, 3, 1): 2, (6, 3, 1): 1, (2, 0, 2): 1, (3, 0, 3): 1, (None, 1, 8): 1, (8, 1, 8): 1, (4, long, 4): 1, (5, 0, 5): 1, (7, 1, 7): 1, (None, 0, None): 1, (-9, 1, -9): 1}
    )
    assert jaccard.near_duplicates(none).collect() == []
    kept = jaccard.drop_near_duplicates(odd)
    assert kept.columns == odd.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([1, 2, 3, None, 4, 5, 7, 8, -9])


def test_shingles_in_pieces(texts, monkeypatch):
    whole = {d: shingles.shingle_set(t.encode()) for d, t in texts.items()}
    assert all(len(s) == len(_set(texts[d])) for d, s in whole.items())
    monkeypatch.setattr(shingles, "PIECE", 37)
    assert all((shingles.shingle_set(texts[d].encode()) == s).all() for d, s in whole.items())


def test_tree_against_all_pairs():
    rng = np.random.default_rng(1)
    for _ in range(150):
        base = [rng.choice(60, rng.integers(1, 40), replace=False).tolist() for _ in range(rng.integers(1, 5))]
        sets = set()
        for _ in range(rng.integers(1, 40)):
            own = set(base[rng.integers(len(base))])
            for _ in range(rng.integers(0, 6)):
                own ^= {int(rng.integers(60))}
            sets |= {tuple(sorted(own))} if own else set()
        ordered = sorted(sets)
        assert links_in_trie([np.array(s) for s in ordered]).tolist() == list(_classes(dict(enumerate(ordered))).values())


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, i) for i in range(1001, 1200)] + [(-5, 2000), (-5, -7), (3, 3)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(61)} | {i: 1000 for i in range(1000, 1200)} | {-5: -7, 2000: -7, -7: -7}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_pipeline_stage_by_stage(spark, docs, tmp_path):
    sf = "/root/testdata/sf0.001"
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "exact_duplicates", "near_duplicates", "mix", "tokens"]
    now = docs
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, now, sf).write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        before_rows, rows = now.collect(), after.collect()
        if name != "tokens":
            assert after.columns == docs.columns
        if name == "language":
            langs = {r.doc_id: r for r in gru.identify_language(now).collect()}
            assert {r.doc_id for r in rows} == {d for d, r in langs.items() if r.lang_pred != "und"}
        if name == "exact_duplicates":
            first = {}
            for r in sorted(before_rows, key=lambda r: (-len(r.text), r.doc_id)):
                first.setdefault(re.sub(r"[\x20\x09-\x0D]", "", r.text), r.doc_id)
            assert sorted(r.doc_id for r in rows) == sorted(first.values())
        if name == "near_duplicates":
            classes = _classes({r.doc_id: _set(r.text) for r in before_rows})
            assert sorted(r.doc_id for r in rows) == sorted(set(classes.values()))
        if name == "mix":
            words = Counter()
            for r in rows:
                words[r.source] += len(r.text.split())
            held = Counter()
            for r in before_rows:
                held[r.source] += len(r.text.split())
            assert sum(words.values()) == pytest.approx(1.5 * sum(held.values()), abs=len(held)) and all(words[s] <= 2 * held[s] for s in held)
        if name == "tokens":
            assert len(rows) == len(before_rows) and all(r.n_bytes for r in rows)
        now = after
    assert corpus_pipeline.run(spark, sf).count() == now.count()


def _counted(n, chunks=4):
    """Rows of one bucket as they are dealt: ``chunks`` of ``n`` ascending shingles each, and how many documents of a chunk have each."""
    rng, values, rows = np.random.default_rng(1), [], []
    for chunk in range(chunks):
        own = np.unique(rng.integers(0, 3 * n, n, np.uint64))
        counts = rng.integers(1, 4, len(own)).astype(np.uint8)
        values.append((own, counts))
        rows.append((chunk, 0, b"4" + np.diff(own, prepend=np.uint64(0)).astype("<u4").tobytes(), counts.tobytes()))
    return values, pd.DataFrame(rows, columns=["chunk", "bucket", "steps", "counts"])


@pytest.mark.parametrize("at_once", [1, 50, jaccard.SORTED])
def test_classes_of_counts_by_ranges(monkeypatch, at_once):
    monkeypatch.setattr(jaccard, "SORTED", at_once)
    values, rows = _counted(150)
    total = Counter()
    for own, counts in values:
        total.update(dict(zip(own.tolist(), counts.tolist(), strict=True)))
    got = jaccard._classes(rows)
    assert list(got.columns) == ["chunk", "bucket", "classes"] and got["chunk"].tolist() == rows["chunk"].tolist()
    for (own, _), found in zip(values, got["classes"], strict=True):
        assert list(found) == [int(np.ceil(np.log2(total[v]))) for v in own.tolist()]


def _most(work):
    """Bytes that ``work`` allocates at once."""
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_memory_of_counts_is_little_above_the_shingles():
    values, rows = _counted(500_000)
    n = sum(len(own) for own, _ in values)
    assert _most(lambda: jaccard._classes(rows)) < 30 * n


def test_memory_of_the_language_is_bounded_for_many_texts():
    reader = gru.Reader(gru.train(["aa bb", "cc dd"], ["x", "y"], steps=1))
    few, many = ([b"some words of a text " * 100] * n for n in (1000, 4000))
    assert _most(lambda: reader.read(many)) < 1.5 * _most(lambda: reader.read(few))
