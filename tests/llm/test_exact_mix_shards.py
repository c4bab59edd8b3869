"""Ops 3, 7 and 9: against SQL, and against brute force on odd rows."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import compare
import numpy as np
import pytest

from haltwerk.llm import exact, mixing, queries
from haltwerk.llm.shards import shard_by_bytes

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_query_equals_sql(spark, name):
    assert compare.difference(spark, compare.connect(SF), queries.queries()[name], queries.oracle_sql()[name], SF) is None


def test_shards_are_balanced_gapless_and_keep_small_groups_whole(docs, texts):
    got = shard_by_bytes(docs, shards=6).collect()
    assert {r.doc_id: (r.size, r.text_crc32) for r in got} == {d: (len(t.encode()) + 8, zlib.crc32(t.encode())) for d, t in texts.items()}
    slots, sizes, where = defaultdict(list), Counter(), defaultdict(set)
    for r in got:
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r.size
        where[texts[r.doc_id]].add(r.shard)
    assert set(slots) == set(range(6)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    largest = max(len(t.encode()) + 8 for t in texts.values())
    assert max(sizes.values()) - min(sizes.values()) <= 2 * largest
    small = sum(sizes.values()) / 6 * 0.02
    assert all(len(s) == 1 for t, s in where.items() if (len(t.encode()) + 8) * sum(x == t for x in texts.values()) <= small)


def test_shards_of_odd_rows_and_of_one_hot_text(spark, odd, none):
    got = shard_by_bytes(odd).collect()
    assert Counter((r.doc_id, r.size) for r in got)[(1, 21)] == 2 and len(got) == odd.count()
    assert shard_by_bytes(none).collect() == []
    hot = spark.range(2000).selectExpr("id AS doc_id", "'the same text' AS text")
    assert set(Counter(r.shard for r in shard_by_bytes(hot, shards=8).collect()).values()) == {250}


def _exact(rows):
    classes = defaultdict(list)
    for i, (d, t) in enumerate(rows):
        classes[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), d is None, d or 0, i))
    out = []
    for norm, members in classes.items():
        first = min(members)
        for _, unnamed, d, i in members:
            out.append((None if unnamed else d, None if first[1] else first[2], len(members), i == first[3], hashlib.sha256(norm.encode()).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("broadcast", [500_000, 0])
def test_exact_duplicates_of_odd_rows(odd, none, broadcast, monkeypatch):
    monkeypatch.setattr(exact, "BROADCAST", broadcast)
    got = exact.exact_duplicates(odd).drop("row").collect()
    want = _exact([(r.doc_id, r.text) for r in odd.collect()])
    # Which of two equal rows is kept cannot be told from their values.
    assert Counter(map(tuple, got)) == want
    assert exact.exact_duplicates(none).collect() == []
    kept = exact.drop_exact_duplicates(odd)
    assert kept.columns == odd.columns and kept.count() == len(set(r[4] for r in want))


def test_filters_of_parts_merge_without_loss(spark, monkeypatch):
    monkeypatch.setattr(exact, "FILTER_ROWS", 50)
    values = np.random.default_rng(5).choice([-(1 << 63), (1 << 63) - 1, 0, 1, -1, *range(10**12, 10**12 + 150)], 500).tolist()
    df = spark.createDataFrame([(v,) for v in values], "fp long").repartition(5)
    assert {(r.fp, r.n) for r in exact.repeated_fingerprints(df).collect()} == {(v, n) for v, n in Counter(values).items() if n > 1}


def _targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5.0, 2.0, 1.0)[i % 3] for i, s in enumerate(names)}
    target, free = {}, set(names)
    while free:
        rest = 1.5 * sum(sizes.values()) - sum(target.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 2 * sizes[s]}
        if not over:
            return target | share
        target |= {s: 2.0 * sizes[s] for s in over}
        free -= over
    return target


@pytest.mark.parametrize("block", [3, 64, 100_000])
def test_mix_of_odd_rows(odd, none, block):
    got = mixing.mix_sources(odd, block_words=block).collect() if block > 3 else mixing.mix_sources(odd.where("doc_id IS NULL OR doc_id <> 4"), block_words=block).collect()
    sizes, taken = Counter(), Counter()
    for r in got:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 2 * r.size
    want = _targets(sizes)
    assert all(r.target == pytest.approx(want[r.source]) and r.source_size == sizes[r.source] for r in got)
    assert all(abs(taken[s] - want[s]) < 1 + 1e-6 for s in sizes)
    assert mixing.mix_sources(none).collect() == []


def test_mix_without_words_takes_nothing(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert sorted((r.doc_id, r.target, r.taken) for r in mixing.mix_sources(df).collect()) == [(1, 0.0, 0), (2, 0.0, 0)]


def test_schedule_spreads_every_source_evenly(docs):
    _, targets, pieces = mixing.mix_schedule(docs, block_words=50)
    order = {r.slot: r.source for r in pieces.select("slot", "source").distinct().collect()}
    target = {r.source: r.target for r in targets.collect()}
    seen, total = Counter(), sum(target.values())
    # Up to the first source that is through, each has its share of any beginning of the schedule.
    for n, slot in enumerate(range(len(order) * 3 // 4), 1):
        seen[order.get(slot)] += 1
        assert all(abs(seen[s] - n * t / total) < 5 for s, t in target.items())


def test_mixed_documents_hold_the_words_taken(docs, texts):
    taken = {r.doc_id: r.taken for r in mixing.mix_sources(docs, block_words=40).collect()}
    words, reads = Counter(), defaultdict(list)
    for r in mixing.mixed_documents(docs, block_words=40).collect():
        words[r.doc_id] += len(WORD.findall(r.text))
        reads[r.doc_id].append(r.text)
        assert r.text in texts[r.doc_id] and r.n_chars == len(r.text)
    assert words == Counter({d: n for d, n in taken.items() if n})
    assert all(sum(t == texts[d] for t in ts) >= len(ts) - 1 for d, ts in reads.items())


@pytest.mark.parametrize("share", [0.3, 0.8, 1.0])
def test_groups_that_fit_a_shard_stay_whole(spark, share):
    """Groups of a part of a shard's bytes among many small texts; slots are gapless and shards near equal."""
    small = [(i, f"{i:0100d}") for i in range(2400)]
    each = int(share * 2400 / 8 / 2)  # two thirds of all rows are small ones
    groups = [(10_000 + 1000 * g + i, f"{g}" * 100) for g in range(3) for i in range(each)]
    got = shard_by_bytes(spark.createDataFrame(small + groups, "doc_id long, text string"), shards=8).collect()
    where, sizes, slots = defaultdict(set), Counter(), defaultdict(list)
    for r in got:
        sizes[r.shard] += r.size
        slots[r.shard].append(r.slot)
        if r.doc_id >= 10_000:
            where[(r.doc_id - 10_000) // 1000].add(r.shard)
    assert len(got) == len(small) + len(groups) and len(where) == 3 and all(len(x) == 1 for x in where.values())
    assert max(sizes.values()) <= 1.03 * min(sizes.values()) and len(sizes) == 8
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


def test_large_groups_that_do_not_add_up(spark):
    """Five groups, each of three quarters of a shard, for four shards: all stay whole."""
    rows = [(g * 1000 + i, f"{g}" * 50) for g in range(5) for i in range(60)] + [(9000 + i, f"{i:050d}") for i in range(100)]
    got = shard_by_bytes(spark.createDataFrame(rows, "doc_id long, text string"), shards=4).collect()
    where = defaultdict(set)
    for r in got:
        where[r.doc_id // 1000 if r.doc_id < 9000 else r.doc_id].add(r.shard)
    assert all(len(x) == 1 for x in where.values()) and {r.shard for r in got} == set(range(4))


def test_slots_are_bounded_by_need(spark):
    """A source of ten words among a billion, and many small ones: no more than twice the slots that are used."""
    for words in ([10, 10**9], [10**9, 10, 1, 8192, 8193, 3 * 10**6], [10**13, 1], [10**9] + [5] * 1000):
        plan = spark.createDataFrame([(f"s{i:04d}", w) for i, w in enumerate(words)], "source string, whole_target long")
        blocks = sum(-(-w // mixing.BLOCK_WORDS) for w in words)
        assert blocks <= mixing._stretches(plan, mixing.BLOCK_WORDS)[1] <= 2 * blocks
    words = [10**9, 10, 1, 8192, 8193, 3 * 10**6, None]
    plan = spark.createDataFrame([(f"s{i}" if w else None, w or 5) for i, w in enumerate(words)], "source string, whole_target long")
    got = Counter(r.source for r in mixing._slots(plan, mixing.BLOCK_WORDS).select("source").collect())
    assert got == {f"s{i}" if w else None: -(-(w or 5) // mixing.BLOCK_WORDS) for i, w in enumerate(words)}


def test_points_are_exact_far_out(spark):
    from fractions import Fraction

    ids = [0, 1, 10**6, 10**10, 10**12]
    whole = lambda c: c.cast("decimal(19,0)")
    F = mixing.F
    turned = F.pmod(whole(F.col("id") + 1) * whole(F.lit(mixing.GOLDEN)), whole(F.lit(mixing.UNIT))).cast("double") / float(mixing.UNIT)
    got = spark.createDataFrame([(i,) for i in ids], "id long").select(turned.alias("x")).collect()
    assert [r.x for r in got] == [float(Fraction((i + 1) * mixing.GOLDEN % mixing.UNIT, mixing.UNIT)) for i in ids]


def test_a_source_without_its_slots_fails(spark, monkeypatch):
    stretches = mixing._stretches
    monkeypatch.setattr(mixing, "_stretches", lambda *a: (stretches(*a)[0], 50))
    with pytest.raises(RuntimeError, match="slots"):
        mixing._slots(spark.createDataFrame([("a", 10**6)], "source string, whole_target long"), mixing.BLOCK_WORDS)


def test_the_mix_carries_its_slots(docs):
    rows = mixing.mixed_documents(docs, slot="slot", block_words=40).collect()
    by_source = defaultdict(list)
    for r in rows:
        by_source[r.source].append(r.slot)
    n = max(r.slot for r in rows)
    # Each source's reads are spread over the whole mix.
    assert all(min(x) < 0.2 * n + 50 and max(x) > 0.5 * n for x in by_source.values() if len(x) > 20)
    slots = {r.doc_id: (r.first_slot, r.n_slots, r.taken) for r in mixing.mix_sources(docs, block_words=40).collect()}
    assert all((first is None) == (taken == 0) and (n > 0) == (taken > 0) for first, n, taken in slots.values())


@pytest.mark.parametrize("bits", [8, 20, 58])
@pytest.mark.parametrize("n", [1, 2, 300, 5000])
def test_quotient_filters_lose_nothing(n, bits):
    """Read back from slots and bits, packed and merged; crowded homes included."""
    rng = np.random.default_rng(n + bits)
    values = rng.integers(0, 1 << bits, n, dtype=np.uint64)
    values[: n // 2] >>= np.uint64(min(bits - 1, 12))  # many of one quotient
    parts = [p for p in np.array_split(values, 3) if len(p)]
    built = [exact.QuotientFilter.of(*np.unique(p, return_counts=True), bits) for p in parts]
    again = [exact.QuotientFilter.unpacked(bits, *f.packed()) for f in built]
    whole, once = exact.merged(again), exact.QuotientFilter.of(*np.unique(values, return_counts=True), bits)
    for f, p in [*zip(built, parts), *zip(again, parts), (whole, values)]:
        keys, counts = f.items()
        assert dict(zip(keys.tolist(), counts.tolist())) == Counter(p.tolist()) and (np.diff(keys.astype(object)) > 0).all()
    assert whole.packed() == once.packed()


def test_equal_pages_are_spread_over_archives(spark, tmp_path):
    from haltwerk.llm import warc

    pages = spark.range(0, 400, 1, 4).selectExpr("7L AS page_id", "'u' AS url", "repeat('x', 1000) AS html")
    files = warc.write_arc(pages, str(tmp_path / "arc"), archive_bytes=100_000)
    sizes = [r.n for r in spark.read.text(str(tmp_path / "arc"), wholetext=True).selectExpr("length(value) AS n").collect()]
    assert files > 3 and len(sizes) == files and max(sizes) < 2 * sum(sizes) / files
