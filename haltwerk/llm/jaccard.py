"""Near-duplicate classes by an n-gram Jaccard join over prefix trees."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import keep_rows, row_key, staged, text_of
from .components import components
from .shingles import BITS, shingle_set
from .trie import links_in_trie

#: Shingles in one row of sets, and rows of texts it takes at most.
CHUNK_SHINGLES, CHUNK_ROWS = 1_000_000, 20_000
#: Shingles whose document counts one task makes at a time, and those it sorts at a time.
COUNTED, SORTED = 2_000_000, 400_000
#: Shingles of the sets that one tree takes; larger groups are dealt to several trees.
TREE_SHINGLES = 8_000_000
#: Sets that one tree takes.
TREE_SETS = 20_000
#: Bytes of text for each shingle, roughly; sets the number of partitions only.
BYTES_A_SHINGLE = 6


def _packed(shingles: np.ndarray) -> bytes:
    """Shingles in BITS / 8 bytes each."""
    return shingles.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : BITS // 8].tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8).reshape(-1, BITS // 8)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, : BITS // 8] = raw
    return out.view("<u8").ravel()


def set_key(shingles: np.ndarray) -> int:
    """64 bits that stand for a set: equal sets have equal keys."""
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


_SETS = "chunk long, ids array<long>, rows array<long>, sizes array<int>, keys array<long>, shingles binary"


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of many sets each: ids, sizes, keys, and the sets one after another, each sorted."""
    held: list[tuple] = []
    n = made = 0
    context = TaskContext.get()
    part = context.partitionId() if context else 0

    def row() -> pa.RecordBatch:
        keys = [x[2] for x in held]
        # The place and the content of the chunk: made anew, it has the same number.
        chunk = xxhash.xxh64_intdigest(np.array([part, made, *keys], np.int64).tobytes(), seed=1) - (1 << 63)
        columns = [[chunk], [[x[0] for x in held]], [[x[1] for x in held]], [[len(x[3]) for x in held]], [keys], [_packed(np.concatenate([x[3] for x in held]))]]
        longs = pa.list_(pa.int64())
        kinds = (pa.int64(), longs, longs, pa.list_(pa.int32()), longs, pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["chunk", "ids", "rows", "sizes", "keys", "shingles"])

    for batch in batches:
        for doc_id, key, text in zip(batch.column(0), batch.column(1), batch.column(2), strict=True):
            found = shingle_set(text.as_py().encode())
            held.append((doc_id.as_py(), key.as_py(), set_key(found), found))
            n += len(found)
            if n >= CHUNK_SHINGLES or len(held) >= CHUNK_ROWS:
                yield row()
                made += 1
                held, n = [], 0
    if held:
        yield row()


def _to_count(buckets: int):
    """Each chunk's distinct shingles, cut by ranges of their value: bucket, chunk, first bytes' differences, counts in the chunk."""
    width = -(-(1 << BITS) // buckets)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, data in zip(batch["chunk"], batch["shingles"], strict=True):
                found, counts = np.unique(_unpacked(data.as_py()), return_counts=True)
                counts = np.minimum(counts, 255).astype(np.uint8)
                where = (found // np.uint64(width)).astype(np.int32)
                used, starts = np.unique(where, return_index=True)
                ends = [*starts[1:], len(found)][: len(used)]
                steps = []
                for b, i, j in zip(used, starts, ends, strict=True):
                    step = np.diff(found[i:j], prepend=np.uint64(int(b) * width))
                    steps.append((b"4" + step.astype("<u4").tobytes()) if int(step.max()) < 1 << 32 else (b"8" + step.astype("<u8").tobytes()))
                columns = [used, np.full(len(used), chunk.as_py(), np.int64), steps, [counts[i:j].tobytes() for i, j in zip(starts, ends, strict=True)]]
                kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["bucket", "chunk", "steps", "counts"])

    return cut


def _classes(rows: pd.DataFrame) -> pd.DataFrame:
    """For each chunk's shingles of one bucket the class of their document count: 0 for one document, then its bits."""
    values = [np.cumsum(np.frombuffer(x[1:], f"<u{x[:1].decode()}"), dtype=np.uint64) for x in rows["steps"]]
    counts = [np.frombuffer(x, np.uint8) for x in rows["counts"]]
    classes = [np.empty(len(v), np.uint8) for v in values]
    # Each chunk's shingles ascend, so a range of values is a slice of each; only one range is sorted at a time.
    low, high = min(int(v[0]) for v in values), max(int(v[-1]) for v in values)
    ranges = 1 + sum(map(len, values)) // SORTED
    starts = [0] * len(values)
    for k in range(1, ranges + 1):
        bound = np.uint64(low + (high + 1 - low) * k // ranges)
        ends = [int(np.searchsorted(v, bound)) for v in values]
        cuts = [slice(i, j) for i, j in zip(starts, ends, strict=True)]
        _, at = np.unique(np.concatenate([v[c] for v, c in zip(values, cuts, strict=True)]), return_inverse=True)
        total = np.bincount(at, weights=np.concatenate([n[c] for n, c in zip(counts, cuts, strict=True)])).astype(np.int64)
        found = np.ceil(np.log2(total)).astype(np.uint8)[at]
        for own, c, part in zip(classes, cuts, np.split(found, np.cumsum([c.stop - c.start for c in cuts])[:-1]), strict=True):
            own[c] = part
        starts = ends
    return pd.DataFrame({"chunk": rows["chunk"], "bucket": rows["bucket"], "classes": [x.tobytes() for x in classes]})


_PREFIXES = "ids array<long>, rows array<long>, sizes array<int>, keys array<long>, tokens array<long>, token_keys array<long>, set_keys array<long>, sets array<binary>"


def _prefixes(percent: int):
    """Of each chunk: its rows, the prefix shingles that another document has too, and the sets that have such."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["ids", "rows", "sizes", "keys", "tokens", "token_keys", "set_keys", "sets"]
        for batch in batches:
            for r in range(batch.num_rows):
                ids, rows, sizes, keys, data, known = (batch.column(i)[r].as_py() for i in range(6))
                shingles = _unpacked(data)
                classes = np.frombuffer(b"".join(x["classes"] for x in sorted(known or (), key=lambda x: x["bucket"])), np.uint8)
                distinct, at = np.unique(shingles, return_inverse=True)
                if len(classes) != len(distinct):
                    raise ValueError("the input gave other rows when it was read again")
                classes = classes[at]
                tokens, token_keys, set_keys, sets, seen, start = [], [], [], [], set(), 0
                for size, key in zip(sizes, keys, strict=True):
                    own, rare, start = shingles[start : start + size], classes[start : start + size], start + size
                    prefix = size - -(-percent * size // 100) + 1
                    # Shingles of no other document come first and link nothing.
                    alone = int((rare == 0).sum())
                    if key in seen or alone >= prefix:
                        continue
                    seen.add(key)
                    order = np.argsort(rare, kind="stable")  # by class, then by value
                    first = own[order[alone:prefix]]
                    tokens.append(first.astype(np.int64))
                    token_keys.append(np.full(len(first), key, np.int64))
                    set_keys.append(key)
                    sets.append(_packed(own) + rare.tobytes())
                flat = lambda parts: np.concatenate(parts) if parts else np.empty(0, np.int64)
                columns = [[ids], [rows], [sizes], [keys], [flat(tokens)], [flat(token_keys)], [set_keys], [sets]]
                longs = pa.list_(pa.int64())
                kinds = (longs, longs, pa.list_(pa.int32()), longs, longs, longs, longs, pa.list_(pa.binary()))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return pick


def _joined(percent: int):
    """Links inside each tree (rows sorted by tree): tree, key, and the least key of its component there."""

    def join(keys: list[int], sets: list[bytes]) -> list[int]:
        width = BITS // 8 + 1
        split = [(_unpacked(x[: len(x) // width * (width - 1)]), np.frombuffer(x[len(x) // width * (width - 1) :], np.uint8)) for x in sets]
        values, first, at = np.unique(np.concatenate([v for v, _ in split]), return_index=True, return_inverse=True)
        rare = np.concatenate([c for _, c in split])[first]
        rank = np.empty(len(values), np.int64)
        # The common order of the tree: what most documents have comes first, so that beginnings are shared.
        rank[np.lexsort((values, -rare.astype(np.int16)))] = np.arange(len(values))
        ranks = [np.sort(x) for x in np.split(rank[at], np.cumsum([len(v) for v, _ in split])[:-1])]
        labels = links_in_trie(ranks, percent)
        least: dict[int, int] = {}
        for key, label in zip(keys, labels.tolist(), strict=True):
            least[label] = min(key, least.get(label, key))
        return [least[label] for label in labels.tolist()]

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, keys, sets = None, [], []

        def rows() -> pa.RecordBatch:
            columns = [[tree[0]] * len(keys), [tree[1]] * len(keys), keys, join(keys, sets) if keys else []]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["comp", "tree", "key", "label"])

        for batch in batches:
            for comp, part, key, data in zip(*(batch.column(i) for i in range(4)), strict=True):
                here = (comp.as_py(), part.as_py())
                if here != tree:
                    if tree:
                        yield rows()
                    tree, keys, sets = here, [], []
                keys.append(key.as_py())
                sets.append(data.as_py())
        if tree:
            yield rows()

    return walk


def _walk_trees(dealt: DataFrame, percent: int) -> DataFrame:
    """``dealt``: comp, tree, key, set. One tree for each (comp, tree)."""
    sorted_ = dealt.select("comp", "tree", "key", "set").repartition("comp", "tree").sortWithinPartitions("comp", "tree", "key")
    return sorted_.mapInArrow(_joined(percent), "comp long, tree long, key long, label long")


def _exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The shingles of each set (key, set), a row each."""
    for batch in batches:
        for key, data in zip(batch["key"], batch["set"], strict=True):
            raw = data.as_py()
            found = _unpacked(raw[: len(raw) // (BITS // 8 + 1) * (BITS // 8)]).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), key.as_py(), np.int64)), pa.array(found)], names=["key", "token"])


def _items(sets: DataFrame, percent: int) -> DataFrame:
    """(key, n, comp, label, slack, held, item, pos, before, weight): the ``sets`` as sequences of items, rarest first.

    Shingles that the same sets hold are one item, and its weight is their number: a passage that many texts share is one item, what a
    single set holds is another. ``held`` counts the holders, ``before`` sums the weights ahead, ``slack`` is how much of a set may be missing in
    another that it links with. Each sequence ends with an item of no weight that all sets have (``held`` 0).
    """
    tokens = sets.select("key", "set").mapInArrow(_exploded, "key long, token long")
    holders = tokens.groupBy("token").agg(F.count("*").alias("held"), F.bit_xor(F.xxhash64("key")).alias("x"), F.bit_xor(F.xxhash64("key", F.lit(1))).alias("y"))
    named = tokens.join(holders.select("token", "held", F.xxhash64("held", "x", "y").alias("item")), "token")
    items = named.groupBy("key", "held", "item").agg(F.count("*").alias("weight"))
    about = sets.select("key", "n", "comp", "label", (F.col("n") - F.ceil(F.col("n") * percent / 100)).alias("slack"))
    items = items.join(about, "key")
    ends = about.select("key", F.lit(0).cast("long").alias("held"), F.lit(0).cast("long").alias("item"), F.lit(0).cast("long").alias("weight"), "n", "comp", "label", "slack")
    along = Window.partitionBy("key").orderBy(F.col("held") == 0, "held", "item")
    before = F.sum("weight").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("weight")
    return items.unionByName(ends).withColumns({"pos": F.row_number().over(along), "before": before})


def _parts(n: Column, count: Column, tree_shingles: int, tree_sets: int) -> Column:
    """Parts of a group, two of which fit one tree; 1 if the whole does."""
    more = F.greatest(F.ceil(n * 2 / F.lit(tree_shingles)), F.ceil(count * 2 / F.lit(tree_sets)))
    return F.when((n <= tree_shingles) & (count <= tree_sets), 1).otherwise(more).cast("long")


def _trees_of_items(sets: DataFrame, percent: int, tree_shingles: int, tree_sets: int) -> DataFrame:
    """(comp, tree, key): trees in which any two linked ``sets`` (key, set, n, comp, label) of different labels meet.

    Two linked sets have common items; what comes before the first of them has at most the slack's weight in each, and so has all that
    is left out before the next one. So each set enters a group for each item it may have first in common, and a group that
    does not fit a tree is split by the next common item, each time for the groups that this makes cheaper than to let all pairs of parts meet.
    The other large ones, as very many sets that share all their first items, go by pairs of parts. A group of one label links nothing new.
    """
    items = staged(_items(sets, percent), "near-items")
    # ``base`` added to the slack is the weight up to which the next common item may begin.
    group = F.xxhash64("comp", "item", "held")
    start = items.where("before <= slack AND held <> 1").select(group.alias("group"), "key", "n", "label", "pos", F.col("weight").alias("base"), (F.col("held") == 0).alias("ended"))
    following = items.select("key", F.col("pos").alias("at"), "before", "weight", "slack", "held", "item")
    state, trees = start, []
    while True:
        members = (F.bit_xor(F.xxhash64("key")).alias("x"), F.bit_xor(F.xxhash64("key", F.lit(1))).alias("y"))
        about = state.groupBy("group").agg(F.sum("n").alias("total"), F.count("*").alias("count"), F.min("label").alias("low"), F.max("label").alias("high"), F.max("ended").alias("end"), *members)
        about = about.where("low < high").withColumn("parts", _parts(F.col("total"), F.col("count"), tree_shingles, tree_sets))
        # Groups with the same members are one, unless they still have to be split in different ways.
        same = F.when(F.col("parts") == 1, F.lit(0)).otherwise(F.col("group"))
        one = about.groupBy("x", "y", "count", same.alias("same")).agg(F.min("group").alias("group"))
        about = about.join(one.select("group"), "group", "left_semi").select("group", "parts", "end")
        state = staged(state.join(about, "group"), "near-groups")
        trees.append(state.where("parts = 1").select("group", "key", F.lit(0).cast("long").alias("tree")))
        over = state.where("parts > 1")
        if over.isEmpty():
            break
        on = (F.col("s.key") == F.col("f.key")) & (F.col("f.at") > F.col("s.pos")) & (F.col("f.before") <= F.col("f.slack") + F.col("s.base"))
        joined = over.where("NOT end").alias("s").join(following.alias("f"), on)
        step = joined.select(
            F.col("group").alias("of"), F.xxhash64("group", "item", "held").alias("group"), "s.key", "n", "label", F.col("at").alias("pos"),
            (F.col("base") + F.col("weight")).alias("base"), (F.col("held") == 0).alias("ended"), F.col("held").alias("holders"),
        ).where("holders <> 1")
        step = staged(step, "near-steps")
        cost = over.groupBy("group", "parts").agg(F.sum("n").alias("now")).join(step.groupBy(F.col("of").alias("group")).agg(F.sum("n").alias("next")), "group", "left")
        cheaper = cost.where(F.col("next") < F.col("now") * F.col("parts")).select("group")
        pairs = over.join(cheaper, "group", "left_anti").withColumn("part", F.pmod(F.xxhash64("key", F.lit(2)), "parts"))
        meets = F.expr("transform(sequence(0L, parts - 1), p -> least(p, part) * parts + greatest(p, part))")
        trees.append(pairs.select("group", "key", F.explode(meets).alias("tree")))
        state = step.join(cheaper.select(F.col("group").alias("of")), "of", "left_semi").drop("of", "holders")
    return reduce(DataFrame.union, trees).withColumnRenamed("group", "comp")


def _linked(sets: DataFrame, groups: DataFrame, percent: int, tree_shingles: int, tree_sets: int) -> DataFrame:
    """(key, label) under all links between ``sets`` (key, set, n) inside their ``groups`` (key, comp); the label is a component's least key.

    A group whose sets fit one tree is joined there. A larger one is dealt by hash to parts, and each part is joined with the first one, which
    brings groups of copies together; then sets of different labels meet in the trees of their items.
    """
    sets = staged(sets.join(groups, "key"), "near-sets")
    sizes = sets.groupBy("comp").agg(_parts(F.sum("n"), F.count("*"), tree_shingles, tree_sets).alias("parts"))
    sets = sets.join(sizes, "comp").withColumn("part", F.pmod(F.xxhash64("key"), F.col("parts")))
    first = F.when((F.col("parts") > 1) & (F.col("part") == 0), F.sequence(F.lit(1).cast("long"), F.col("parts") - 1)).otherwise(F.array(F.col("part")))
    near = staged(_walk_trees(sets.withColumn("tree", F.explode(first)), percent), "near-first")
    large = sets.where("parts > 1")
    if large.isEmpty():
        return near.select("key", "label")
    in_large = near.join(large.select("comp").distinct(), "comp", "left_semi")
    so_far = components(in_large.select(F.col("key").alias("a"), F.col("label").alias("b")))
    large = large.join(so_far.withColumnRenamed("node", "key"), "key", "left").withColumn("label", F.coalesce("label", "key"))
    large = staged(large.select("comp", "key", "set", "n", "label"), "near-large")
    met = _trees_of_items(large, percent, tree_shingles, tree_sets).join(large.select("key", "set"), "key")
    more = staged(_walk_trees(met, percent), "near-rest")
    edges = in_large.select("key", "label").union(more.select("key", "label"))
    closed = components(edges.select(F.col("key").alias("a"), F.col("label").alias("b"))).select(F.col("node").alias("key"), "label")
    small = near.join(large.select("comp").distinct(), "comp", "left_anti").select("key", "label")
    return small.union(closed)


def near_duplicates(docs: DataFrame, percent: int = 80, tree_shingles: int = TREE_SHINGLES, tree_sets: int = TREE_SETS) -> DataFrame:
    """The class of near-duplicates of every row of ``docs`` (doc_id, text): sets of word 5-grams of Jaccard >= ``percent`` / 100.

    1. Rows of many sets each are made and dealt once. Their shingles are counted over all documents by ranges of value, and each chunk
    gets back the class of each count: the global order is by this class, then by value.
    2. Two sets that link share a shingle among the first ones of both (the prefix that the threshold leaves). Shingles of
    one document link nothing, so only sets with a common shingle in their prefix go on; equal sets go on as one.
    3. Sets that share prefix shingles form groups; inside each the sets are stored in prefix trees (``trie``) and joined exactly. A tree takes
    ``tree_shingles`` and ``tree_sets`` at most; larger groups are split by the passages their sets have in common.
    4. A class is a component of these links.

    Shingles are BITS-bit hashes. NULL and empty texts have an empty set and are linked with nothing. Repeated rows and NULL ids are rows like
    others; a class of NULL ids only has none. An empty table gives no rows; extra columns are ignored. The input must give the same rows in
    the same order when a lost task reads it again, as files do. Returns doc_id, n_shingles, component_id (the least doc_id of the class), label (of the class), row (its key).
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key("doc_id", "text").alias("row"), text_of().alias("text"))
    size = (rows.agg(F.sum(F.octet_length("text").cast("long"))).head()[0] or 0) // BYTES_A_SHINGLE
    parts = max(12, 1 + size // COUNTED)
    dealt = rows.mapInArrow(_sets, _SETS).repartition(parts, "chunk")
    buckets = 1 + size // COUNTED
    # The sets are dealt once for both uses, if both read all columns and both sides of the join have as many partitions.
    cut = dealt.mapInArrow(_to_count(buckets), "bucket int, chunk long, steps binary, counts binary")
    classes = cut.groupBy("bucket").applyInPandas(_classes, "chunk long, bucket int, classes binary")
    classes = classes.repartition(parts, "chunk").groupBy("chunk").agg(F.collect_list(F.struct("bucket", "classes")).alias("known"))
    with_classes = dealt.join(classes.hint("shuffle_merge"), "chunk", "left").select("ids", "rows", "sizes", "keys", "shingles", "known")
    found = staged(with_classes.mapInArrow(_prefixes(percent), _PREFIXES), "prefixes")

    each = found.select(F.explode(F.arrays_zip("ids", "rows", "sizes", "keys")).alias("x"))
    each = each.select(F.col("x.ids").alias("doc_id"), F.col("x.rows").alias("row"), F.col("x.sizes").cast("long").alias("n_shingles"), F.col("x.keys").alias("key"))
    prefix = found.select(F.explode(F.arrays_zip("tokens", "token_keys")).alias("x")).select(F.col("x.tokens").alias("token"), F.col("x.token_keys").alias("key"))
    leaders = prefix.groupBy("token").agg(F.min("key").alias("leader"), F.max("key").alias("last")).where("leader < last").select("token", "leader")
    shared = prefix.join(leaders, "token").where("key <> leader").select(F.col("key").alias("a"), F.col("leader").alias("b")).distinct()
    groups = components(shared).select(F.col("node").alias("key"), F.col("label").alias("comp"))
    sets = found.select(F.explode(F.arrays_zip("set_keys", "sets")).alias("x")).select(F.col("x.set_keys").alias("key"), F.col("x.sets").alias("set"))
    sets = sets.groupBy("key").agg(F.first("set").alias("set")).withColumn("n", (F.octet_length("set") / F.lit(BITS // 8 + 1)).cast("long"))
    labels = staged(_linked(sets, groups, percent, tree_shingles, tree_sets), "near-labels")

    labelled = each.join(labels, "key", "left").withColumn("label", F.coalesce("label", "key"))
    least = labelled.where("n_shingles > 0").groupBy("label").agg(F.min("doc_id").alias("least"))
    out = labelled.join(least, "label", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("least")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), "label", "row")


def drop_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """``docs`` (doc_id, text and any others) with one row of each class: that with the least doc_id (NULL last). Rows without shingles stay."""
    found = staged(near_duplicates(docs, **options).where("n_shingles > 0").select("doc_id", "label", "row"), "near-rows")
    place = F.struct(F.isnull("doc_id").alias("unnamed"), "doc_id", "row")
    first = found.groupBy("label").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1")
    gone = found.join(first, "label").where(F.col("row") != F.col("first.row")).select("row").distinct()
    return keep_rows(docs, gone, first.select(F.col("first.row").alias("row")))
