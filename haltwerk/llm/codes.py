"""Product codes of vectors: one codebook for each part, fitted by rounds of exact integer Lloyd over two trees."""

from __future__ import annotations

import hashlib
import io
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Vectors of one block, whose trees are built once and kept in the staged table, and parts of one leaf.
BLOCK, LEAF = 4096, 8
#: Copies of a label's total, so that the rows of a frequent label are dealt to as many keys.
SALTS = 16


@dataclass
class Tree:
    """A balanced tree over one part of a block's vectors, in level order from node 1 on: boxes, sums, and the span of each node in ``order``."""

    order: np.ndarray
    points: np.ndarray  # (n, d) in tree order
    low: np.ndarray  # (nodes, d)
    high: np.ndarray
    total: np.ndarray
    start: np.ndarray
    stop: np.ndarray

    @classmethod
    def built(cls, points: np.ndarray, leaf: int) -> Tree:
        n = len(points)
        depth = max(0, int(np.ceil(np.log2(max(n, 1) / leaf))))
        nodes = 2 << depth
        order, start, stop = np.arange(n), np.zeros(nodes, np.int64), np.zeros(nodes, np.int64)
        stop[1] = n
        for node in range(1, nodes >> 1):
            a, b = start[node], stop[node]
            middle = (a + b) // 2
            inside = points[order[a:b]]
            if b - a > 1:
                widest = np.argmax(inside.max(0) - inside.min(0))
                order[a:b] = order[a:b][np.argpartition(inside[:, widest], middle - a)]
            start[2 * node : 2 * node + 2] = a, middle
            stop[2 * node : 2 * node + 2] = middle, b
        points = points[order]
        low, high, total = (np.zeros((nodes, points.shape[1]), np.int64) for _ in range(3))
        for node in range(1, nodes):
            if (inside := points[start[node] : stop[node]]).size:
                low[node], high[node], total[node] = inside.min(0), inside.max(0), inside.sum(0)
        return cls(order, points, low, high, total, start, stop)

    def is_leaf(self, node: np.ndarray) -> np.ndarray:
        return node >= len(self.start) >> 1


def nearest(tree: Tree, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(entry of each point in tree order, sums and counts of each entry, how many points were compared one by one).

    Pairs of a point node and an entry node are followed from both roots. The largest distance to some entry node
    bounds a point node's nearest entry; pairs whose least distance is above that bound go. A point node with one entry left is assigned as a
    whole with its cached sum; what is left at a leaf is compared in integers, ties to the lower index.
    """
    book = Tree.built(entries, 1)
    n, m = len(tree.points), len(entries)
    label, total, count = np.zeros(n, np.int64), np.zeros(entries.shape, np.int64), np.zeros(m, np.int64)
    pn, en = np.array([1]), np.array([1])
    open_p, open_e = [], []
    while len(pn):
        gap = np.maximum(np.maximum(book.low[en] - tree.high[pn], tree.low[pn] - book.high[en]), 0)
        reach = np.maximum(tree.high[pn] - book.low[en], book.high[en] - tree.low[pn])
        least, most = (gap * gap).sum(1), (reach * reach).sum(1)
        _, group = np.unique(pn, return_inverse=True)
        bound = np.full(group.max() + 1, np.iinfo(np.int64).max)
        np.minimum.at(bound, group, most)
        keep = least <= bound[group]
        pn, en, group = pn[keep], en[keep], group[keep]

        single = book.stop[en] - book.start[en] == 1
        size, singles = np.bincount(group), np.bincount(group, single)
        settled = (size == singles)[group]
        whole = settled & (size == 1)[group]
        for p, e in zip(pn[whole].tolist(), book.order[book.start[en[whole]]].tolist(), strict=True):
            label[tree.start[p] : tree.stop[p]] = e
            total[e] += tree.total[p]
            count[e] += tree.stop[p] - tree.start[p]
        last = settled & ~whole & tree.is_leaf(pn)
        open_p.append(pn[last])
        open_e.append(en[last])
        split = settled & ~whole & ~last  # point nodes that go on with the same entries
        wide = ~settled & ~single  # entry nodes that are opened
        stay = ~settled & single
        pn, en = (
            np.concatenate([2 * pn[split], 2 * pn[split] + 1, pn[wide], pn[wide], pn[stay]]),
            np.concatenate([en[split], en[split], 2 * en[wide], 2 * en[wide] + 1, en[stay]]),
        )
        there = (tree.stop[pn] > tree.start[pn]) & (book.stop[en] > book.start[en])
        pn, en = pn[there], en[there]

    pn, en = np.concatenate(open_p), book.order[book.start[np.concatenate(open_e)]]
    length = tree.stop[pn] - tree.start[pn]
    if not len(pn):
        return label, total, count, 0
    point = np.arange(length.sum()) + np.repeat(tree.start[pn] - np.r_[0, np.cumsum(length)[:-1]], length)
    entry = np.repeat(en, length)
    away = ((tree.points[point] - entries[entry]) ** 2).sum(1)
    best, first = np.full(n, np.iinfo(np.int64).max), np.full(n, m)
    np.minimum.at(best, point, away)
    ties = away == best[point]
    np.minimum.at(first, point[ties], entry[ties])
    seen = np.unique(point)
    label[seen] = first[seen]
    np.add.at(total, label[seen], tree.points[seen])
    count += np.bincount(label[seen], minlength=m)
    return label, total, count, len(seen)


def _packed(trees: list[Tree]) -> bytes:
    out = io.BytesIO()
    np.savez(out, **{f"{p}_{k}": _narrow(v) for p, tree in enumerate(trees) for k, v in vars(tree).items()})
    return out.getvalue()


def _narrow(x: np.ndarray) -> np.ndarray:
    return x.astype(np.int32) if not x.size or np.abs(x).max() < 1 << 31 else x


def _unpacked(raw: bytes, parts: int) -> list[Tree]:
    with np.load(io.BytesIO(raw)) as held:
        return [Tree(*(held[f"{p}_{k}"].astype(np.int64) for k in Tree.__dataclass_fields__)) for p in range(parts)]


def _integers(vectors: pa.ListArray, width: int, parts: int, scale: int) -> np.ndarray:
    flat = np.floor(scale * vectors.flatten().to_numpy(zero_copy_only=False))
    if len(flat) != len(vectors) * width or (len(vectors) and (np.diff(vectors.offsets.to_numpy()) != width).any()):
        raise ValueError(f"vectors of another length than {width}")
    if len(flat) and 4 * (width // parts) * np.abs(flat).max() ** 2 >= 2.0**62:
        raise ValueError("a component is too large for distances in 64 bits")
    return flat.astype(np.int64).reshape(-1, parts, width // parts)


def _blocks(width: int, parts: int, scale: int, names: list[str]):
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def block() -> pa.RecordBatch:
            rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            vectors = _integers(rows.column(2), width, parts, scale)
            trees = _packed([Tree.built(vectors[:, p], LEAF) for p in range(parts)])
            lists = [pa.ListArray.from_arrays([0, len(rows)], rows.column(i)) for i in (0, 1)]
            held.clear()
            return pa.RecordBatch.from_arrays([*lists, pa.array([trees], pa.binary())], schema=pa.schema(list(zip(names, [lists[0].type, lists[1].type, pa.binary()], strict=True))))

        for batch in batches:
            for at in range(0, len(batch), BLOCK):
                piece = batch.slice(at, BLOCK)
                if held and sum(map(len, held)) + len(piece) > BLOCK:
                    yield block()
                held.append(piece)
        if sum(map(len, held)):
            yield block()

    return blocks


def _round(books: np.ndarray):
    """Sums and counts of every entry over the blocks of a task; position -1 holds the count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, m, d = books.shape
        total, count = np.zeros((parts, m, d), np.int64), np.zeros((parts, m), np.int64)
        for batch in batches:
            for raw in batch.column(0):
                for p, tree in enumerate(_unpacked(raw.as_py(), parts)):
                    _, sums, counts, _ = nearest(tree, books[p])
                    total[p] += sums
                    count[p] += counts
        out = np.concatenate([count[:, :, None], total], axis=2)
        part, entry, position = (x.ravel() for x in np.indices(out.shape))
        used = np.repeat(count.ravel() > 0, d + 1)
        columns = (part, entry, position - 1, out.ravel())
        yield pa.RecordBatch.from_arrays([pa.array(c[used]) for c in columns], names=["part", "entry", "position", "total"])

    return run


def _coded(books: np.ndarray, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = len(books)
        for batch in batches:
            for i in range(len(batch)):
                trees = _unpacked(batch.column(2)[i].as_py(), parts)
                codes = np.zeros((len(trees[0].points), parts), np.uint8)
                error = np.zeros(len(codes), np.int64)
                for p, tree in enumerate(trees):
                    label, *_ = nearest(tree, books[p])
                    codes[tree.order, p] = label
                    error[tree.order] += ((tree.points - books[p][label]) ** 2).sum(1)
                code = [row.tobytes().hex() for row in codes]
                yield pa.RecordBatch.from_arrays([batch.column(0)[i].values, batch.column(1)[i].values, pa.array(code, pa.string()), pa.array(error)], names=names)

    return run


def digest(books: np.ndarray) -> str:
    """Digest of all entries' integers by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def fit_codebooks(blocks: DataFrame, books: np.ndarray, rounds: int) -> np.ndarray:
    """``rounds`` rounds of Lloyd over all blocks; the driver sees one sum for each entry and component."""
    for _ in range(rounds):
        sums = blocks.select("trees").mapInArrow(_round(books), "part long, entry long, position long, total long")
        sums = sums.groupBy("part", "entry", "position").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
        count = {(r.part, r.entry): int(r.total) for r in sums if r.position < 0}
        books = books.copy()
        for r in sums:
            if r.position >= 0:
                books[r.part, r.entry, r.position] = int(r.total) // count[r.part, r.entry]
    return books


def code_vectors(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """Product codes of ``vectors`` (vec_id, embedding, label), a row for each vector that is kept.

    A vector that is NULL, or holds a NULL, NaN or infinite component, is dropped. Components become floor(scale * x); vectors are
    cut into ``parts`` equal parts, and each part's codebook starts as that part of the ``entries`` rows with the least vec_id
    (NULL last; of equal ids the lesser vectors), so equal entries may occur and a table with fewer rows has fewer entries. All vectors
    must have the first one's length, a multiple of ``parts``; another length, or a component whose distances do not fit 64 bits,
    fails. Repeated rows are rows like others; NULL labels are one label; no kept row gives an empty result; extra columns are ignored.

    Returns vec_id, code (two hex digits a part), error, label_error, codebooks_sha256, label. Each task builds trees over blocks of vectors
    once; they are staged, and every round reads them.
    """
    if not 0 < entries <= 256:
        raise ValueError("an entry's index has two hex digits")
    spark = vectors.sparkSession
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    kept = vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("embedding")).where(F.col("embedding").isNotNull() & finite)
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(entries).collect()
    id_type, label_type = (kept.schema[c].dataType.simpleString() for c in ("vec_id", "label"))
    if not first:
        return spark.createDataFrame([], f"vec_id {id_type}, code string, error long, label_error long, codebooks_sha256 string, label {label_type}")
    width = len(first[0].embedding)
    if width % parts or not width:
        raise ValueError(f"{width} components cannot be cut into {parts} equal parts")
    books = _integers(pa.array([r.embedding for r in first], pa.list_(pa.float64())), width, parts, scale).transpose(1, 0, 2)

    names = ["vec_ids", "labels", "trees"]
    blocks = staged(kept.mapInArrow(_blocks(width, parts, scale, names), f"vec_ids array<{id_type}>, labels array<{label_type}>, trees binary"), "codes-blocks")
    books = fit_codebooks(blocks, np.ascontiguousarray(books), rounds)
    coded = blocks.mapInArrow(_coded(books, ["vec_id", "label", "code", "error"]), f"vec_id {id_type}, label {label_type}, code string, error long")
    coded = staged(coded, "codes-rows")
    totals = coded.groupBy("label").agg(F.sum("error").alias("label_error"))
    totals = totals.select(F.col("label").alias("of"), "label_error", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salted"))
    dealt = coded.withColumn("salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)).cast("int"))
    joined = dealt.join(totals, F.col("label").eqNullSafe(F.col("of")) & (F.col("salt") == F.col("salted")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"), "label")
