"""Phrase collocations by prefix-free parsing: texts are cut where their content says so, and phrases are counted in distinct chunks."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged, text_of

UNKNOWN = "und"
#: A chunk ends at one of so many places, on average.
EVERY = 16
#: Words of chunks that a task counts at a time.
TOGETHER = 1_000_000
#: Text bytes for each bucket of counts; bounds what is merged at once.
BUCKET_BYTES = 4 << 20
MOST_TASKS = 100_000
#: Shares of a frequent part's lookups, and of a language's candidates before the last ranking.
SALTS = 16
#: Stands for the end of a piece among the words of a chunk; no word holds it.
STOP = b","
# Fixed value: what ends a piece.
_ENDS = b".,;:!?\n\x0b\x0c\r"
_TO_STOP = bytes.maketrans(_ENDS, STOP * len(_ENDS))
_ONE = np.uint64(1)


def words_of(text: str) -> list[bytes]:
    """The words in lower case (A-Z), with STOP between pieces."""
    spaced = text.encode().lower().translate(_TO_STOP).replace(STOP, b" , ")
    while b",  ," in spaced:
        spaced = spaced.replace(b",  ,", STOP)
    return spaced.split()


def cut(tokens: list[bytes], overlap: int, every: int) -> list[bytes]:
    """Chunks of a text's words: one starts wherever the hash of the next ``overlap`` words says so, and reaches to the end of the next such window.

    Neighbours share just that window, so each phrase of up to overlap + 1 words starts before the last ``overlap`` words of one chunk only.
    The text is closed with STOPs, so that the last chunk is like any other.
    """
    if not tokens:
        return []
    tokens = tokens + [STOP] * overlap
    hashed = np.fromiter(map(zlib.crc32, tokens), np.uint64, len(tokens))
    window = np.zeros(len(tokens) - overlap + 1, np.uint64)
    for k in range(overlap):
        window = window * np.uint64(0x9E3779B97F4A7C15) + hashed[k : k + len(window)] + _ONE
    window ^= window >> np.uint64(29)
    window *= np.uint64(0xBF58476D1CE4E5B9)
    starts = np.nonzero((window >> np.uint64(32)) % np.uint64(every) == 0)[0]
    last = len(window) - 1  # the closing window
    starts = np.r_[0, starts[(starts > 0) & (starts < last)], last].tolist()
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1)
    closed = b" ".join(tokens)
    begin = ends - np.diff(ends, prepend=0)
    return [closed[begin[a] : ends[b + overlap - 1] - 1] for a, b in zip(starts[:-1], starts[1:], strict=True)]


def _chunks(overlap: int, every: int):
    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, langs = [], []

            def rows() -> pa.RecordBatch:
                out = pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(np.repeat(*np.array(langs, np.int64).T))), pa.array(found, pa.binary()).cast(pa.string())], names=["lang", "chunk"])
                found.clear()
                langs.clear()
                return out

            for i in range(len(batch)):
                parts = cut(words_of(batch.column(1)[i].as_py()), overlap, every)
                for at in range(0, len(parts), 1 << 15):
                    found += parts[at : at + (1 << 15)]
                    langs.append((i, min(1 << 15, len(parts) - at)))
                    if len(found) >= 1 << 15:
                        yield rows()
            if found:
                yield rows()

    return chunks


def _sums(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(distinct keys ascending, sum of the weights of each, one place of each, index of each place's key)."""
    order = np.argsort(keys)
    held = keys[order]
    first = np.r_[True, held[1:] != held[:-1]] if len(held) else np.zeros(0, bool)
    at = np.nonzero(first)[0]
    index = np.empty(len(keys), np.int64)
    index[order] = np.cumsum(first) - 1
    return held[at], np.add.reduceat(weights[order], at) if len(at) else weights[:0], order[at], index


def _tables(held: list[pa.RecordBatch], longest: int, overlap: int, buckets: int) -> Iterator[tuple]:
    """Counts of all phrases in some chunks, in rows (bucket, langs, runs, phrases, counts), sorted so that they pack well."""
    rows = pa.Table.from_batches(held)
    langs = rows.column("lang").combine_chunks().dictionary_encode()
    lists = pc.split_pattern(rows.column("chunk").combine_chunks(), " ")
    coded = lists.flatten().dictionary_encode()
    names = coded.dictionary.to_numpy(zero_copy_only=False)
    by_name = np.argsort(pc.array_sort_indices(coded.dictionary).to_numpy())  # rank of each word in byte order
    words = coded.dictionary.take(pa.array(np.argsort(by_name)))
    code = by_name[coded.indices.to_numpy()]
    stop = next((by_name[i] for i, w in enumerate(names) if w == STOP.decode()), -1)
    hashed = np.fromiter((zlib.crc32(w.encode()) for w in words.to_pylist()), np.uint64, len(words))
    size = np.diff(lists.offsets.to_numpy())
    weight = np.repeat(rows.column("n").to_numpy(), size)
    lang = np.repeat(langs.indices.to_numpy().astype(np.int64), size)
    # A phrase counts where it starts, and the shared window at a chunk's end starts the next one.
    place = np.arange(len(code))
    place = place[place < np.repeat(np.cumsum(size) - overlap, size)]
    place = place[code[place] != stop]
    spelt = code[:, None]
    key = lang[place] * len(words) + code[place]
    for n in range(1, longest + 1):
        distinct, count, at, index = _sums(key, weight[place])
        spelt = [code[place[at] + k] for k in range(n)]
        bucket = np.zeros(len(at), np.uint64)
        for c in spelt:
            bucket = (bucket + hashed[c] + _ONE) * np.uint64(0x9E3779B97F4A7C15)
            bucket ^= bucket >> np.uint64(32)
        bucket = (bucket % np.uint64(buckets)).astype(np.int64)
        text = pc.binary_join_element_wise(*(words.take(pa.array(c)) for c in spelt), " ")
        yield from _packed(bucket, lang[place[at]], langs.dictionary, text, count)
        if n < longest:
            goes_on = code[place + n] != stop
            place = place[goes_on]
            key = index[goes_on] * len(words) + code[place + n]


def _packed(bucket: np.ndarray, lang: np.ndarray, langs: pa.Array, text: pa.Array, count: np.ndarray) -> Iterator[tuple]:
    # One number for bucket, language and place; inside a bucket and language, phrases stay in order.
    order = np.sort((bucket * len(langs) + lang) * len(bucket) + np.arange(len(bucket))) % max(len(bucket), 1)
    bucket, lang, count, text = bucket[order], lang[order], count[order].astype("<i8"), text.take(pa.array(order))
    edges = np.r_[np.nonzero(np.diff(bucket, prepend=-1))[0], len(bucket)]
    lists = pa.LargeListArray.from_arrays(pa.array(edges), text.cast(pa.large_string()))
    joined = pc.binary_join(lists, pa.scalar("\n", pa.large_string()))
    for i, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)):
        run = np.r_[np.nonzero(np.diff(lang[a:b], prepend=-1))[0], b - a]
        yield (
            int(bucket[a]),
            langs.take(pa.array(lang[a + run[:-1]])).to_pylist(),
            np.diff(run).tolist(),
            *_squeezed(joined[i].as_buffer()),
            *_squeezed(pa.py_buffer(count[a:b])),
        )


def _squeezed(raw: pa.Buffer) -> tuple[int, bytes]:
    return raw.size, pa.compress(raw, "zstd", asbytes=True)


def _whole(size: int, packed: bytes) -> pa.Buffer:
    return pa.decompress(packed, size, "zstd")


_BLOCK = pa.schema([("bucket", pa.int64()), ("langs", pa.list_(pa.string())), ("runs", pa.list_(pa.int64())), ("phrases_size", pa.int64()), ("phrases", pa.binary()), ("counts_size", pa.int64()), ("counts", pa.binary())])
_BLOCK_TYPES = "bucket long, langs array<string>, runs array<long>, phrases_size long, phrases binary, counts_size long, counts binary"


def _counted(longest: int, overlap: int, buckets: int):
    """Chunks with their frequency (lang, chunk, n) to packed counts; some words at a time."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush() -> Iterator[pa.RecordBatch]:
            rows = []
            for row in _tables(held, longest, overlap, buckets):
                rows.append(row)
                if len(rows) == 256:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _BLOCK.types, strict=True)], schema=_BLOCK)
                    rows.clear()
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _BLOCK.types, strict=True)], schema=_BLOCK)
            held.clear()

        words = 0
        for batch in batches:
            if not len(batch):
                continue
            held.append(batch)
            words += pc.sum(pc.count_substring(batch.column(1), " ")).as_py() + len(batch)
            if words >= TOGETHER:
                yield from flush()
                words = 0
        if held:
            yield from flush()

    return count


def _merged(least: int):
    """The blocks of a bucket to its phrases with at least ``least`` occurrences, and a row without phrase for each language's words."""

    def merge(blocks: pa.Table) -> pa.Table:
        langs, phrases, counts = [], [], []
        for block in blocks.drop_columns(["bucket"]).to_pylist():
            langs += [pa.repeat(pa.scalar(lang, pa.string()), run) for lang, run in zip(block["langs"], block["runs"], strict=True)]
            joined = _whole(block["phrases_size"], block["phrases"])
            text = pa.LargeStringArray.from_buffers(1, pa.py_buffer(np.array([0, joined.size], np.int64)), joined)
            phrases.append(pc.split_pattern(text, "\n").flatten().cast(pa.string()))
            counts.append(np.frombuffer(_whole(block["counts_size"], block["counts"]), "<i8"))
        rows = pa.table({"lang": pa.chunked_array(langs).combine_chunks().dictionary_encode(), "phrase": pa.chunked_array(phrases), "f": np.concatenate(counts)})
        total = rows.group_by(["lang", "phrase"], use_threads=False).aggregate([("f", "sum")])
        f = total.column("f_sum").combine_chunks()
        size = pc.add(pc.count_substring(total.column("phrase"), " "), 1).combine_chunks()
        out = pa.table({"lang": total.column("lang").cast(pa.string()), "phrase": total.column("phrase"), "size": size.cast(pa.int64()), "f": f})
        single = out.filter(pc.equal(out.column("size"), 1)).group_by("lang").aggregate([("f", "sum")])
        none = pa.table({"lang": single.column("lang"), "phrase": pa.nulls(len(single), pa.string()), "size": pa.array([0] * len(single), pa.int64()), "f": single.column("f_sum")})
        return pa.concat_tables([out.filter(pc.greater_equal(f, least)), none])

    return merge


def phrase_counts(docs: DataFrame, longest: int = 3, least: int = 10, every: int = EVERY) -> DataFrame:
    """(lang, phrase, size, f): occurrences of all phrases of 1 to ``longest`` words that occur ``least`` times or more; size 0 without phrase: all words.

    Distinct chunks with their frequencies come first (copies are counted once); each task counts the phrases of its chunks in word codes,
    and the sums of a bucket meet in one group, whose size ``BUCKET_BYTES`` bounds.
    """
    overlap = max(longest - 1, 1)
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), text_of().alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    buckets = size // BUCKET_BYTES + 1
    chunks = texts.mapInArrow(_chunks(overlap, every), "lang string, chunk string").groupBy("lang", "chunk").agg(F.count("*").alias("n"))
    blocks = chunks.mapInArrow(_counted(longest, overlap, buckets), _BLOCK_TYPES)
    # More data, more tasks; a task merges its buckets one after another.
    tasks = min(buckets, max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), buckets // 16), MOST_TASKS)
    return blocks.repartition(tasks, "bucket").groupBy("bucket").applyInArrow(_merged(least), "lang string, phrase string, size long, f long")


def _part(first: Column | int, n: Column | int) -> Column:
    """``n`` words of the list ``w`` from number ``first`` on."""
    return F.array_join(F.slice("w", first, n), " ")


def collocations(docs: DataFrame, longest: int = 3, least: int = 10, share: int = 50, top: int = 2000, every: int = EVERY) -> DataFrame:
    """The ``top`` collocations of each language of ``docs`` (text, lang).

    NULL text counts as empty, NULL lang as ``und``; repeated rows count each time; texts without words and empty tables give
    nothing; extra columns are ignored. Phrases of 2 to ``longest`` words with ``least`` occurrences or more are scored by their
    lowest-scoring cut, floor(1000000 a a / (l r)); one that stands in a longer one with ``share`` % of its occurrences goes.
    Returns lang, rank, phrase, a, l, r, n, score: score and a descending, then phrase in byte order.
    """
    if least < 1 or longest < 2:
        raise ValueError("phrases of two words or more, with one occurrence or more")
    counts = staged(phrase_counts(docs, longest, least, every), "phrase-counts")
    found = counts.where(F.col("size") >= 2).select("lang", "phrase", "size", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))

    # Phrases inside longer candidates; the most frequent longer one decides.
    inside = found.where(F.col("size") > 2).select(
        "lang",
        "a",
        F.explode(F.expr(f"flatten(transform(sequence(2, {longest - 1}), n -> transform(IF(n < size, sequence(1, CAST(size - n AS INT) + 1), CAST(array() AS ARRAY<INT>)), i -> array_join(slice(w, i, n), ' '))))" if longest > 2 else "CAST(array() AS ARRAY<STRING>)")).alias("phrase"),
    )
    covers = inside.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    left = found.join(covers, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * share)).drop("longer")

    # Every cut looks up both its parts; lookups of one part are dealt to several keys.
    cuts = left.select("lang", "phrase", "a", "size", F.explode(F.sequence(F.lit(1), (F.col("size") - 1).cast("int"))).alias("k"), "w")
    sides = cuts.select(
        "lang", "phrase", "a", "k",
        F.explode(F.array(F.struct(F.lit("l").alias("side"), _part(1, F.col("k")).alias("part")), F.struct(F.lit("r").alias("side"), _part(F.col("k") + 1, (F.col("size") - F.col("k")).cast("int")).alias("part")))).alias("s"),
    ).select("lang", "phrase", "a", "k", "s.*", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).cast("int").alias("salt"))
    known = counts.where((F.col("size") >= 1) & (F.col("size") < longest)).select("lang", F.col("phrase").alias("part"), "f", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    looked = sides.join(known, ["lang", "part", "salt"])
    cut_counts = looked.groupBy("lang", "phrase", "a", "k").agg(F.max(F.when(F.col("side") == "l", F.col("f"))).alias("l"), F.max(F.when(F.col("side") == "r", F.col("f"))).alias("r"))
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    scored = cut_counts.withColumn("square", (wide("a") * wide("a")).cast("decimal(31,0)") * F.lit(1_000_000).cast("decimal(7,0)")).withColumn("product", wide("l") * wide("r"))
    scored = scored.withColumn("score", F.expr("square div product"))
    lowest = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("m")).select("lang", "phrase", "a", "m.l", "m.r", "m.score")

    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    share_of = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    near = lowest.withColumn("near", F.row_number().over(Window.partitionBy("lang", share_of).orderBy(*order))).where(F.col("near") <= top)
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    totals = counts.where(F.col("size") == 0).groupBy("lang").agg(F.sum("f").alias("n"))
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
