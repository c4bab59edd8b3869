"""Main text of pages: markup says what it can, a suffix array over each host's pages finds the boilerplate of the rest."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import row_key, staged
from .html_text import MAIN, OPEN, blocks_of

#: Words that make a repeated substring long.
MIN_WORDS = 4
#: A long substring is boilerplate of a host if this share of its distinct contents has it, and SHARE_LEAST of them at least; more than half are always enough.
SHARE, SHARE_LEAST = 0.1, 10


def _host() -> Column:
    """The host of the URL in lower case; pages without one have the host NULL."""
    return F.lower(F.regexp_extract(F.coalesce(F.col("url").cast("string"), F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def _keyed(pages: DataFrame) -> DataFrame:
    columns = [F.col("page_id"), F.col("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html")]
    return pages.select(*columns, row_key("page_id", "url", "html").alias("page"), F.xxhash64(_host()).alias("host"))


def suffixes(pages: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Suffixes of the block streams of ``pages`` (host, page, html): host, page, content, pos, open, key.

    A page's stream is the hashes of its blocks, ``content`` the hash of the whole stream. A suffix is cut as soon as it has ``min_words`` words (``key`` holds the
    blocks' hashes); what is shorter to the page's end cannot start a long substring and is left out.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, page_keys, contents, positions, opens, keys = [], [], [], [], [], []
            for host, page, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                blocks = blocks_of(text)
                stream = np.array([xxhash.xxh64_intdigest(b.text) for b in blocks], np.uint64).view(np.int64)
                content, tokens = int(np.uint64(xxhash.xxh64_intdigest(stream.tobytes())).view(np.int64)), stream.tolist()
                ends = np.cumsum([b.text.count(" ") + 1 for b in blocks])
                stops = np.searchsorted(ends, np.r_[0, ends[:-1]] + min_words) + 1 if len(blocks) else []
                for pos, stop in enumerate(stops):
                    if stop <= len(blocks):
                        hosts.append(host)
                        page_keys.append(page)
                        contents.append(content)
                        positions.append(pos)
                        opens.append(any(b.role == OPEN for b in blocks[pos:stop]))
                        keys.append(tokens[pos:stop])
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.list_(pa.int64()))
            columns = [pa.array(c, k) for c, k in zip((hosts, page_keys, contents, positions, opens, keys), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=["host", "page", "content", "pos", "open", "key"])

    return pages.select("host", "page", "html").mapInArrow(cut, "host long, page long, content long, pos int, open boolean, key array<long>")


def repeated_substrings(cut: DataFrame) -> DataFrame:
    """(host, key) of the long substrings that stand in at least two, and a share of the distinct contents of a host (SHARE, SHARE_LEAST).

    The suffixes of all hosts are sorted as one array: dealt by ranges of (host, suffix, content, page), so a substring that a third
    of all pages share is sorted by several tasks, and sorted inside each range. Neighbours that agree over their whole cut length are one
    stretch of the array; a stretch leaves its first and last content and how many are between. A stretch that a range's border cuts leaves
    several, which meet in one group; only their ends can be the same. Copies of a page are one content. A page that is too short to hold a
    long substring does not count.
    """
    order = ("host", "key", "content", "page")
    array = cut.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).select("host", "key", "content")

    def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, border = None, True  # what a border may cut leaves with any count
        for batch in batches:
            out = []
            for host, key, content in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if held and held[0] == host and held[1] == key:
                    if held[3] != content:
                        held[3], held[4] = content, held[4] + 1
                else:
                    if held and (border or held[4] > 1):
                        out.append(held)
                    border = held is None
                    held = [host, key, content, content, 1]
            yield _stretch_rows(out)
        if held:
            yield _stretch_rows([held])

    found = array.mapInArrow(stretches, "host long, key array<long>, first long, last long, n long")
    ends = F.size(F.array_union(F.collect_set("first"), F.collect_set("last")))
    found = found.groupBy("host", "key").agg((F.sum(F.greatest(F.col("n") - 2, F.lit(0))) + ends).alias("held")).where("held > 1")
    hosts = cut.where("pos = 0").groupBy("host").agg(F.count_distinct("content").alias("contents"))
    enough = F.least(F.floor(F.col("contents") / 2) + 1, F.greatest(F.lit(SHARE_LEAST), F.ceil(F.col("contents") * F.lit(SHARE))))
    return found.join(hosts, "host").where(F.col("held") >= enough).select("host", "key")


def _stretch_rows(rows: list[list]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.int64())
    columns = zip(*rows, strict=True) if rows else [()] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["host", "key", "first", "last", "n"])


def extract_main_text(pages: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The main text of every row of ``pages`` (page_id, url, html).

    Blocks of an article stay, however often they are repeated elsewhere; blocks that the markup marks as something else go. On
    pages whose markup marks no article, blocks that a long substring repeated on a share of the host's distinct contents covers go and
    the other runs stay, so copies of one article do not erase each other; if nothing would stay, all stays. NULL or empty html: empty text. Repeated rows are one
    page of the array and each get their result. Pages without a host are one host. Extra columns are ignored; an empty table
    gives no rows. Returns page_id, url, text (blocks joined by two line feeds), n_chars (code points), n_repeated (blocks removed as repeated).
    """
    keyed = _keyed(pages)
    cut = staged(suffixes(keyed, min_words), "suffixes")
    repeated = repeated_substrings(cut)
    # Only pages with blocks that the markup leaves open need to know.
    covered = cut.where("open").join(repeated, ["host", "key"]).select("page", F.explode(F.sequence(F.col("pos"), F.col("pos") + F.size("key") - 1)).alias("at"))
    covered = staged(covered.groupBy("page").agg(F.sort_array(F.collect_set("at")).alias("covered")), "covered")

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, sizes, removed = [], [], []
            for text, known in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                blocks, known = blocks_of(text), set(known or ())
                stay = [b.text for i, b in enumerate(blocks) if b.role == MAIN or (b.role == OPEN and i not in known)]
                gone = sum(b.role == OPEN and i in known for i, b in enumerate(blocks))
                if gone and not stay:
                    stay, gone = [b.text for b in blocks if b.role == OPEN], 0
                out.append("\n\n".join(stay))
                sizes.append(len(out[-1]))
                removed.append(gone)
            columns = [batch.column(0), batch.column(1), pa.array(out, pa.string()), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars", "n_repeated"])

    joined = keyed if covered.isEmpty() else keyed.join(covered, "page", "left")
    known = F.lit(None).cast("array<int>") if joined is keyed else F.col("covered")
    types = {f.name: f.dataType.simpleString() for f in pages.schema if f.name in ("page_id", "url")}
    schema = f"page_id {types['page_id']}, url {types['url']}, text string, n_chars long, n_repeated long"
    return joined.select("page_id", "url", "html", known.alias("covered")).mapInArrow(texts, schema)
