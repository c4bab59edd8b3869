"""XML files of records, and XML text columns."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import work_dir

_CORRUPT = "_corrupt_record"
# What may hold a closing tag without closing anything, as it opens and ends; and such a construct as a whole.
_CONSTRUCTS = (("<!--", "-->"), ("<![CDATA[", "]]>"), ("<?", "?>"))
_WHOLE = r"<!--.*?-->|<!\[CDATA\[.*?\]\]>|<\?.*?\?>"
_OPENING = r"(<!--|<!\[CDATA\[|<\?)"
#: Files, or blocks inside a construct, up to which they are broadcast; more are joined by a shuffle.
_FEW = 100_000


def read_records_xml(
    spark: SparkSession, path: str, schema: T.StructType, row_tag: str, root_tag: str | None = None
) -> DataFrame:
    """One row per ``row_tag`` element of all files below ``path``.

    Without ``root_tag`` Spark's XML reader is used; it streams through a file but does not
    split it, so parallelism comes from the number of files. With ``root_tag``, the
    wrapper's element, files are read as text cut at the closing tags, which Spark does
    split: one huge wrapper document is then read by many tasks. Closing tags in comments, CDATA sections and processing
    instructions end no record, also where those reach over splits; one pass over the text, when this is called, finds the
    files that have such. Use it for UTF-8 files whose records are not all self-closing and whose document type holds no closing tag. A record
    that cannot be parsed gives one row of NULLs and costs no other record; prologs, document types and comments give none.
    """
    if root_tag is None:
        return spark.read.schema(schema).format("xml").option("rowTag", row_tag).load(path)

    document = T.StructType([T.StructField(row_tag, T.ArrayType(schema)), T.StructField(_CORRUPT, T.StringType())])

    def parsed(body: Column, *closing: str) -> Column:
        return F.from_xml(F.concat(F.lit("<r>"), body, *(F.lit(c) for c in closing), F.lit("</r>")), document.simpleString())

    def broken(doc: Column) -> Column:
        return doc[_CORRUPT].isNotNull()

    close = f"</{row_tag}>"
    nothing = F.array(F.lit(None).cast(schema))

    def one(text: Column) -> Column:
        """The record of a text that starts with one: closed by itself, by what follows it, or broken."""
        alone, closed = parsed(text), parsed(text, close)
        return F.when(~broken(alone), alone[row_tag]).when(~broken(closed), closed[row_tag]).otherwise(nothing)

    # A piece holds any number of self-closing records and then one open record; only the last piece of a file has
    # no open one. What is no record goes, but for CDATA sections: their text stays as it is.
    gone = rf"<!--.*?-->|<\?.*?\?>|<!DOCTYPE[^>\[]*(?:\[[^\]]*\])?[^>]*>|</?{root_tag}(?:\s[^>]*)?>"
    body = F.regexp_replace(F.col("value"), rf"(?s)(<!\[CDATA\[.*?\]\]>)|{gone}", "$1")
    docs = _pieces(spark, path, close).select(body.alias("body")).where(F.col("body").contains(f"<{row_tag}"))
    docs = docs.select("body", parsed(F.col("body"), close).alias("open"))
    # What does not parse either way is cut before each record, and every record stands for itself.
    each = F.filter(F.split("body", rf"(?=<{row_tag}[\s/>])"), lambda x: x.startswith(f"<{row_tag}"))
    records = (
        F.when(~broken(F.col("open")), F.col("open")[row_tag])
        .when(~broken(parsed(F.col("body"))), parsed(F.col("body"))[row_tag])
        .otherwise(F.flatten(F.transform(each, one)))
    )
    return docs.select(F.explode(records).alias("record")).select("record.*")


def _after(text: Column) -> Column:
    """Number of the construct that ``text``, read from outside any, leaves open; 0 for none."""
    opening = F.regexp_extract(F.regexp_replace(text, f"(?s){_WHOLE}", ""), _OPENING, 1)
    state = F.lit(0)
    for n, (start, _) in enumerate(_CONSTRUCTS, 1):
        state = F.when(opening == start, n).otherwise(state)
    return state


def _steps(text: Column) -> Column:
    """For each state before ``text`` (0 outside, or the number of a construct) the state after it."""
    out = [F.when(text.contains("<!") | text.contains("<?"), _after(text)).otherwise(0)]
    for n, (_, end) in enumerate(_CONSTRUCTS, 1):
        rest = F.substr(text, F.instr(text, end) + len(end))
        out.append(F.when(text.contains(end), _after(rest)).otherwise(n))
    return F.array(*out)


def _pieces(spark: SparkSession, path: str, close: str) -> DataFrame:
    """The text below ``path`` cut at those closing tags that stand in no construct, as column ``value``."""
    text = spark.read.option("lineSep", close).text(path)
    meta = F.col("_metadata")
    cut = meta.file_block_length < meta.file_size
    text = text.select("value", meta.file_path.alias("file"), meta.file_block_start.alias("block"), cut.alias("cut"))
    # As long as no cut falls into a construct, every piece starts outside; the files where one does are seen by that alone.
    steps = _steps(F.col("value"))
    cut_wrong = work_dir(spark, "xml-files")
    text.where(steps[0] != 0).select("file").distinct().write.parquet(cut_wrong)
    wrong = spark.read.schema("file string").parquet(cut_wrong)
    n_wrong = wrong.count()
    if not n_wrong:
        return text.select("value")
    few = n_wrong <= _FEW
    side = F.broadcast(wrong) if few else wrong
    clean = text.join(side, "file", "left_anti").select("value")
    pieces = text.withColumn("place", F.monotonically_increasing_id()).join(side, "file", "left_semi").withColumn("steps", steps)
    if not few:
        pieces = _in_order(pieces)

    # What a split does to each state it may begin with; then every file's splits in order; then the pieces once more.
    # A file that is one split begins outside and needs none of this.
    ends = pieces.where("cut").select("file", "block", "steps").mapInArrow(_split_steps, "file string, block long, ends array<int>, closes array<boolean>")
    found = work_dir(spark, "xml-splits")
    ends.groupBy("file").applyInArrow(_file_states, "file string, block long, state int, home long").write.parquet(found)
    states = spark.read.schema("file string, block long, state int, home long").parquet(found)
    few_states = states.count() <= _FEW
    joined = pieces.join(F.broadcast(states) if few_states else states, ["file", "block"], "left").select("file", "block", "place", "state", "home", "steps", "value")
    joined = joined if few_states else _in_order(joined)
    whole = joined.drop("place").mapInArrow(_joiner(close), "file string, home long, block long, value string")
    held = work_dir(spark, "xml-records")
    whole.write.parquet(held)
    whole = spark.read.schema("file string, home long, block long, value string").parquet(held)
    # A record over several splits: its parts meet by the split that it starts in.
    parts = F.transform(F.array_sort(F.collect_list(F.struct("block", "value"))), lambda x: x.value)
    over = whole.where(F.col("home").isNotNull()).groupBy("file", "home").agg(F.array_join(parts, close).alias("value"))
    return clean.unionByName(whole.where(F.col("home").isNull()).select("value")).unionByName(over.select("value"))


def _in_order(pieces: DataFrame) -> DataFrame:
    """A split's pieces in one task and in their order, after a shuffle has dealt them."""
    return pieces.repartition("file", "block").sortWithinPartitions("file", "block", "place")


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def _split_steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each split and each state before it: the state after it, and whether any piece of it ends outside."""
    names, now = ["file", "block", "ends", "closes"], None

    def summary() -> pa.RecordBatch:
        columns = [pa.array([now[0]]), pa.array([now[1]], pa.int64()), pa.array([ends], pa.list_(pa.int32())), pa.array([closes], pa.list_(pa.bool_()))]
        return pa.RecordBatch.from_arrays(columns, names=names)

    for file, block, steps in _rows(batches):
        if (file, block) != now:
            if now:
                yield summary()
            now, ends, closes = (file, block), list(range(len(steps))), [False] * len(steps)
        ends = [steps[s] for s in ends]
        closes = [c or not s for c, s in zip(closes, ends, strict=True)]
    if now:
        yield summary()


def _file_states(splits: pa.Table) -> pa.Table:
    """The splits of a file that begin inside a construct, with its number and the split that their first record starts in."""
    state, home, out = 0, None, []
    for row in sorted(splits.to_pylist(), key=lambda r: r["block"]):
        if state:
            out.append((row["file"], row["block"], state, home))
        if not state or row["closes"][state]:
            home = row["block"]
        state = row["ends"][state]
    columns = list(zip(*out, strict=True)) or [()] * 4
    kinds = (("file", pa.string()), ("block", pa.int64()), ("state", pa.int32()), ("home", pa.int64()))
    return pa.table([pa.array(c, k) for c, (_, k) in zip(columns, kinds, strict=True)], names=[n for n, _ in kinds])


def _joiner(close: str):
    """Pieces with the state of their split to texts that end outside any construct; ``home`` is set on parts of records over several splits."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts, out = None, [], []

        def ended(home: int | None) -> None:
            out.append((*now, home, close.join(parts)))
            parts.clear()

        def rows() -> pa.RecordBatch:
            file, block, home, value = (list(c) for c in zip(*out, strict=True))
            out.clear()
            columns = [pa.array(file, pa.string()), pa.array(home, pa.int64()), pa.array(block, pa.int64()), pa.array(value, pa.string())]
            return pa.RecordBatch.from_arrays(columns, names=["file", "home", "block", "value"])

        for file, block, begins, home, steps, value in _rows(batches):
            if (file, block) != now:
                if parts:  # goes on in the next split
                    ended(first if inside else now[1])
                now, state, inside, first = (file, block), begins or 0, bool(begins), home
            parts.append(value)
            state = steps[state]
            if not state:
                ended(first if inside else None)
                inside = False
                if len(out) >= 1000:
                    yield rows()
        if parts:
            ended(first if inside else now[1])
        if out:
            yield rows()

    return join


def write_records_xml(
    df: DataFrame, path: str, row_tag: str, root_tag: str, records_per_file: int = 250_000
) -> None:
    """Wrapper documents: a root element around the records, one or more files per partition."""
    (
        df.write.format("xml")
        .option("rowTag", row_tag)
        .option("rootTag", root_tag)
        .option("maxRecordsPerFile", records_per_file)
        .mode("overwrite")
        .save(path)
    )


def record_text(record: Column, row_tag: str) -> Column:
    """A struct as XML text."""
    return F.to_xml(record, {"rowTag": row_tag})


def parse_record(text: Column, schema: T.StructType) -> Column:
    """XML text as a struct; text that is not well formed gives NULL members."""
    return F.from_xml(text, schema.simpleString())
