"""Continuously arriving change files as a file stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators import batch_profile
from ..plans.loads import load_recent_changes, load_recent_messages
from ..schemas import CHANGED_JSON
from ..session import together


def ingest_stream(
    spark: SparkSession,
    folder: str,
    schema: T.StructType = CHANGED_JSON,
    archive: str | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    """JSON Lines files of ``folder``, each read once.

    The checkpoint of the query decides what was read. With ``archive`` finished files are
    moved there some time later; a file that arrives in between is never lost.
    """
    reader = spark.readStream.schema(schema).format("json")
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder)


def ingest_state(spark: SparkSession, folder: str, archive: str, schema: T.StructType = CHANGED_JSON) -> DataFrame:
    """Files, bytes and records that wait in ``folder`` or have been read too recently to go, and those that have gone to ``archive``.

    A file goes when the batch after the one that read it is done. Below ``archive`` files keep their whole path.
    """
    def state(place: str, path: str) -> DataFrame:
        records = spark.read.schema(schema).option("recursiveFileLookup", "true").json(path)
        return batch_profile(records, path, recursive=True).select(F.lit(place).alias("place"), "*")

    return state("landing", folder).unionByName(state("archive", archive))


def scd2_stream(
    stops: DataFrame,
    changes_path: str,
    messages_path: str,
    checkpoint: str,
    name: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Flag upsert of both facts per micro-batch.

    The two facts are loaded side by side. Each batch is committed to each table under the stream's ``name`` (default: the
    checkpoint) and its number; a batch that is replayed after a failure skips the table
    that already has it. Give a new checkpoint a new name. Files may arrive late, so read these
    histories with ``guard_late``, or take ``late_safe_stream``.
    """
    name = name or checkpoint

    def upsert(batch: DataFrame, number: int) -> None:
        label = f"{name}#{number}"
        batch.persist()
        try:
            # Reads and parses the batch; both loads then take it from memory.
            if batch.isEmpty():
                return
            together(
                batch.sparkSession,
                lambda: load_recent_changes(batch, changes_path, label),
                lambda: load_recent_messages(batch, messages_path, label),
            )
        finally:
            batch.unpersist()

    return (
        stops.writeStream.foreachBatch(upsert)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
