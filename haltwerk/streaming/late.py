"""Late rows of a stream, told from the newest snapshot time that each key has shown."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators import stop_events, stop_messages
from ..plans.loads import collected_at
from ..schemas import CHANGED_KEY, MESSAGE_KEY
from ..sinks import upsert_history

LATE = "IsLate"
_DAY_MS = 24 * 3600 * 1000
#: How far the driver's clock may be set back between batches.
_CLOCK = "1 day"
#: Stands for no time; below every time that a row can have.
_NEVER = -(1 << 63)
_MOMENT, _KEY, _BUCKET, _ARRIVED, _ARRIVED_MS, _SEEN, _UNTIL = (f"__{n}" for n in ("micros", "key", "bucket", "arrived", "arrived_ms", "seen", "until"))


def mark_late(rows: DataFrame, keys: Sequence[str], snapshot: str = "SnapshotTimestamp", keep_days: int = 7, buckets: int = 1024) -> DataFrame:
    """The newest row of each key in each micro-batch, with ``IsLate``: an earlier batch has shown a newer one.

    What is known of a key is one number, dropped when the key has not been seen for ``keep_days``; a row that comes later than that
    counts as new. The watermark follows the time of arrival, so no row is dropped for its age. A row without snapshot time is late if its key was seen before. Of rows of one
    key and time the first by all columns stays. Keys share the state of their bucket: a batch costs a few calls of Python a bucket,
    not some for each key, and rewrites the buckets that it has keys of. With many keys and small batches take more ``buckets``; a checkpoint stands for one
    number of them.
    """
    schema = rows.schema
    text = (
        rows.select(
            F.coalesce(F.unix_micros(snapshot), F.lit(_NEVER)).alias(_MOMENT),
            F.to_json(F.array(*(F.col(k).cast("string") for k in keys))).alias(_KEY),
            *(F.col(c).cast("string").alias(c) for c in schema.names),
        )
        .withColumn(_BUCKET, F.pmod(F.xxhash64(_KEY), F.lit(buckets)).cast("int"))
        .withColumn(_ARRIVED, F.current_timestamp())
        .withColumn(_ARRIVED_MS, F.unix_millis(_ARRIVED))
        .withWatermark(_ARRIVED, _CLOCK)
    )

    def newest(bucket: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        known, watermark = _known(state), state.getCurrentWatermarkMs()
        if not state.hasTimedOut:
            first, arrived = None, watermark
            for frame in frames:
                arrived = max(arrived, int(frame[_ARRIVED_MS].max()))
                first = _first(frame if first is None else pd.concat([first, frame]), schema.names)
            mine = first.set_index(_KEY)[_MOMENT]
            seen = known[_SEEN].reindex(mine.index, fill_value=_NEVER)
            first[LATE] = (mine.index.isin(known.index) & ((mine == _NEVER) | (mine < seen))).to_numpy()
            yield first[[*schema.names, LATE]]
            known = known[(known[_UNTIL] >= watermark) & ~known.index.isin(mine.index)]
            known = pd.concat([known, pd.DataFrame({_SEEN: mine.where(mine >= seen, seen), _UNTIL: arrived + keep_days * _DAY_MS})])
        else:
            known = known[known[_UNTIL] >= watermark]
        if known.empty:
            state.remove()
            return
        state.update((_held(known),))
        state.setTimeoutTimestamp(int(known[_UNTIL].min()))

    shape = ", ".join(f"`{c}` string" for c in schema.names) + f", {LATE} boolean"
    marked = text.groupBy(_BUCKET).applyInPandasWithState(newest, shape, "held binary", "append", GroupStateTimeout.EventTimeTimeout)
    return marked.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields), LATE)


def _first(rows: pd.DataFrame, names: Sequence[str]) -> pd.DataFrame:
    """One row of each key: the newest, of equal ones the first by all columns."""
    rows = rows[rows[_MOMENT] == rows.groupby(_KEY, sort=False)[_MOMENT].transform("max")]
    tied = rows[_KEY].duplicated(keep=False)
    if not tied.any():
        return rows.copy()
    return pd.concat([rows[~tied], rows[tied].sort_values(list(names), na_position="first", kind="stable").drop_duplicates(_KEY)])


def _known(state: GroupState) -> pd.DataFrame:
    """By key, the newest time it has shown and the time until which that is kept."""
    if not state.exists:
        return pd.DataFrame({_SEEN: pd.Series([], dtype="int64"), _UNTIL: pd.Series([], dtype="int64")}, index=pd.Index([], dtype=object, name=_KEY))
    with pa.ipc.open_stream(pa.py_buffer(bytes(state.get[0]))) as stream:
        return stream.read_pandas().set_index(_KEY)


def _held(known: pd.DataFrame) -> bytes:
    table = pa.table({_KEY: pa.array(known.index, pa.string()), _SEEN: pa.array(known[_SEEN], pa.int64()), _UNTIL: pa.array(known[_UNTIL], pa.int64())})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def late_safe_stream(stops: DataFrame, changes_path: str, messages_path: str, checkpoint: str, trigger: dict | None = None) -> list[StreamingQuery]:
    """Both histories from a stream of JSON stops, one query each; which row is active is right for every reader, whatever order files arrive in."""
    rows = (
        (stop_events(stops, collected_at(), "", distinct_stops=False), CHANGED_KEY, changes_path, "changes"),
        (stop_messages(stops, collected_at(), "", json_text=True), MESSAGE_KEY, messages_path, "messages"),
    )

    def appended(path: str, name: str):
        return lambda batch, number: upsert_history(batch, path, batch=f"{name}#{number}", late=LATE) and None

    return [
        mark_late(fact, keys)
        .writeStream.foreachBatch(appended(path, f"{checkpoint}/{name}"))
        .option("checkpointLocation", f"{checkpoint}/{name}")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
        for fact, keys, path, name in rows
    ]
