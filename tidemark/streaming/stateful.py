"""Streaming operators with state of their own, where Spark's would drop what comes too late.

``session_window`` and ``dropDuplicates`` give up on events behind the watermark. Here a late event changes a result that was given out already: what
changed is sent again, and what isn't so any more is taken back. Outputs are changes (``op`` is ``set`` or ``unset``) under the
result's key; :func:`settled` reads a log of them. State is kept per key and bounded in time twice: sessions leave it once they ended
``keep_days`` before the key's newest event, and a key without rows for ``idle_ms`` is forgotten by a timer. The watermark that drives the timers is on the
time of arrival, so no row is ever behind it, and a run over all that is available ends.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemark.streaming import log

DAY_US = 86_400_000_000
#: Microseconds in JSON.
STAMPS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def merged(sessions: dict[int, tuple[int, int]], times: list[int], gap: int) -> dict[int, tuple[int, int]]:
    """Sessions (start -> last event, events) with further event times; events less than ``gap`` apart belong together."""
    points = sorted([(s, last, n) for s, (last, n) in sessions.items()] + [(t, t, 1) for t in times])
    out: list[list[int]] = []
    for start, last, n in points:
        if out and start - out[-1][1] < gap:
            out[-1][1] = max(out[-1][1], last)
            out[-1][2] += n
        else:
            out.append([start, last, n])
    return {s: (last, n) for s, last, n in out}


def _sessions(gap: int, keep: int, idle_ms: int):
    """Rows of one user, ``at`` in microseconds; the state is its sessions, as JSON."""
    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        columns = ["user", "start", "last", "events", "op"]
        if state.hasTimedOut:
            state.remove()
            yield pd.DataFrame(columns=columns)
            return
        before = {s: (last, n) for s, last, n in json.loads(state.get[0])} if state.exists else {}
        rows = pd.concat(list(batches))
        after = merged(before, [int(t) for t in rows["at"]], gap)
        old = max(last for last, _ in after.values()) - keep
        state.update((json.dumps([(s, last, n) for s, (last, n) in after.items() if last >= old]),))
        state.setTimeoutTimestamp(int(rows["ms"].max()) + idle_ms)
        gone = [(key[0], s, None, None, "unset") for s in before.keys() - after.keys()]
        told = [(key[0], s, *v, "set") for s, v in after.items() if before.get(s) != v]
        yield pd.DataFrame(gone + told, columns=columns).astype({"last": "Int64", "events": "Int64"})

    return run


def _once(idle_ms: int):
    """Rows of the ids of one bucket; the state is how many rows each id had and when the last came, as an Arrow table."""
    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        known = pa.ipc.open_stream(state.get[0]).read_pandas() if state.exists else pd.DataFrame({"id": [], "n": [], "ms": []})
        out = pd.DataFrame(columns=["bucket", "id", "payload", "op"])
        if state.hasTimedOut:
            after, fresh = known, False
        else:
            rows = pd.concat(list(batches))
            new = rows.groupby("id", sort=False, dropna=False).agg(k=("ms", "size"), payload=("payload", "first"), at=("ms", "max")).reset_index()
            # the known side may have no rows, and then no type
            both = new.merge(known.astype({"id": new["id"].dtype}), on="id", how="outer") if len(known) else new.assign(n=0, ms=0)
            before, more = both["n"].fillna(0).astype("int64"), both["k"].fillna(0).astype("int64")
            after = pd.DataFrame({"id": both["id"], "n": before + more, "ms": both[["ms", "at"]].max(axis=1).astype("int64")})
            fresh = more > 0
            first, again = fresh & (after["n"] == 1), fresh & (before == 1)
            out = pd.concat([
                pd.DataFrame({"bucket": key[0], "id": both["id"][first], "payload": both["payload"][first], "op": "set"}),
                pd.DataFrame({"bucket": key[0], "id": both["id"][again], "payload": None, "op": "unset"})])
        after = after[fresh | (after["ms"] + idle_ms >= state.getCurrentWatermarkMs())]
        if len(after):
            table, sink = pa.Table.from_pandas(after, preserve_index=False), pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema) as writer:
                writer.write_table(table)
            state.update((sink.getvalue().to_pybytes(),))
            state.setTimeoutTimestamp(max(int(after["ms"].min()) + idle_ms, state.getCurrentWatermarkMs()))
        else:
            state.remove()
        yield out

    return run


def _processed(stream: DataFrame, key: str, run, shape: str, state: str) -> DataFrame:
    arriving = stream.withColumn("arrived", F.current_timestamp()).withColumn("ms", F.unix_millis("arrived")).withWatermark("arrived", "0 seconds")
    return arriving.groupBy(key).applyInPandasWithState(run, shape, state, "append", GroupStateTimeout.EventTimeTimeout)


def session_changes(stream: DataFrame, user: str, ts: str, gap_seconds: int, keep_days: int = 30, idle_ms: int = 30 * 86_400_000) -> DataFrame:
    """``user, session_start, last_event, events, op``: sessions that rows opened, changed or joined, however late they came.

    A session that an earlier event or a bridge between two gives another start is unset under its old one. An event more than ``keep_days``
    older than the user's newest still opens a session, but can't reach those that have left the state.
    """
    kind = stream.schema[user].dataType.simpleString()
    rows = stream.where(F.col(user).isNotNull() & F.col(ts).isNotNull()).select(F.col(user).alias("user"), F.unix_micros(F.col(ts).cast("timestamp")).alias("at"))
    out = _processed(rows, "user", _sessions(gap_seconds * 1_000_000, keep_days * DAY_US, idle_ms), f"user {kind}, start long, last long, events long, op string", "sessions string")
    return out.select(F.col("user").alias(user), F.timestamp_micros("start").alias("session_start"), F.timestamp_micros("last").alias("last_event"), "events", "op")


def once_changes(stream: DataFrame, event_id: str, idle_ms: int = 30 * 86_400_000, buckets: int = 1024) -> DataFrame:
    """The columns of ``stream`` and ``op``: an id's row when it is seen first, and the id with ``unset`` and NULLs when it is seen again.

    The ids are kept in ``buckets`` by their hash, a state each, so Python is called per bucket and batch, not per id. The number is fixed for the life of a stream.
    """
    kind, shape = stream.schema[event_id].dataType.simpleString(), stream.drop(event_id).schema
    rows = stream.where(F.col(event_id).isNotNull()).select(
        F.pmod(F.xxhash64(event_id), F.lit(buckets)).cast("int").alias("bucket"), F.col(event_id).alias("id"), F.to_json(F.struct(*shape.names), STAMPS).alias("payload"))
    out = _processed(rows, "bucket", _once(idle_ms), f"bucket int, id {kind}, payload string, op string", "ids binary")
    return out.select(F.col("id").alias(event_id), F.from_json("payload", shape, STAMPS).alias("__row"), "op").select(event_id, "__row.*", "op")


def settled(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """What holds after all changes in a log."""
    return log.read(spark, path, keys).where("op = 'set'").drop("op")
