"""Keyed streaming state with event-time timers: stores whose keys expire, counts that are emitted while the stream runs, and
joins that give up.

The state is Spark's own, one entry for each key, or in joins for each bucket of keys (``_Buckets``). A key has one event-time timer:
when the watermark passes it the key is called again, emits what is due and is dropped when nothing is left of it. What a key does depends on the times of its
rows alone, not on how they fall into batches, as long as each is newer than the
watermark, the newest time of the batches before less ``lag``; rows at it or behind it are dropped.

Before the rows of a key meet, each task folds its own (``_folded``), so a hot key brings one row for each piece of a batch.
A row without a key belongs to none; it only moves the watermark. One with a time behind all others thus closes a stream.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, TimerValues
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType, StructType

#: What a key holds, as JSON: small, and free to change its form. Beside it the milliseconds of its timer.
HELD = "held string, due long"
#: Keys that are held together. A query keeps the number it was begun with.
BUCKETS = 1024
ROWS_AT_ONCE = 50_000
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _folded(rows: DataFrame, fold: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                yield fold(frame)

    return rows.mapInPandas(work, schema)


class _Keys(StatefulProcessor):
    """What a key holds and the timer that calls it again, as one value of the key."""

    def __init__(self, columns: Sequence[str], update: Callable, out: Sequence[str]):
        self.columns, self.update, self.out = columns, update, out

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.state = handle, handle.getValueState("state", HELD)

    def _step(self, group: tuple, came: list[dict], watermark: int) -> Iterator[Row]:
        """``watermark`` in milliseconds; a timer must lie ahead of it, and one that is due fires with the next batch."""
        if group[0] is None:
            return
        found = self.state.get()
        emitted, held, timer = self.update(json.loads(found[0]) if found else None, came, watermark * 1000)
        due = None if held is None else max(timer // 1000, watermark + 1)
        if found and found[1] > watermark and found[1] != due:
            self.handle.deleteTimer(found[1])  # one that is due has fired, or fires for nothing
        if held is not None:
            self.state.update((json.dumps(held), due))
            if not found or found[1] != due:
                self.handle.registerTimer(due)
        elif found:
            self.state.clear()
        for row in emitted:
            yield Row(*self.out)(group[0], *row)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        return self._step(key, [dict(zip(self.columns, row)) for row in rows], timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        return self._step(key, [], timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass


class _Waiting:
    """Rows that wait for those of other sides: all of a bucket, key by key in their order of coming."""

    def __init__(self, kind: DataType):
        self.schema = pa.schema([("on", to_arrow_type(kind)), ("at", pa.int64()), ("side", pa.string()), ("value", pa.string())])

    def came(self, rows: Iterator[Row]) -> Iterator[pa.Table]:
        """Rows whose first columns are those of the schema."""
        while part := list(islice(rows, ROWS_AT_ONCE)):
            yield pa.table([pa.array(column, field.type) for column, field in zip(zip(*part), self.schema)], schema=self.schema)

    def packed(self, table: pa.Table) -> bytes:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as writer:
            writer.write_table(table, ROWS_AT_ONCE)
        return sink.getvalue().to_pybytes()

    def update(self, held: pa.Table, came: list[pa.Table], sides: Sequence[str], span: int, watermark: int) -> tuple[pa.Table, pa.Table, int | None, object]:
        """What leaves, what waits, and when which of its keys has to be called again; ``watermark`` in micros."""
        rows = pa.concat_tables([held, *came]).combine_chunks()
        if rows["at"].null_count:
            raise ValueError("a row without a time")
        at, side = rows["at"].to_numpy(), _ranked(rows["side"])
        key = rows["on"].combine_chunks().dictionary_encode().indices.to_numpy()
        new = np.arange(len(key)) >= len(held)
        order = np.lexsort((np.where(new, side, 0), np.where(new, at, np.arange(len(key))), new, key))
        rows, at, side, key = rows.take(pa.array(order)), at[order], side[order], key[order]
        start, size = _lives(key, at, side, len(sides), span, lambda row: f"a second row of {rows['side'][row]} for {rows['on'][row]}")
        joined = size == len(sides)
        last = np.append(key[1:] != key[:-1], True)[start + size - 1]
        waits = ~joined & last & (at[start] + span > watermark)
        leaves = ~waits
        first = start[leaves]
        columns = [rows["on"].take(pa.array(first)), pa.array(np.where(joined[leaves], "joined", "expired")), pa.array(at[first])]
        for name in sides:
            where = np.full(len(first), -1)
            is_side = np.append(pc.fill_null(pc.equal(rows["side"], name), False).to_numpy(), False)
            for k in range(len(sides)):
                found = (size[leaves] > k) & is_side[np.minimum(first + k, len(key))]
                where[found] = first[found] + k
            columns.append(rows["value"].take(pa.array(where, mask=where < 0)))
        out = pa.table(columns, names=["on", "status", "first_ts", *sides])
        kept = np.repeat(start[waits], size[waits]) + np.arange(int(size[waits].sum())) - np.repeat(np.cumsum(size[waits]) - size[waits], size[waits])
        if not len(kept):
            return out, rows.slice(0, 0), None, None
        soonest = start[waits][np.argmin(at[start[waits]])]
        return out, rows.take(pa.array(kept)), int(at[soonest]) + span, rows["on"][int(soonest)].as_py()


def _ranked(values: pa.ChunkedArray) -> np.ndarray:
    """The rank of each text among all that there are; null comes first."""
    found = values.combine_chunks().dictionary_encode(null_encoding="encode")
    names = found.dictionary.to_pylist()
    rank = np.zeros(len(names), dtype=np.int64)
    rank[sorted(range(len(names)), key=lambda i: (names[i] is not None, names[i]))] = np.arange(len(names))
    return rank[found.indices.to_numpy()]


def _lives(key: np.ndarray, at: np.ndarray, side: np.ndarray, sides: int, span: int, error: Callable[[int], str]) -> tuple[np.ndarray, np.ndarray]:
    """The first row and the number of rows of each life of a key, in order; rows come sorted by key and by their order in it.

    A life takes the rows before its first row's time plus ``span``, at most one of each side; the next row opens another.
    """
    end = np.searchsorted(key, key, side="right")
    lives = [(np.zeros(0, dtype=np.int64),) * 2]
    start = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)])
    while len(start):
        size, open_ = np.ones(len(start), dtype=np.int64), np.arange(len(start))
        for k in range(1, sides):
            open_ = open_[start[open_] + k < end[start[open_]]]
            open_ = open_[at[start[open_] + k] < at[start[open_]] + span]
            for j in range(k):
                twice = np.flatnonzero(side[start[open_] + k] == side[start[open_] + j])
                if len(twice):
                    raise ValueError(error(int(start[open_[twice[0]]] + k)))
            size[open_] += 1
        lives.append((start, size))
        start = (start + size)[start + size < end[start]]
        if 0 < len(start) < 16:
            lives.append(_lives_one_by_one(start, end, at, side, sides, span, error))
            break
    start, size = (np.concatenate(x) for x in zip(*lives))
    order = np.argsort(start)
    return start[order], size[order]


def _lives_one_by_one(start: np.ndarray, end: np.ndarray, at: np.ndarray, side: np.ndarray, sides: int, span: int, error: Callable[[int], str]) -> tuple[np.ndarray, np.ndarray]:
    """What ``_lives`` gives from these rows on, for a few keys that may have very many lives."""
    found = []
    for row, stop in zip(start.tolist(), end[start].tolist()):
        times, names, begun = at[row:stop].tolist(), side[row:stop].tolist(), 0
        for i in range(1, len(times) + 1):
            if i == len(times) or times[i] >= times[begun] + span or i - begun == sides:
                found.append((row + begun, i - begun))
                begun = i
            elif names[i] in names[begun:i]:
                raise ValueError(error(row + i))
    return tuple(np.array(x, dtype=np.int64) for x in zip(*found))


class _Buckets(StatefulProcessor):
    """What the keys of a bucket hold as one packed table, and a timer for the one whose time is up first.

    A key alone would cost calls to the state, the timers and Python; here they are shared, and columns are worked on as a whole.
    """

    def __init__(self, kind: DataType, sides: Sequence[str], span: int):
        self.waiting, self.sides, self.span = _Waiting(kind), sides, span
        self.schema = StructType().add("packed", "binary").add("due", "long").add("on", kind)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.state = handle, handle.getValueState("state", self.schema)

    def _step(self, group: tuple, rows: Iterator[Row], watermark: int) -> Iterator[Row]:
        if group[0] is None:
            return
        found = self.state.get()
        held = pa.ipc.open_stream(bytes(found[0])).read_all() if found else self.waiting.schema.empty_table()
        out, held, timer, on = self.waiting.update(held, list(self.waiting.came(rows)), self.sides, self.span, watermark * 1000)
        due = None if timer is None else max(timer // 1000, watermark + 1)
        if found and found[1] > watermark and found[1] != due:
            self.handle.deleteTimer(found[1])  # one that is due has fired, or fires for nothing
        if due is not None:
            self.state.update((self.waiting.packed(held), due, on))
            if not found or found[1] != due:
                self.handle.registerTimer(due)
        elif found:
            self.state.clear()
        for start in range(0, len(out), ROWS_AT_ONCE):
            yield Row("packed")(self.waiting.packed(out.slice(start, ROWS_AT_ONCE)))

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        return self._step(key, rows, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        return self._step(key, iter(()), timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for packed in batch.column(0):
            yield from pa.ipc.open_stream(packed.as_buffer())


def _unpacked_state(held: DataFrame) -> DataFrame:
    """The state of an ``expiring_join`` as it would be with one entry for each key."""
    kind = held.schema["value"].dataType["on"].dataType

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for partition, packed, due, soonest in zip(*(c.to_pylist() for c in batch.columns)):
                found: dict = {}
                for row in pa.ipc.open_stream(packed).read_all().to_pylist():
                    found.setdefault(row["on"], []).append([row["at"], row["side"], row["value"]])
                span = due * 1000 - found[soonest][0][0]
                rows = [{"partition_id": partition, "on": on, "held": json.dumps(rows), "due": (rows[0][0] + span) // 1000} for on, rows in found.items()]
                yield pa.RecordBatch.from_pylist(rows, pa.schema([("partition_id", pa.int32()), ("on", to_arrow_type(kind)), ("held", pa.string()), ("due", pa.int64())]))

    schema = StructType().add("partition_id", "integer").add("on", kind).add("held", "string").add("due", "long")
    plain = held.select("partition_id", "value.packed", "value.due", "value.on").mapInArrow(keys, schema)
    return plain.select("partition_id", F.struct("on").alias("key"), F.struct("held", "due").alias("value"))


def _keyed(rows: DataFrame, key: str, lag: str, update: Callable, out: str) -> DataFrame:
    """Apply ``update`` to each key; ``rows`` have the micros of their newest time in ``at``."""
    schema = StructType.fromDDL(out)
    return _processed(rows, key, lag, lambda columns: _Keys(columns, update, schema.names), schema)


def _processed(rows: DataFrame, key: str, lag: str, processor: Callable[[Sequence[str]], StatefulProcessor], out: StructType) -> DataFrame:
    # state with timers of its own needs this store; a query keeps the one it was begun with
    rows.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    timed = rows.withColumn("at_time", F.timestamp_micros("at")).withWatermark("at_time", lag)
    return timed.groupBy(key).transformWithState(processor(timed.columns), out, "Append", "EventTime")


def _micros(ts: str):
    return F.unix_micros(F.col(ts).cast("timestamp"))


def _times(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.withColumns({c: F.timestamp_micros(c).cast("timestamp_ntz") for c in columns})


def expiring_store(stream: DataFrame, key: str, ts: str, order: str, value: str, ttl: int, lag: str) -> DataFrame:
    """A store in which a key lives until ``ttl`` seconds have passed without a write; its newest value stays till then.

    A key that expires is emitted and its state is dropped: (key, first_ts, last_ts, n, order, value). A later write revives
    it as a new key. The newest write is the one of the largest time, then of the largest ``order``.
    """
    span = ttl * 1_000_000

    def runs(frame: pd.DataFrame) -> pd.DataFrame:
        """The writes of a key that lie within ``ttl`` of each other, as one."""
        frame = frame.sort_values([key, "at", order], na_position="first")
        other = (frame[key] != frame[key].shift()) | (frame["at"] - frame["at"].shift() >= span)
        parts = frame.assign(first=frame["at"], n=1).groupby([frame[key], other.cumsum()], dropna=False, sort=False)
        return parts.agg({key: "last", "first": "min", "at": "max", "n": "sum", order: "last", value: "last"})[columns]

    def update(held, came, watermark):
        emitted = []
        for row in sorted(came, key=lambda r: (r["first"], r["at"], r[order])):
            one = [row["first"], row["at"], int(row["n"]), row[order], row[value]]
            if held is not None and one[0] - held[1] < span:
                newest = max(held, one, key=lambda r: (r[1], r[3]))
                held = [min(held[0], one[0]), newest[1], held[2] + one[2], *newest[3:]]
            else:
                if held is not None:
                    emitted.append(held)
                held = one
        if held is not None and held[1] + span <= watermark:
            emitted, held = [*emitted, held], None
        return emitted, held, held and held[1] + span

    columns = [key, "first", "at", "n", order, value]
    kind = {f.name: f.dataType.simpleString() for f in stream.schema}
    rest = f"first long, at long, n long, {order} {kind[order]}, {value} {kind[value]}"
    rows = _folded(stream.select(key, _micros(ts).alias("at"), order, value), runs, f"{key} {kind[key]}, {rest}")
    out = f"{key} {kind[key]}, first_ts long, last_ts long, n long, {order} {kind[order]}, {value} {kind[value]}"
    return _times(_keyed(rows, key, lag, update, out), "first_ts", "last_ts")


def rolling_emissions(stream: DataFrame, ts: str, obj: str, length: int, emit: int, lag: str) -> DataFrame:
    """Counts per object in the last ``length`` seconds, emitted every ``emit`` seconds by the running stream.

    (obj, cnt, window_end). An object whose count falls to zero is emitted once with 0, and its state is dropped.
    """
    slots, step = length // emit, emit * 1_000_000
    if slots < 2:
        raise ValueError("the window must hold at least two slots")

    def panes(frame: pd.DataFrame) -> pd.DataFrame:
        found = frame.assign(pane=frame["at"] // step, n=1).groupby(["obj", "pane"], dropna=False, as_index=False)
        return found.agg({"at": "max", "n": "sum"})[["obj", "pane", "at", "n"]]

    def update(held, came, watermark):
        """``held``: the end that is emitted next, and the counts of the panes that matter from there on."""
        counts = {int(pane): n for pane, n in held[1]} if held else {}
        for row in came:
            counts[row["pane"]] = counts.get(row["pane"], 0) + row["n"]
        emitted, end = [], held[0] if held else None
        while counts or end is not None:
            end = min(counts) + 1 if end is None else end
            if end * step > watermark:
                return emitted, [end, sorted(counts.items())], end * step
            n = sum(n for pane, n in counts.items() if pane < end)
            emitted.append((n, end * step))
            counts = {pane: n for pane, n in counts.items() if pane > end - slots}
            end = end + 1 if n else None
        return emitted, None, None

    rows = _folded(stream.select(F.col(obj).cast("string").alias("obj"), _micros(ts).alias("at")), panes, "obj string, pane long, at long, n long")
    return _times(_keyed(rows, "obj", lag, update, "obj string, cnt long, window_end long"), "window_end")


def expiring_join(stream: DataFrame, on: str, side: str, sides: Sequence[str], ts: str, value: str, timeout: int, lag: str) -> DataFrame:
    """Join any number of sources on a key, waiting ``timeout`` seconds of event time from a key's first row.

    ``stream`` is the sources' union with the source's name in ``side``. A key with a row of every side is emitted as
    ``joined``; one whose time is up as ``expired``, with null for the sides that did not come. Then its state is dropped, and a
    later row opens it anew. (on, status, first_ts, one column for each side.) A second row of a side is an error.
    """
    kind = stream.schema[on].dataType
    bucket = F.when(F.col(on).isNotNull(), F.pmod(F.xxhash64(on), F.lit(BUCKETS)).cast("int"))
    rows = stream.select(F.col(on).alias("on"), _micros(ts).alias("at"), F.col(side).alias("side"), F.col(value).cast("string").alias("value"), bucket.alias("bucket"))
    work = _Buckets(kind, list(sides), timeout * 1_000_000)
    left = _processed(rows, "bucket", lag, lambda _: work, StructType().add("packed", "binary"))
    out = StructType().add("on", kind).add("status", "string").add("first_ts", "long")
    for s in sides:
        out = out.add(s, "string")
    return _times(left.mapInArrow(_unpacked, out), "first_ts").withColumnRenamed("on", on)


def state_of(spark: SparkSession, checkpoint: str, operator: int = 0) -> DataFrame:
    """The entries that a query's state holds after its last finished batch: (partition_id, key, value)."""
    kept = spark.read.format("state-metadata").load(checkpoint).where(F.col("operatorId") == operator)
    reader = spark.read.format("statestore").option("operatorId", operator)
    if kept.where(F.col("operatorName").startswith("transformWithState")).limit(1).count():
        reader = reader.option("stateVarName", "state")
    held = reader.load(checkpoint)
    return _unpacked_state(held) if "packed" in held.schema["value"].dataType.names else held


def held_values(state: DataFrame, key: str, schema: StructType) -> DataFrame:
    """What the state of an ``expiring_store`` holds, in the columns that it emits."""
    fields = F.from_json(F.col("value.held"), "array<string>")
    columns = []
    for i, field in enumerate(f for f in schema if f.name not in (key, "expired")):
        cell = F.get(fields, F.lit(i))
        time = field.dataType.typeName() == "timestamp_ntz"
        cell = F.timestamp_micros(cell.cast("long")).cast("timestamp_ntz") if time else cell.cast(field.dataType)
        columns.append(cell.alias(field.name))
    return state.select(f"key.{key}", *columns)


def running_counts(stream: DataFrame, key: str) -> DataFrame:
    """Counts per key as Spark's own streaming aggregate; ``live_counts`` looks into its state."""
    return stream.groupBy(key).agg(F.count(F.lit(1)).alias("cnt"))


def live_counts(requests: DataFrame, checkpoint: str, key: str) -> DataFrame:
    """Answer requested keys from the state of a query of ``running_counts``; unknown keys give no row."""
    held = state_of(requests.sparkSession, checkpoint).select(f"key.{key}", F.col("value.count").alias("cnt"))
    return requests.select(key).distinct().join(held, key)
