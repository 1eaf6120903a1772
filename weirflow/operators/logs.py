"""Log operators: record assembly, merged scans, and events taken from log text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirflow.operators.filters import time_range
from weirflow.operators.ordered import Fold, integral_block, prefix, row_index
from weirflow.session import shared_dir

# The line formats of the server log.
RECORD_START = r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2},\d{3})"
NODE_ID = r"\[myid:(\d+)\]"
STATE_CHANGE = "- (LOOKING|FOLLOWING|LEADING)"
NEW_ELECTION = r"New election. My id =  (\d+), Proposed zxid = (\d+)"
NOTIFICATION = (
    r"Notification: (\d+) \(n.leader\), (\d+) \(n.zxid\), (\d+) \(n.round\), "
    r".+ \(n.state\), (\d+) \(n.sid\), .+ \(my state\)"
)
EXCEPTION = "xception"


def log_time(text: Column) -> Column:
    """Epoch milliseconds of ``yyyy-MM-dd HH:mm:ss,SSS``; 0 when it is no such time."""
    parsed = F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss,SSS"))
    return F.coalesce(F.unix_millis(parsed), F.lit(0).cast("long"))


def assemble_records(
    lines: DataFrame, file: str = "file", order: Sequence[str] = ("pos",), block: Column | None = None
) -> DataFrame:
    """Join continuation lines to the record they follow. Lines are ``(file, pos, value)``.

    A line that begins with a time opens a record. The node is the first ``[myid:N]`` of the file that is not
    0, or 0 if there is none. Lines before the first record belong to none and go.
    """
    opening = F.col("value").rlike(RECORD_START)
    marked = prefix(lines, order, {"record_no": Fold("sum", F.when(opening, 1).otherwise(0))}, [file], block)
    seen = F.regexp_extract("value", NODE_ID, 1)
    nodes = (
        lines.where(F.col("value").rlike(NODE_ID) & (seen.try_cast("int") != 0))
        .groupBy(file)
        .agg(F.min_by(seen, F.struct(*order)).cast("int").alias("node"))
    )
    ordered = F.array_sort(F.collect_list(F.struct(*order, "value")))
    records = (
        marked.where("record_no > 0")
        .groupBy(file, "record_no")
        .agg(F.array_join(F.transform(ordered, lambda line: line["value"]), "\n").alias("log_text"))
    )
    return records.join(nodes, file, "left").select(
        file,
        "record_no",
        log_time(F.regexp_extract("log_text", RECORD_START, 1)).alias("ts_ms"),
        F.coalesce("node", F.lit(0)).alias("node"),
        "log_text",
    )


def merged_log(
    sources: dict[str, DataFrame], ts: str, start: str | None = None, end: str | None = None, text: str | None = None
) -> DataFrame:
    """Several logs as one in time order. The time bounds apply to each source, so they reach its scan."""
    parts = [time_range(df, ts, start, end).withColumn("source", F.lit(name)) for name, df in sources.items()]
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part, allowMissingColumns=True)
    if text is not None:
        merged = merged.where(F.col("log_text").contains(text))
    return merged


def in_time_order(merged: DataFrame, ts: str, *ties: str) -> DataFrame:
    """Total order by time. Spark sorts by ranges, so no task holds the whole log."""
    return merged.orderBy(ts, "source", *ties)


def high_bits(zxid: str | Column) -> Column:
    """The epoch: the upper 32 bits of an id, as a signed 32-bit number."""
    return _signed32(F.shiftrightunsigned(zxid, 32))


def low_bits(zxid: str | Column) -> Column:
    """The counter: the lower 32 bits of an id, as a signed 32-bit number."""
    column = F.col(zxid) if isinstance(zxid, str) else zxid
    return _signed32(column.bitwiseAND(F.lit(0xFFFFFFFF)))


def _signed32(column: Column) -> Column:
    return F.when(column >= 2**31, column - 2**32).otherwise(column).cast("int")


EVENT_FIELDS = {
    "type": "string", "server": "int", "state": "string", "src": "int", "dst": "int", "zxid": "long",
    "count": "int", "epoch": "int", "epoch2": "long", "text": "string", "__rank": "long",
}


def _event(name: str, **columns: Column) -> Column:
    fields = {"type": F.lit(name), **columns}
    return F.struct(*[fields.get(f, F.lit(None)).cast(kind).alias(f) for f, kind in EVENT_FIELDS.items()])


def log_events(entries: DataFrame, block: Column | None = None) -> DataFrame:
    """Events of a text log ``(seq, ts_ms, node, log_text)``; ``seq`` numbers the entries in time order.

    stateChange     a server enters a state; or state INIT for the known leader when an election or a
                    notification of a later epoch arrives, after which no leader is known
    postmessage     an election proposal, one row to every other server seen so far
    delivermessage  a received proposal, unless a server sent it to itself
    exception, text

    "Seen so far" and "known leader" are running values over the entries. Servers are numbered by first
    appearance, so "seen so far" is a number k and the targets are the servers 1 … k.
    """
    block = integral_block("seq") if block is None else block
    text = F.col("log_text")
    found = {
        "__state": F.regexp_extract(text, STATE_CHANGE, 1),
        "__election": F.regexp_extract(text, NEW_ELECTION, 2),
        "__note": F.regexp_extract(text, NOTIFICATION, 2),
    }
    # an entry has one meaning, in this order
    kind = (
        F.when(F.col("__state") != "", "state")
        .when(F.col("__election") != "", "election")
        .when(F.col("__note") != "", "notification")
        .when(text.rlike(EXCEPTION), "exception")
    )
    is_kind = {k: F.col("__kind") == k for k in ("state", "election", "notification", "exception")}
    zxid = F.when(is_kind["election"], F.col("__election")).when(is_kind["notification"], F.col("__note"))
    parsed = (
        entries.withColumns(found)
        .withColumn("__kind", kind)
        .withColumn("__zxid", zxid.cast("long"))
        .drop("__election", "__note")
    )
    epoch = high_bits("__zxid")
    newer = F.col("__zxid").isNotNull() & (epoch > 0)
    leads = is_kind["state"] & (F.col("__state") == "LEADING")
    leader = F.when(leads, F.col("node")).when(newer, F.lit(0))

    servers = entries.groupBy("node").agg(F.min("seq").alias("seq"))
    ranks = row_index(servers, ["seq"], name="__rank", block=block)
    flagged = parsed.join(ranks.select("seq", F.lit(1).alias("__new")), "seq", "left")
    new = F.coalesce("__new", F.lit(0))
    known = prefix(
        flagged, ["seq"], {"__leader": Fold("last", leader), "__seen": Fold("sum", new)}, block=block, inclusive=False
    )

    message = {"zxid": F.col("__zxid"), "count": low_bits("__zxid"), "epoch": epoch}
    sender = F.regexp_extract(text, NOTIFICATION, 4).try_cast("int")
    seen = F.coalesce("__seen", F.lit(0)) + new
    to_all = F.transform(
        F.sequence(F.lit(1).cast("long"), seen.cast("long")),
        lambda rank: _event("postmessage", src=F.col("node"), **message, **{"__rank": rank}),
    )
    single = F.array(
        F.when(is_kind["state"], _event("stateChange", server=F.col("node"), state=F.col("__state"))),
        F.when(
            newer & (F.coalesce("__leader", F.lit(0)) != 0),
            _event("stateChange", server=F.col("__leader"), state=F.lit("INIT")),
        ),
        F.when(
            is_kind["notification"] & (sender != F.col("node")),
            _event(
                "delivermessage",
                src=sender,
                dst=F.col("node"),
                epoch2=F.regexp_extract(text, NOTIFICATION, 3).try_cast("long"),
                **message,
            ),
        ),
        F.when(is_kind["exception"], _event("exception", server=F.col("node"), text=text)),
        _event("text", text=text),
    )
    events = known.select(
        "seq",
        "ts_ms",
        F.explode(F.concat(F.array_compact(single), F.when(is_kind["election"], to_all).otherwise(F.array()))).alias("e"),
    ).select("seq", "ts_ms", "e.*")
    targets = ranks.select("__rank", F.col("node").alias("__node"))
    placed = events.join(targets, "__rank", "left").withColumn("dst", F.coalesce("dst", "__node"))
    to_other = (F.col("type") != "postmessage") | (F.col("src") != F.col("dst"))
    return placed.where(to_other).select("type", "seq", "ts_ms", *[f for f in EVENT_FIELDS if f not in ("type", "__rank")])


def transaction_events(txns: DataFrame) -> DataFrame:
    """Transactions with their ids in hexadecimal digits."""
    return txns.select(
        F.lit("transaction").alias("type"),
        "ts",
        *[F.lower(F.hex(c)).alias(c) for c in ("client_id", "cxid", "zxid")],
        F.col("operation").alias("op"),
        "extra",
    )


def undelivered(events: DataFrame) -> DataFrame:
    """Proposals sent of which no delivery with the same sender, receiver and id is known."""
    shared_dir(events.sparkSession)
    # both sides come from the same costly pass over the log, so its messages are written once
    messages = events.where(F.col("type").isin("postmessage", "delivermessage")).checkpoint()
    sent = messages.where("type = 'postmessage'")
    arrived = messages.where("type = 'delivermessage'").select("src", "dst", "zxid")
    return sent.join(arrived, ["src", "dst", "zxid"], "left_anti")


def session_spans(
    txns: DataFrame, client: str, ts: str, operation: str, opened: str = "createSession", closed: str = "closeSession"
) -> DataFrame:
    """Per client: first and last transaction, when the session was opened and closed, and how many there were."""
    return txns.groupBy(client).agg(
        F.min(ts).alias("first_ts"),
        F.max(ts).alias("last_ts"),
        F.min(F.when(F.col(operation) == opened, F.col(ts))).alias("opened_ts"),
        F.max(F.when(F.col(operation) == closed, F.col(ts))).alias("closed_ts"),
        F.count(F.lit(1)).alias("n"),
    )
