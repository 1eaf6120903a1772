"""Log records and events."""

import random

import pytest
from pyspark.sql import functions as F

from weirflow.operators import logs
from weirflow.operators.ordered import integral_block
from weirflow.sources import readers

LOG = """orphan line
2012-01-01 10:00:00,001 [myid:3] - INFO first
2012-01-01 10:00:01,500 - ERROR java.lang.Exception: x
\tat a.b.C
\tat d.e.F
2012-01-01 10:00:02,000 [myid:4] - last
"""


def test_records_from_a_file_in_many_splits(spark, tmp_path):
    (tmp_path / "server.log").write_text(LOG)
    (tmp_path / "plain.log").write_text("2012-01-01 10:00:00,000 no node\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40")
    try:
        lines = readers.numbered_lines(spark, str(tmp_path)).withColumnRenamed("line_no", "pos")
        records = logs.assemble_records(lines, block=integral_block("pos", 1)).orderBy("file", "record_no").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [(r.record_no, r.node, r.ts_ms) for r in records] == [
        (1, 0, 1325412000000), (1, 3, 1325412000001), (2, 3, 1325412001500), (3, 3, 1325412002000)
    ]
    assert records[2].log_text == "2012-01-01 10:00:01,500 - ERROR java.lang.Exception: x\n\tat a.b.C\n\tat d.e.F"


def test_log_time_of_anything_else_is_zero(spark):
    row = spark.range(1).select(logs.log_time(F.lit("2012-13-41 10:00:00,001")), logs.log_time(F.lit("x"))).first()
    assert tuple(row) == (0, 0)


def test_id_halves(spark):
    row = spark.range(1).select(logs.high_bits(F.lit(0x1_80000000)), logs.low_bits(F.lit(0x1_80000000))).first()
    assert tuple(row) == (1, -(2**31))


def notification(leader_zxid, sid):
    return f"Notification: 2 (n.leader), {leader_zxid} (n.zxid), 5 (n.round), LOOKING (n.state), {sid} (n.sid), LOOKING (my state)"


def by_loop(entries):
    """The events of entries read one after the other."""
    servers, leader, out = [], 0, []
    for seq, node, (kind, arg) in entries:
        if node not in servers:
            servers.append(node)
        if kind == "state":
            out.append((seq, "stateChange", node, arg, None, None))
            leader = node if arg == "LEADING" else leader
        elif kind in ("election", "note"):
            zxid, sid = arg
            if leader and zxid >> 32 > 0:
                out.append((seq, "stateChange", leader, "INIT", None, None))
                leader = 0
            if kind == "election":
                out += [(seq, "postmessage", None, None, node, other) for other in servers if other != node]
            elif sid != node:
                out.append((seq, "delivermessage", None, None, sid, node))
        elif kind == "error":
            out.append((seq, "exception", node, None, None, None))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_events_match_a_loop(spark, seed):
    rng = random.Random(seed)
    entries, texts = [], []
    for seq in range(120):
        node, zxid, sid = rng.randint(1, 6), rng.choice([5, (1 << 32) + 7, (2 << 32) + 1]), rng.randint(1, 6)
        kind = rng.choice(["state", "election", "note", "error", "other"])
        state = rng.choice(["LOOKING", "FOLLOWING", "LEADING"])
        entries.append((seq, node, (kind, state if kind == "state" else (zxid, sid))))
        texts.append(
            {
                "state": f"peer - {state}",
                "election": f"New election. My id =  {node}, Proposed zxid = {zxid}",
                "note": notification(zxid, sid),
                "error": "an Exception here",
                "other": "nothing",
            }[kind]
        )
    rows = [(seq, seq * 10, node, text) for (seq, node, _), text in zip(entries, texts)]
    frame = spark.createDataFrame(rows, "seq long, ts_ms long, node int, log_text string").repartition(4)
    events = logs.log_events(frame, integral_block("seq", 3))
    got = [
        (r.seq, r.type, r.server, r.state, r.src, r.dst) for r in events.where("type <> 'text'").collect()
    ]
    assert sorted(got, key=repr) == sorted(by_loop(entries), key=repr)
    assert events.where("type = 'text'").count() == 120
    sent = {(r.src, r.dst, r.zxid) for r in events.where("type = 'postmessage'").collect()}
    arrived = {(r.src, r.dst, r.zxid) for r in events.where("type = 'delivermessage'").collect()}
    assert {(r.src, r.dst, r.zxid) for r in logs.undelivered(events).collect()} == sent - arrived


def test_merged_log_filters_every_record(spark, rows):
    a = spark.sql("SELECT timestamp_ntz'2024-01-01 00:00:00' AS ts, 'keep me' AS log_text")
    b = spark.sql("SELECT timestamp_ntz'2024-01-02 00:00:00' AS ts, 'drop' AS log_text UNION ALL SELECT timestamp_ntz'2023-12-31 00:00:00', 'keep too'")
    merged = logs.merged_log({"a": a, "b": b}, "ts", text="keep")
    assert [r.source for r in logs.in_time_order(merged, "ts").collect()] == ["b", "a"]


def test_session_span(spark, rows):
    txns = spark.createDataFrame([(1, 5, "createSession"), (1, 9, "setData"), (1, 12, "closeSession"), (2, 7, "create")], "client long, ts long, op string")
    spans = logs.session_spans(txns, "client", "ts", "op")
    assert rows(spans) == [(1, 5, 12, 5, 12, 3), (2, 7, 7, None, None, 1)]


def test_node_zero_does_not_end_the_search(spark):
    lines = [("f", 1, "2024-01-01 00:00:00,000 [myid:0] a"), ("f", 2, "2024-01-01 00:00:01,000 [myid:3] b"), ("g", 1, "2024-01-01 00:00:00,000 [myid:0] c")]
    records = logs.assemble_records(spark.createDataFrame(lines, "file string, pos long, value string"))
    assert {(r.file, r.record_no): r.node for r in records.collect()} == {("f", 1): 3, ("f", 2): 3, ("g", 1): 0}
