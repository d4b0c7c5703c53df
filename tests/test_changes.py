"""Change feeds, stateful processors, tables that several queries write, and names that never vanish."""

import json
import random
import threading
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from yardlake.operators import metrics, status, upsert
from yardlake.plans.given import at
from yardlake.sources.changes import ChangeFeed, steps
from yardlake.sources.sinks import Merged, Snapshots, append_batch, query_of, read_appended
from yardlake.sources.tables import table_stream
from yardlake.streaming import gold, ingest
from yardlake.streaming.processors import BUCKET, KeepStatus, Timeline

from rules import pairs

T0 = datetime(2024, 1, 1)
EVENT = "container_no_norm string, event_time_parsed timestamp, event_type_norm string, facility string, " + ", ".join(f"{a} string" for a in status.ATTRIBUTES) + ", event_id_generated string"


def pairs_of(events):
    """As sets of (t, out, truck); the plain rule, kept as the brute force."""
    return {i: found for i, found in pairs(set(events)).items()}


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.tuples(st.integers(0, 12), st.integers(0, 1), st.sampled_from(["a", "b", None])), min_size=1, max_size=6), max_size=6), st.integers(0, 4))
def test_timeline_gives_the_changes_of_all_pairs(batches, lag):
    """Batches in any order of time, state stored and loaded between them, and let go of behind a floor that follows the newest event."""
    width, stored, index, seen, shown, floor = BUCKET // 2, {}, {"in": [], "out": []}, set(), {}, -1
    for batch in batches:
        batch = [(t * width, out, truck) for t, out, truck in batch if t * width >= floor]
        line = Timeline(index, lambda side, b: dict(stored[side, b]))
        before, touched = line.copy(), set()
        for t, out, truck in batch:
            line.put("out" if out else "in", t, truck)
            touched.add(t)
        near = {line.last_at_or_before("in", t) for t in touched}
        near |= {line.last_at_or_before("in", i - 1) for i in near if i is not None and i in touched}
        for i in (x for x in near if x is not None):
            if line.match(i) != before.match(i):
                assert before.match(i) == shown.get(i)
                shown[i] = line.match(i)
        seen |= set(batch)
        assert shown == pairs_of(seen)
        floor = max([floor, *(t - lag * width for t, _, _ in batch)])
        line.settle(floor)
        for side, b in line.dirty:
            stored[side, b] = dict(line.held[side, b])
        stored = {k: v for k, v in stored.items() if v}
        index = json.loads(json.dumps(line.index))
        assert {(s, b) for s in index for b in index[s]} == set(stored)


def test_work_of_a_batch_does_not_grow_with_what_a_key_keeps():
    """10,000 kept events: a new one loads what is next to it."""
    for kept in (100, 10_000):
        stored, loads = {}, []
        line = Timeline({"in": [], "out": []}, None)
        for k in range(kept):
            line.put("in" if k % 2 == 0 else "out", k * BUCKET // 4, "t")
        stored = {k: v for k, v in line.held.items() if v}
        line = Timeline(line.index, lambda side, b: loads.append(len(stored[side, b])) or dict(stored[side, b]))
        middle = kept // 2 * BUCKET // 4 + 5
        line.put("out", middle, "t")
        i = line.last_at_or_before("in", middle)
        assert line.match(i) is not None
        assert sum(loads) <= 12 and len(line.dirty) == 1


def event(spark, *rows):
    """(container, hour, type, attribute values by name, id)."""
    return spark.createDataFrame([(c, T0 + timedelta(hours=h), kind, "CT01", *(told.get(a) for a in status.ATTRIBUTES), i) for c, h, kind, told, i in rows], EVENT)


def test_status_states_meet_in_any_order(spark):
    """An attribute is as new as the event that told it, also where the container's newest event came before; equal times go by type and id."""
    severity = "last_inspection_severity"
    one = event(spark, ("A", 1, "INSPECTION", {severity: "MINOR"}, "1"), ("A", 10, "GATE_IN", {}, "2"), ("B", 5, "GATE_IN", {}, "AAA"))
    two = event(spark, ("A", 5, "INSPECTION", {severity: "CRITICAL"}, "3"), ("B", 5, "GATE_IN", {}, "BBB"), ("B", 5, "MNR", {"last_repair_stage": "X"}, "C"))
    want = sorted(map(str, status.current(one.union(two)).collect()))
    for a, b in ((one, two), (two, one)):
        got = status.visible(upsert.newest_status(status.state(a), status.state(b)))
        assert sorted(map(str, got.collect())) == want
    assert "CRITICAL" in want[0]


EVENTS = st.lists(st.tuples(st.sampled_from("AB"), st.integers(0, 5), st.sampled_from(["GATE_IN", "INSPECTION", "MNR"]), st.sampled_from([{}, {"last_inspection_severity": "MAJOR"}, {"last_inspection_severity": "MINOR", "last_location": "L"}])), min_size=1, max_size=14)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(EVENTS, st.randoms())
def test_any_order_of_batches_gives_the_current_status(spark, rows, rnd):
    rows = [(*r, f"id{i}") for i, r in enumerate(rows)]
    parts = [p for p in ([r for r in rows if hash(r[4]) % 3 == k] for k in range(3)) if p]
    rnd.shuffle(parts)
    state = status.state(event(spark, *parts[0]))
    for p in parts[1:]:
        state = upsert.newest_status(state, status.state(event(spark, *p)))
    want = sorted(map(str, status.current(event(spark, *rows)).collect()))
    assert sorted(map(str, status.visible(state).collect())) == want


def test_status_stream_and_its_changes(spark, tmp_path):
    rnd = random.Random(7)
    rows = [(rnd.choice("ABCD"), rnd.randrange(30), rnd.choice(["GATE_IN", "INSPECTION", "MNR", None]), rnd.choice([{}, {"last_repair_stage": "X"}, {"last_inspection_severity": "MAJOR"}, {"last_cleaning_type": "WASH"}]), f"i{k}") for k in range(60)]
    root = f"file://{tmp_path}"
    for k in range(3):
        append_batch(event(spark, *rows[k::3]), f"{root}/in", k)
        gold.start_status(table_stream(spark, f"{root}/in", EVENT), f"{root}/gold/status", f"{root}/checkpoints/status", ingest.ONCE).awaitTermination()
        gold.start_backlog(spark, root, ingest.ONCE).awaitTermination()
        now = status.current(event(spark, *[r for j in range(k + 1) for r in rows[j::3]]))
        assert sorted(map(str, gold.read_status(spark, f"{root}/gold/status").collect())) == sorted(map(str, now.select(*[c.split()[0] for c in gold.STATUS_ROW.split(", ")]).collect()))
        assert sorted(map(tuple, gold.backlog_now(spark, root).collect())) == sorted(map(tuple, metrics.backlog(now).select("facility", "backlog_type", "backlog_count").collect()))
    feed = gold.status_table(spark, f"{root}/gold/status").feed
    assert sorted(map(str, feed.as_of(feed.latest()).collect())) == sorted(map(str, gold.read_status(spark, f"{root}/gold/status").collect()))


def test_a_refresh_reads_no_closed_cycle(spark, tmp_path):
    """Inventory is read from open entries alone, and equals that of all cycles at any time."""
    root = f"file://{tmp_path}"
    rows = [(f"C{k}", "CT01", T0 + timedelta(hours=h), kind, None) for k in range(40) for h, kind in ((3 * k, "GATE_IN"), (3 * k + 30, "GATE_OUT")) if k % 4 or kind == "GATE_IN"]
    kinds = "container_no_norm string, facility string, event_time_parsed timestamp, event_type_norm string, truck string"
    rows.sort(key=lambda r: r[2])
    for k in range(2):
        append_batch(spark.createDataFrame(rows[k * 40 : k * 40 + 40], kinds), f"{root}/in", k)
        gold.start_cycles(table_stream(spark, f"{root}/in", kinds), f"{root}/gold/cycles", f"{root}/checkpoints/cycles", ingest.ONCE).awaitTermination()
        gold.start_inventory(spark, root, ingest.ONCE).awaitTermination()
        made = gold.read_cycles(spark, f"{root}/gold/cycles")
        for when in ("2024-01-03 00:00:00", "2024-01-20 07:00:00", "2024-06-01 00:00:00"):
            got, want = gold.inventory_now(spark, root, at(when)), metrics.inventory_by_dwell(made, at(when))
            assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))
    entries = Snapshots(spark, f"{root}/gold/entries", gold.ENTRIES)
    assert entries.read().agg(F.sum("n")).first()[0] == 10 == made.where("cycle_status = 'OPEN'").count()
    assert all("/gold/entries/" in f for f in gold.inventory_now(spark, root, at("2024-06-01 00:00:00")).inputFiles())


def test_a_feed_tells_net_changes(spark, tmp_path):
    feed = ChangeFeed(spark, f"file://{tmp_path}/feed", "k long", "v string, n int")
    kinds = "k long, was struct<v string, n int>, now struct<v string, n int>"
    batches = [[(1, None, ("a", 1)), (2, None, ("b", 1))], [(1, ("a", 1), ("c", 1))], [(1, ("c", 1), ("a", 1)), (3, None, ("d", 1))], [(3, ("d", 1), ("e", 2)), (2, ("b", 1), (None, None))]]
    for i, b in enumerate(batches):
        assert feed.latest() == i - 1 and feed.append(spark.createDataFrame(b, kinds), i) and not feed.append(spark.createDataFrame(b, kinds), i)
    net = lambda *a: sorted((r.k, r.change, r.was and r.was.v, r.now.v) for r in feed.since(*a).collect())
    assert net(-1) == [(1, "insert", None, "a"), (2, "insert", None, None), (3, "insert", None, "e")]
    assert net(0) == [(2, "update", "b", None), (3, "insert", None, "e")]  # 1 is again what it was
    assert net(0, 1) == [(1, "update", "a", "c")] and net(2) == [(2, "update", "b", None), (3, "update", "d", "e")] and net(3) == []
    assert sorted((r.k, r.v) for r in feed.as_of(1).collect()) == [(1, "c"), (2, "b")]
    counted = steps(feed.read(), F.col("v").isin("a", "e"), "v").groupBy("v").agg(F.sum("step").alias("n")).where("n <> 0")
    assert sorted(map(tuple, counted.collect())) == [("a", 1), ("e", 1)]
    seen = []
    for after in (-1, 1):
        stream = feed.stream(after, files_per_trigger=1).writeStream.foreachBatch(lambda df, i: seen.extend((r.k, r.version) for r in df.collect()))
        for _ in range(2):  # goes on where it stopped
            stream.option("checkpointLocation", f"file://{tmp_path}/cp{after}").trigger(availableNow=True).start().awaitTermination()
        assert sorted(seen) == sorted((k, v) for v, b in enumerate(batches) for k, *_ in b if v > after)
        seen.clear()


def test_two_checkpoints_lose_nothing(spark, tmp_path):
    """Batches of another query have its name; those of one query count once."""
    root = f"file://{tmp_path}"
    table = Merged(spark, f"{root}/m", "k long, n long", lambda df: df.groupBy("k").agg(F.max("n").alias("n")))
    for run in ("a", "b"):
        spark.range(3 if run == "a" else 5).coalesce(1).write.mode("append").parquet(f"{root}/in")

        def write(df, i, run=run):
            query = query_of(spark, f"{root}/cp-{run}")
            assert append_batch(df, f"{root}/out", i, query) and not append_batch(df, f"{root}/out", i, query)
            assert table.add(df.selectExpr("id as k", "1L as n"), i, query) and not table.add(df.selectExpr("id as k", "2L as n"), i, query)

        spark.readStream.schema("id long").parquet(f"{root}/in").writeStream.foreachBatch(write).option("checkpointLocation", f"{root}/cp-{run}").trigger(availableNow=True).start().awaitTermination()
    assert read_appended(spark, f"{root}/out").count() == 3 + 8
    assert sorted(map(tuple, table.read().collect())) == [(k, 1) for k in range(5)] and table.runs()["made"] == 2


def test_a_name_is_always_there(spark, tmp_path):
    """A reader in a loop while versions come and old ones go."""
    table = Snapshots(spark, f"file://{tmp_path}/t", "k long")
    table.write(spark.range(10).toDF("k"), 0, ("yard_names", "t"))
    stop, errors, reads = threading.Event(), [], []

    def look():
        while not stop.is_set():
            try:
                reads.append(spark.catalog.tableExists("yard_names.t"))
                spark.table("yard_names.t").schema
            except Exception as e:  # noqa: BLE001
                errors.append(e)

    thread = threading.Thread(target=look)
    thread.start()
    for n in range(1, 7):
        table.write(spark.range(10 * n).toDF("k"), n, ("yard_names", "t"))
        assert spark.table("yard_names.t").count() == 10 * n
    stop.set()
    thread.join()
    assert not errors and reads and all(reads)
    wider = Snapshots(spark, f"file://{tmp_path}/t", "k long, v string")
    wider.write(spark.range(2).selectExpr("id as k", "'x' as v"), 9, ("yard_names", "t"))
    assert spark.table("yard_names.t").columns == ["k", "v"]
    spark.sql("DROP SCHEMA yard_names CASCADE")


def test_order_of_status_events():
    place = KeepStatus.place
    assert sorted([place(2, "A", "1"), place(1, "Z", "9"), place(2, None, "8"), place(2, "A", None)]) == [place(1, "Z", "9"), place(2, None, "8"), place(2, "A", None), place(2, "A", "1")]
    with pytest.raises(ValueError, match="column v was"):
        from pyspark.sql.types import StructType

        from yardlake.sources.sinks import widened

        widened(StructType.fromDDL("v int"), StructType.fromDDL("v string"))
