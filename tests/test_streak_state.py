"""Streaks of a stream out of order against plain Python."""

import random
from datetime import datetime, timedelta

from leadspark.streaming import incremental, streak_state

T0 = datetime(2025, 1, 1)
SCHEMA = "source string, ts timestamp, ord long, fail boolean"


def run(spark, root, *more):
    for rows in more:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/in")
    schema = spark.createDataFrame([], SCHEMA).schema
    stream = incremental.page_stream(spark, f"{root}/in", schema, files_per_trigger=1)
    query = streak_state.streak_state_stream(stream, f"{root}/out", f"{root}/state", "1 hour")
    query.awaitTermination()
    got = spark.read.schema(streak_state.OUTPUT).parquet(f"{root}/out").collect()
    return {(r.source, r.ord): (r.ts, r.streak, r.open) for r in got}


def test_mixed_files_equal_the_order(spark, tmp_path):
    rnd = random.Random(3)
    # Times within half an hour, many of them equal: every order of arrival is within the delay.
    rows = [(rnd.choice("abc"), T0 + timedelta(minutes=rnd.randrange(30), microseconds=rnd.choice([0, 1, 999])), i, rnd.random() < 0.7)
            for i in range(200)]
    rnd.shuffle(rows)
    streak, want = {}, {}
    for source, ts, i, fail in sorted(rows, key=lambda r: (r[1], r[2])):
        streak[source] = streak.get(source, 0) + 1 if fail else 0
        want[source, i] = (ts, streak[source], streak[source] >= 3)
    end = [(None, T0 + timedelta(days=1), 0, False)]
    assert run(spark, tmp_path, rows[:90], rows[90:], end) == want


def test_state_outlives_the_query_and_late_rows_count_for_nothing(spark, tmp_path):
    first = [("a", T0, 1, True), ("a", T0 + timedelta(minutes=1), 2, True), ("b", None, 9, True)]
    ahead = [(None, T0 + timedelta(hours=5), 0, None)]
    got = run(spark, tmp_path, first, ahead)
    assert {k: v[1] for k, v in got.items()} == {("a", 1): 1, ("a", 2): 2}
    later = [("a", T0 + timedelta(minutes=2), 3, False), ("a", T0 + timedelta(hours=6), 4, True), ("b", T0 + timedelta(hours=6), 5, None)]
    got = run(spark, tmp_path, later, [(None, T0 + timedelta(hours=9), 0, None)])
    assert {k: v[1:] for k, v in got.items()} == {("a", 1): (1, False), ("a", 2): (2, False), ("a", 4): (3, True), ("b", 5): (0, False)}


def test_a_session_with_the_default_store(spark, tmp_path):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    memory = before.replace("RocksDB", "HDFSBacked")
    spark.conf.set(key, memory)
    try:
        rows = [("a", T0, 1, True), ("a", T0 + timedelta(minutes=1), 2, True)]
        got = run(spark, tmp_path, rows, [(None, T0 + timedelta(days=1), 0, None)])
        assert {k: v[1] for k, v in got.items()} == {("a", 1): 1, ("a", 2): 2}
        assert spark.conf.get(key) == memory
    finally:
        spark.conf.set(key, before)


def test_steps_of_the_state_do_not_grow_with_the_sources(spark, tmp_path):
    rows = [(f"s{i}", T0 + timedelta(minutes=20 * k), 2 * i + k, True) for i in range(3000) for k in range(2)]
    spark.createDataFrame([*rows, (None, T0 + timedelta(days=1), 0, False)], SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = incremental.page_stream(spark, f"{tmp_path}/in", spark.createDataFrame([], SCHEMA).schema)
    query = streak_state.streak_state_stream(stream, f"{tmp_path}/out", f"{tmp_path}/state", "1 hour")
    query.awaitTermination()
    got = spark.read.schema(streak_state.OUTPUT).parquet(f"{tmp_path}/out").collect()
    assert {(r.source, r.ord): r.streak for r in got} == {(source, i): 1 + i % 2 for source, _, i, _ in rows}
    steps = sum(op["numRowsUpdated"] for p in query.recentProgress for op in p["stateOperators"])
    assert 0 < steps < 6000, steps


def test_streaks_of_a_slice_go_on_from_the_last_one():
    import pyarrow as pa

    def table(*rows):
        return pa.Table.from_pylist([dict(zip(("source", "us", "ord", "fail"), r)) for r in rows], streak_state._WAITING)

    rows = table(("b", 5, 2, True), ("a", 3, 1, True), ("a", 3, 0, False), ("b", 5, 1, True), ("c", 1, 3, False), ("d", 9, 4, True))
    out, after = streak_state._running(rows, {"b": 2, "c": 4, "e": 1}, 3)
    assert [tuple(r) for r in out[["source", "ord", "streak", "open"]].itertuples(index=False)] == [
        ("a", 0, 0, False), ("a", 1, 1, False), ("b", 1, 3, True), ("b", 2, 4, True), ("c", 3, 0, False), ("d", 4, 1, False)]
    assert after == {"a": 1, "b": 4, "d": 1, "e": 1}
