import datetime
import os

from folioforge.streaming.events import drain, gaps_by_key, last_by_key, read_events, windowed_counts


def test_stream_equals_batch(spark, tmp_path):
    t = datetime.datetime(2024, 1, 1, 10)
    rows = [(i, t + datetime.timedelta(minutes=17 * i), i % 3, "ab"[i % 2]) for i in range(60)]
    schema = "event_id long, ts timestamp, user_id long, event_type string"
    df = spark.createDataFrame(rows, schema)
    df.write.parquet(f"file://{tmp_path}/e")
    stream = read_events(spark, f"file://{tmp_path}/e", df.schema)
    got = {(r.start, r.event_type, r.n) for r in drain(windowed_counts(stream, "ts", ["event_type"], "1 hour")).collect()}
    want = {}
    for _, at, _, e in rows:
        k = (at.replace(minute=0), e)
        want[k] = want.get(k, 0) + 1
    assert {(e, n) for _, e, n in got} and sum(n for *_, n in got) == 60 and len(got) == len(want)
    last = {r.user_id: r.event_type for r in drain(last_by_key(read_events(spark, f"file://{tmp_path}/e", df.schema), "user_id", "ts", "event_type")).collect()}
    assert last == {u: max((r for r in rows if r[2] == u), key=lambda r: r[1])[3] for u in range(3)}


def test_late_rows_are_left_out(spark, tmp_path):
    """The first file closes a window by its watermark, the next batch emits it; a row of it after that comes too late."""
    at = lambda h, m=0: datetime.datetime(2024, 1, 1, h, m)
    schema = "ts timestamp, kind string"
    batches = [[(at(10), "a"), (at(10, 30), "a"), (at(13), "a")], [(at(13, 15), "a")], [(at(10, 45), "a"), (at(18), "a")], [(at(20), "a")]]
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"file://{tmp_path}/p{i}")
        (part,) = (tmp_path / f"p{i}").glob("*.parquet")
        (tmp_path / "e").mkdir(exist_ok=True)
        part.rename(tmp_path / "e" / f"{i}.parquet")
        os.utime(tmp_path / "e" / f"{i}.parquet", (1_700_000_000 + i, 1_700_000_000 + i))
    stream = read_events(spark, f"file://{tmp_path}/e", spark.createDataFrame([], schema).schema, files=1)
    got = {(r.start.hour, r.n) for r in drain(windowed_counts(stream, "ts", ["kind"], "1 hour"), "append").collect()}
    assert (10, 2) in got and (13, 2) in got and (10, 3) not in got


def test_state_of_a_key_across_batches(spark, tmp_path):
    at = lambda h, m=0: datetime.datetime(2024, 1, 1, h, m)
    schema = "k long, ts timestamp"
    (tmp_path / "e").mkdir()
    for i, rows in enumerate([[(1, at(8)), (1, at(9)), (2, at(8)), (None, at(8))], [(1, at(12)), (2, at(9)), (2, None)], [(1, at(12, 30))]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"file://{tmp_path}/p{i}")
        (part,) = (tmp_path / f"p{i}").glob("*.parquet")
        part.rename(tmp_path / "e" / f"{i}.parquet")
        os.utime(tmp_path / "e" / f"{i}.parquet", (1_700_000_000 + i, 1_700_000_000 + i))
    stream = read_events(spark, f"file://{tmp_path}/e", spark.createDataFrame([], schema).schema, files=1)
    got = {(r.k, r.n, r.breaks) for r in drain(gaps_by_key(stream, "k", "ts", 7200.0), "update", latest=["k"]).collect()}
    assert got == {(1, 4, 1), (2, 2, 0)}
