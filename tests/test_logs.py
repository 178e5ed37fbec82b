"""The folder log and the as-of join of two streams."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pyarrow.parquet as pq

from frames import frame

from tillstream.plans.enrich import enrich_weather
from tillstream.schemas import INT, LONG, STRING, TIME, columns
from tillstream.sources import folder_log
from tillstream.sources.order_topic import MESSAGE, folder_stream
from tillstream.streaming.asof import enrich_from_stream
from tillstream.streaming.jobs import run_to_end

GOT = columns(key=STRING, value=STRING, partition=INT, offset=LONG)
START = datetime(2024, 5, 1)


def messages(spark, a, b):
    return frame(spark, [(f"k{n % 7}", str(n)) for n in range(a, b)], MESSAGE).repartition(3)


def stored(lake):
    return sorted(int(r.value) for r in lake.read("got", GOT, "staging").collect())


def keep(lake):
    return lambda df, batch: lake.write_batch(df, "got", batch, GOT, "staging")


def test_earliest_latest_and_resume(spark, lake, tmp_path):
    log = str(tmp_path / "log")

    def run(name, offsets):
        stream = folder_log.log_stream(spark, log, offsets, str(tmp_path / name / "start"))
        run_to_end(stream, keep(lake), str(tmp_path / name))

    folder_log.append(messages(spark, 0, 40), log, partitions=3)
    run("late", "latest")
    assert stored(lake) == []
    folder_log.append(messages(spark, 40, 70), log, partitions=3)
    # Stopped before it had read anything: it still begins where it first stood.
    run("late", "latest")
    assert stored(lake) == list(range(40, 70))
    folder_log.append(messages(spark, 70, 75), log, partitions=3)
    run("late", "latest")
    run("late", "latest")
    assert stored(lake) == list(range(40, 75))
    run("all", "earliest")
    assert stored(lake) == sorted([*range(40, 75), *range(75)])


def test_offsets_are_gapless_and_keys_keep_their_partition(spark, lake, tmp_path):
    log = str(tmp_path / "log")
    for a, b in ((0, 30), (30, 31), (31, 31), (31, 90)):
        folder_log.append(messages(spark, a, b), log, partitions=4)
    run_to_end(folder_log.log_stream(spark, log), keep(lake), str(tmp_path / "checkpoint"))
    rows = lake.read("got", GOT, "staging").collect()
    places = {}
    for r in rows:
        places.setdefault(r.partition, []).append(r.offset)
    assert all(sorted(v) == list(range(len(v))) for v in places.values())
    assert {str(p): len(v) for p, v in places.items()} == folder_log.ends(log)
    assert len({(r.key, r.partition) for r in rows}) == 7


def test_a_partition_is_written_as_it_comes(spark, tmp_path, monkeypatch):
    """No task holds a partition: its messages lie in many segments, in order, at gapless offsets."""
    monkeypatch.setattr(folder_log, "SEGMENT_ROWS", 5_000)
    log = str(tmp_path / "log")
    rows = spark.range(60_000).selectExpr("'k' AS key", "printf('%06d', (id * 7919) % 60000) AS value")
    folder_log.append(rows, log, partitions=3)
    found = folder_log.segments(log)
    assert len({number for number, *_ in found}) == 1 and len(found) > 4
    at = 0
    for _, first, behind, file in found:
        values = pq.read_table(file)["value"].to_pylist()
        assert first == at and values == [f"{v:06d}" for v in range(first, behind)]
        at = behind
    assert at == 60_000 and not list((tmp_path / "log").glob("writing-*"))


def test_a_micro_batch_reads_a_part_of_a_segment(spark, tmp_path):
    log = str(tmp_path / "log")
    folder_log.append(messages(spark, 0, 50), log, partitions=1)
    reader = folder_log.LogReader({"path": log})
    (part,) = reader.partitions({"0": 10}, {"0": 13})
    found = [b for b in reader.read(part)]
    assert [n for b in found for n in b["offset"].to_pylist()] == [10, 11, 12]
    assert reader.partitions({"0": 50}, {"0": 50}) == []


def test_two_streams_give_the_batch_join(spark, lake, tmp_path, rows):
    """Readings that come before, with and after their events, at the edges of validity."""
    rng = random.Random(4)
    events_of, readings_of = columns(order_id=STRING, city_id=INT, purchased_at=TIME), columns(
        city_id=INT, fetched_at=TIME, weather_condition=STRING, humidity=INT
    )
    events, readings = [], []
    for part in range(4):
        begin = START + timedelta(hours=part)
        at = lambda: begin + timedelta(seconds=rng.choice([0, 299, 300, 301, 600, rng.randint(0, 3500)]))  # noqa: B023, E731
        events.append([(f"o{part}-{n}", rng.choice([1, 2, None]), at()) for n in range(60)])
        readings.append([(rng.choice([1, 2, 3, None]), at(), rng.choice(["Rain", "Snow", None]), rng.randint(0, 9)) for _ in range(25)])
    end = START + timedelta(days=9)
    events.append([("end", 1, end)])
    readings.append([(1, end, "Clear", 0)])
    # Each part's readings come one part after its events.
    for k in range(6):
        e, r = (events[k] if k < 5 else []), (readings[k - 1] if k else [])
        if k == 4:
            e = []
        if k == 5:
            e = events[4]
        if e:
            frame(spark, e, events_of).coalesce(1).write.parquet(str(tmp_path / "e" / str(k)))
        frame(spark, r, readings_of).coalesce(1).write.parquet(str(tmp_path / "r" / str(k)))
    joined = enrich_from_stream(
        folder_stream(spark, str(tmp_path / "e" / "*"), events_of, 1),
        folder_stream(spark, str(tmp_path / "r" / "*"), readings_of, 1),
        ["order_id"], delay="6 hours", salts=3,
    )
    schema = columns(order_id=STRING, city_id=INT, purchased_at=TIME, weather_condition=STRING, humidity=INT)
    run_to_end(joined, lambda df, batch: lake.write_batch(df, "asof", batch, schema, "staging"), str(tmp_path / "c"))
    got = lake.read("asof", schema, "staging").where("order_id <> 'end'")
    flat = frame(spark, [e for part in events[:4] for e in part], events_of)
    known = frame(spark, [r for part in readings[:4] for r in part], readings_of)
    assert rows(got) == rows(enrich_weather(flat, known).select(schema.names))
