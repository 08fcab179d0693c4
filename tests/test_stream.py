import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from shelfcast.streaming.messages import BUCKETS, changes_only, changes_only_stream, json_messages

SCHEMA = "user_id bigint, ts timestamp_ntz, event_id bigint, event_type string"
START = dt.datetime(2024, 1, 1)
KINDS = ["a", "a", None, None, "b", "b", "a", "a", "a", None, "c", "c"]


def at(minutes: float) -> dt.datetime:
    return START + dt.timedelta(minutes=minutes)


class Stream:
    """Event files that arrive one by one, and the query that reads them."""

    def __init__(self, spark, folder, **options):
        self.spark, self.folder, self.options = spark, folder, options

    def send(self, rows):
        """Add one file, run until the input ends; returns the progress of the micro-batches."""
        self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{self.folder}/in")
        source = self.spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{self.folder}/in")
        query = (
            changes_only_stream(source, **self.options).writeStream.format("parquet")
            .option("path", f"{self.folder}/out").option("checkpointLocation", f"{self.folder}/log")
            .trigger(availableNow=True).start()
        )
        query.awaitTermination()
        return query.recentProgress

    def close(self):
        return self.send([(-1, at(10**6), -1, "end")])

    def ids(self):
        table = self.spark.read.parquet(f"{self.folder}/out")
        return sorted(r["event_id"] for r in table.collect() if r["user_id"] != -1)


def batch_ids(spark, rows, **options):
    return sorted(r["event_id"] for r in changes_only(spark.createDataFrame(rows, SCHEMA), **options).collect())


def test_any_order_of_arrival_gives_the_batch_result(spark, tmp_path):
    """Events shuffled over three micro-batches; one session has most of them, one has a null name."""
    rng = random.Random(4)
    who = lambda i: None if i % 9 == 0 else 1 if i % 3 else i % 4
    rows = [(who(i), at(i // 2), i, rng.choice(KINDS)) for i in range(240)]
    rng.shuffle(rows)
    stream = Stream(spark, tmp_path, delay=dt.timedelta(hours=3))
    for part in (rows[:80], rows[80:160], rows[160:]):
        stream.send(part)
    stream.close()
    want = batch_ids(spark, rows)
    assert stream.ids() == want and len(want) > 40


def test_changes_over_several_batches(spark, tmp_path):
    rows = [(i % 2, at(i), i, KINDS[i // 2 % 12]) for i in range(48)]
    stream = Stream(spark, tmp_path)
    for n in range(4):
        stream.send(rows[n * 12 : (n + 1) * 12][::-1])
    stream.close()
    want = batch_ids(spark, rows)
    assert stream.ids() == want and 0 in want and 4 in want


def test_rows_wait_for_earlier_ones(spark, tmp_path):
    stream = Stream(spark, tmp_path, delay=dt.timedelta(minutes=10))
    stream.send([(1, at(0), 1, "a"), (1, at(5), 3, "a"), (1, at(6), 4, "b")])
    assert stream.ids() == []
    stream.send([(1, at(4), 2, "b")])
    stream.send([(2, at(15.5), 9, "x")])  # moves the watermark to minute 5.5
    assert stream.ids() == [1, 2, 3]
    stream.close()
    assert stream.ids() == [1, 2, 3, 4, 9]


def test_too_late_rows_are_dropped_and_counted(spark, tmp_path):
    stream = Stream(spark, tmp_path, delay=dt.timedelta(minutes=10))
    stream.send([(1, at(0), 1, "a"), (1, at(60), 2, "a")])  # the watermark comes to minute 50
    progress = stream.send([(1, at(20), 3, "b"), (1, None, 4, "b"), (1, at(55), 5, "c")])
    dropped = sum(s["numRowsDroppedByWatermark"] for p in progress for s in p["stateOperators"])
    stream.close()
    assert dropped == 1 and stream.ids() == [1, 2, 5]


def test_idle_sessions_are_forgotten(spark, tmp_path):
    options = {"delay": dt.timedelta(minutes=10), "expiry": dt.timedelta(hours=5)}
    rows = [(u, at(u), u, "a") for u in range(50)]
    stream = Stream(spark, tmp_path, **options)
    held = lambda progress: [s["numRowsTotal"] for p in progress for s in p["stateOperators"]][-1]
    before = held(stream.send(rows))
    later = [(u, at(200), 100 + u, "a") for u in range(3)] + [(7, at(1000), 200, "a")]
    after = held(stream.send(later))
    assert after < before / 5
    last = [(0, at(1001), 300, "a"), (7, at(1002), 301, "a")]
    stream.send(last)
    stream.close()
    want = batch_ids(spark, rows + later + last, expiry=options["expiry"])
    assert stream.ids() == want
    assert {200, 300} <= set(want) and not {100, 301} & set(want)


def test_state_has_a_key_per_bucket_not_per_session(spark, tmp_path):
    rows = [(u, at(k * 5 + u % 5), 2 * u + k, "ab"[(u + k) % 2]) for u in range(3 * BUCKETS) for k in range(2)]
    stream = Stream(spark, tmp_path, delay=dt.timedelta(minutes=1))
    progress = stream.send(rows)
    assert max(s["numRowsTotal"] for p in progress for s in p["stateOperators"]) <= BUCKETS
    stream.close()
    assert stream.ids() == batch_ids(spark, rows) == list(range(6 * BUCKETS))


@pytest.mark.parametrize("limit", [None, "40"])
def test_expiry_in_tables(spark, limit):
    rows = [(i % 2, at(i if i < 60 else i + 300), i, "a") for i in range(120)]
    if limit:
        spark.conf.set("shelfcast.skew.hotRows", limit)
    got = batch_ids(spark, rows, expiry=dt.timedelta(hours=1))
    spark.conf.unset("shelfcast.skew.hotRows")
    assert got == [0, 1, 60, 61]


def test_json_messages(spark):
    texts = [
        '{"type": "clipboard", "text": "hello"}', '{"type": "clipboard"}', '{"type": "key", "text": "x"}',
        '{"type": "clipboard", "text": ', "not json", "", None, '["clipboard"]',
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, message string")
    got = {r["i"]: r["text"] for r in json_messages(df).collect()}
    assert got == {0: "hello", 1: ""}
    assert json_messages(df).where(F.col("i") == 1).count() == 1
