"""Event-time counts: closing periods, late rows, state that is evicted."""

import datetime as dt

from pyspark.sql import functions as F

from medalla.session import scratch_root
from medalla.streaming.event_time import EventTimeCounts, arrivals


def _counts(spark, rows, **kw):
    root = scratch_root(spark, "event-time-test")
    df = spark.createDataFrame(rows, "ts timestamp, kind string, value double, arrival int")
    schema = df.drop("arrival").schema
    spark.createDataFrame([], schema).write.parquet(f"{root}/in")
    return df, EventTimeCounts(spark, f"{root}/in", f"{root}/out", schema, "ts", ["kind"], **kw)


def _at(*ymd):
    return dt.datetime(*ymd, 12)


ROWS = [
    (_at(2020, 1, 5), "a", 1.0, 0), (_at(2020, 1, 9), "b", 2.0, 0), (_at(2020, 2, 1), "a", 4.0, 0),
    (_at(2020, 3, 2), "a", 8.0, 1), (_at(2020, 1, 31), "a", 16.0, 1),  # January is still open for this batch
    (_at(2020, 1, 20), "a", 32.0, 2), (_at(2020, 2, 20), "b", 64.0, 2),  # January has closed, February not
    (None, "a", 128.0, 2), (_at(2020, 4, 30), None, 256.0, 2),
]


def test_two_batches_with_late_rows(spark):
    rows, c = _counts(spark, ROWS, value="value", unit="month", delay="35 days")
    got = arrivals(c, rows, "arrival", range(3))
    assert [g["dropped"] for g in got] == [0, 0, 0]
    closed = sorted(tuple(r) for r in c.closed().collect())
    jan, feb = dt.date(2020, 1, 1), dt.date(2020, 2, 1)
    assert closed == [(jan, "a", 2, 17.0), (jan, "b", 1, 2.0), (feb, "a", 1, 4.0), (feb, "b", 1, 64.0)]
    late = sorted((r.value, r.batch_id) for r in c.late().collect())
    assert late == [(32.0, 2), (128.0, 2)]
    opened = sorted(((r.periodo, r.kind, r.eventos) for r in c.open_periods().collect()), key=str)
    assert opened == [(dt.date(2020, 3, 1), "a", 1), (dt.date(2020, 4, 1), None, 1)]
    # closed periods have left the state: what is left is what is open
    assert got[0]["state_rows"] == 3 and got[1]["state_rows"] == 2 and got[2]["state_rows"] == 2
    # closed + late + open is every row
    assert sum(r[2] for r in closed) + len(late) + sum(r[2] for r in opened) == len(ROWS)


def test_refresh_without_new_files_changes_nothing(spark):
    rows, c = _counts(spark, ROWS, unit="month", delay="35 days")
    arrivals(c, rows, "arrival", range(3))
    before = sorted(c.closed().collect())
    again = c.refresh()
    assert sorted(c.closed().collect()) == before and again["dropped"] == 0


def test_empty_source_and_fixed_days(spark):
    _, c = _counts(spark, [], unit="day", delay="2 days")
    assert c.refresh()["watermark"] is None
    assert c.closed().count() == c.late().count() == c.open_periods().count() == 0


def test_stream_equals_batch_over_rows_in_time(spark):
    """A year of days in shuffled arrival; the batch answer leaves out just
    what the late table holds."""
    n = 400
    rows = [(dt.datetime(2021, 1, 1) + dt.timedelta(days=(i * 37) % 90, hours=i % 24), "ab"[i % 2], float(i),
             ((i * 37) % 90) // 30 + (1 if i % 11 == 0 else 0)) for i in range(n)]
    df, c = _counts(spark, rows, unit="day", delay="5 days")
    arrivals(c, df, "arrival", range(4))
    late = c.late().select("ts", "kind", "value")
    assert 0 < late.count() < n / 11 + 1
    in_time = df.select("ts", "kind", "value").exceptAll(late)
    want = in_time.groupBy(F.to_date("ts").alias("periodo"), "kind").agg(F.count(F.lit(1)).alias("eventos"))
    got = c.closed().unionByName(c.open_periods())
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
