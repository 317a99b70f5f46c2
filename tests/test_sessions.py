"""Sessions of a table and of a stream; a user with very many events sends few rows."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tradewind.operators.sessions import conversion_by_day, sessions
from tradewind.streaming.sessions import EVENTS, stream_sessions

START = datetime(2024, 1, 1)


def events(spark, rows):
    """Rows (user, minute, type, value)."""
    told = [(k, None if m is None else START + timedelta(minutes=m), u, t, v) for k, (u, m, t, v) in enumerate(rows)]
    return spark.createDataFrame(told, EVENTS)


def shown(df):
    return sorted((r.user_id, r.session_start, r.session_end, r.events, r.converted, None if r.value is None else float(r.value)) for r in df.collect())


def test_gaps_and_conversions(spark):
    rows = [(1, 0, "view", 1.0), (1, 29.99, "click", 2.0), (1, 60, "purchase", 5.5), (1, 60, "purchase", 2.25), (2, 0, "view", 1.0), (2, 30, "view", 1.0), (2, 60.01, "view", 1.0)]
    rows += [(None, 0, "purchase", 1.0), (3, None, "purchase", 1.0), (3, 1440, None, None)]
    at = lambda m: START + timedelta(minutes=m)
    found = sessions(events(spark, rows))
    assert shown(found) == [
        (1, at(0), at(29.99), 2, False, None), (1, at(60), at(60), 2, True, 7.75), (2, at(0), at(30), 2, False, None),
        (2, at(60.01), at(60.01), 1, False, None), (3, at(1440), at(1440), 1, False, None),
    ]
    by_day = {str(r.day): (r.sessions, r.converting_sessions, r.conversion_rate) for r in conversion_by_day(found).collect()}
    assert by_day == {"2024-01-01": (4, 1, 25.0), "2024-01-02": (1, 0, 0.0)}
    assert sessions(events(spark, rows).limit(0)).count() == 0


def test_sessions_go_past_midnight(spark):
    minutes = [1430, 1439.5, 1440, 1455, 1500, 2870, 2885, 2900, 4319, 4330]
    found = shown(sessions(events(spark, [(1, m, "view", 1.0) for m in minutes])))
    assert [(s, n) for _, s, _, n, _, _ in found] == [(START + timedelta(minutes=m), n) for m, n in ((1430, 4), (1500, 1), (2870, 3), (4319, 2))]


def test_a_busy_user_spreads_over_days(spark):
    plan = sessions(events(spark, [(1, 0, "view", 1.0)]))._jdf.queryExecution().executedPlan().toString()
    first = plan.split("Exchange hashpartitioning(")[-1]
    assert first.startswith("user_id") and first.split(")")[0].count(",") == 2  # user, day, number of partitions


def test_stream_gives_sessions_once_they_ended(spark, tmp_path):
    folder, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    rows = [(u, m, "purchase" if m == 20 else "view", 1.0) for u in (1, 2) for m in (0, 10, 20, 100, 110)]
    for part in (rows[:4], rows[4:], [(9, 400, "view", 1.0)]):  # the last event moves the watermark past all others
        events(spark, part).coalesce(1).write.mode("append").parquet(folder)
        stream_sessions(spark, folder, out, checkpoint, "2 hours").awaitTermination()
    events(spark, [(9, 800, "view", 1.0), (1, 5, "view", 1.0)]).coalesce(1).write.mode("append").parquet(folder)  # one is too late
    stream_sessions(spark, folder, out, checkpoint, "2 hours").awaitTermination()
    ended = spark.read.parquet(out)
    assert shown(ended) == shown(sessions(events(spark, rows)).union(sessions(events(spark, [(9, 400, "view", 1.0)]))))
    assert ended.filter(F.col("converted")).count() == 2
