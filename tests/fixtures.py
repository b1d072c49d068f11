"""Small hand-built tables."""

from datetime import datetime, timedelta

START = datetime(2024, 3, 1)
ALARM = "uuid long, time timestamp_ntz, machine string, serial string, idx string, state double, " \
        "recipe string, batch string, skey string"


def at(seconds):
    return START + timedelta(seconds=seconds)


def alarms(spark, states, serial="m", first=0, step=60, idx="1"):
    rows = [
        (first + i, at((first + i) * step), serial, serial, idx, None if s is None else float(s), "r", "b", "_29_2_39_1")
        for i, s in enumerate(states)]
    return spark.createDataFrame(rows, ALARM)


def timed_alarms(spark, rows):
    """Rows of (clock as HH:MM:SS with a day offset, state)."""
    out = []
    for i, (day, clock, state) in enumerate(rows):
        h, m, s = (int(x) for x in clock.split(":"))
        out.append((i, START + timedelta(days=day, hours=h, minutes=m, seconds=s), "m", "m", "1", float(state), "r", "b", "k"))
    return spark.createDataFrame(out, ALARM)


def general(spark, rows):
    """Rows of (seconds, serial, state) with ids in the given order."""
    schema = "uuid long, time timestamp_ntz, line string, machine string, serial string, recipe string, batch string, " \
             "mode_state double, program_state double, carried double, total_cases long"
    out = [
        (i, at(t), "L", s, s, "r", "b", None, None if st is None else float(st), None, i)
        for i, (t, s, st) in enumerate(rows)]
    return spark.createDataFrame(out, schema)


def values(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]
