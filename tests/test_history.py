"""Versions against a walk in order, with and without hot entities."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from quarryline.functions.cleaning import epoch_micros, strip, utc_text
from quarryline.operators import history
from quarryline.plans.stages import materialize

SCHEMA = "entity string, at string, d timestamp_ntz, a string, b string"


def brute(rows):
    per = {}
    for e, at, d, a, b in rows:
        if at is None or not at.strip() or at == "bad" or not (e or "").strip():
            continue
        t = datetime.fromisoformat(at.replace("Z", "+00:00").split("+")[0])
        state = ((a or "").strip(), (b or "").strip().lower())
        per.setdefault(e.strip(), {}).setdefault(t, []).append((d, state))
    out = []
    for e, times in per.items():
        versions = []
        for t in sorted(times):
            s = max(times[t])[1]
            if not versions or versions[-1][1] != s:
                versions.append((t, s))
        for i, (t, s) in enumerate(versions):
            out.append((e, t.strftime("%Y-%m-%dT%H:%M:%SZ"), versions[i + 1][0].strftime("%Y-%m-%dT%H:%M:%SZ") if i + 1 < len(versions) else "", *s))
    return sorted(out)


def versions(df, hot):
    states = materialize(history.observed_states(df, "entity", "at", "d", {"a": strip("a"), "b": F.lower(strip("b"))}))
    v, straight = history.combine_logs(materialize(history.attribute_log(states, ["a", "b"], hot)), ["a", "b"], hot), history.versions(states, ["a", "b"], hot)
    assert sorted(map(str, v.collect())) == sorted(map(str, straight.collect()))
    return sorted(tuple(r) for r in v.select("entity", utc_text("valid_from"), F.coalesce(utc_text("valid_to"), F.lit("")), "a", "b").collect())


@pytest.mark.parametrize("hot", [200_000, 5])
def test_same_versions_as_a_walk(spark, hot):
    rng = random.Random(7)
    start = datetime(2024, 1, 1)
    rows = []
    for i in range(500):
        e = "hot" if i % 3 == 0 else rng.choice(["x", "y ", "z", None, " "])
        at = rng.choice([(start + timedelta(hours=rng.randrange(150))).strftime("%Y-%m-%dT%H:%M:%SZ")] * 9 + [None, "bad"])
        rows.append((e, at, start + timedelta(seconds=rng.randrange(10**6)), rng.choice([None, "", "p", " p", "q"]), rng.choice(["A", "a ", "b", None])))
    rows += rows[:50]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"instant": F.lit(1), "value": F.lit(2), "state": F.lit("clash")})
    assert versions(df, hot) == brute(rows)


def test_empty(spark):
    assert versions(spark.createDataFrame([], SCHEMA), 5) == []


def test_times(spark):
    cases = {
        "2024-03-01T10:00:00+00:00": "2024-03-01T10:00:00Z", "2024-03-01T10:00:00Z": "2024-03-01T10:00:00Z", "2024-03-01 10:00:00": "2024-03-01T10:00:00Z", "20240301T100000Z": "2024-03-01T10:00:00Z",
        "2024-03-01T10:00:00.999Z": "2024-03-01T10:00:00Z", "2024-03-01T10:00:00-05:00": "2024-03-01T15:00:00Z", "20240301T100000+0530": "2024-03-01T04:30:00Z", "2024-03-01T10:00": "2024-03-01T10:00:00Z",
        "2024-02-30T10:00:00Z": None, "2024-03-01T25:00:00Z": None, "unknown": None, "": None, " ": None, "1969-12-31T23:59:59Z": "1969-12-31T23:59:59Z", "2024-03-01": None,
    }
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = {r.t: r.u for r in spark.createDataFrame([(t,) for t in cases], "t string").select("t", utc_text(epoch_micros("t")).alias("u")).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == cases


def test_one_exchange_from_states_to_versions(spark):
    start = datetime(2024, 1, 1)
    df = spark.createDataFrame([(f"e{i % 9}", f"2024-01-{i % 28 + 1:02d}T00:00:00Z", start, str(i % 4), str(i % 3)) for i in range(300)], SCHEMA)
    states = materialize(history.observed_states(df, "entity", "at", "d", {"a": strip("a"), "b": strip("b")}))
    plan = history.versions(states, ["a", "b"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
