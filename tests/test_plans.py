"""Provenance, models, salted ranks and checkpoints."""

import pytest
from pyspark.sql import functions as F

from quarryline.operators import models as m
from quarryline.operators.retrieval import hinted_order
from quarryline.plans import provenance as p
from quarryline.plans.stages import materialize, rank_in_key, salts_for, split_hot


def test_fingerprints():
    now = {"corpus": "c", "schema": 3, "params": {"b": 1, "a": 2}}
    assert p.canonical_hash(now) == p.canonical_hash({"params": {"a": 2, "b": 1}, "schema": 3, "corpus": "c"})
    assert p.guard_run(None, now)[1] == [] and p.guard_run(now, dict(now))[1] == []
    with pytest.raises(p.StaleRun):
        p.guard_run(now, {**now, "schema": 4})
    assert p.guard_run(now, {**now, "schema": 4}, allow_stale=True)[1] == ["schema"]


def test_identities(spark):
    rows = [("a", 1, "x"), ("a", 2, None), ("b", 3, "z")]
    one = p.identities(spark.createDataFrame(rows, "g string, n0 int, s string"), "g", "n0", "s")
    two = p.identities(spark.createDataFrame(rows[::-1], "g string, n0 int, s string"), "g", "n0", "s")
    assert p.regressions(one, two, "g").count() == 0
    three = p.identities(spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("c", 3, "z")], "g string, n0 int, s string"), "g", "n0", "s")
    assert sorted(r.g for r in p.regressions(one, three, "g").collect()) == ["a", "b", "c"]


def test_fill(spark):
    full = spark.createDataFrame([(1, "a")], "k int, v string")
    assert p.fill_if_empty(full, lambda: 1 / 0).count() == 1
    assert p.fill_if_empty(full.limit(0), lambda: full.select("v", "k")).columns == ["k", "v"]


def test_models(spark):
    pairs = spark.createDataFrame([("q", i, "word", "word " * (i % 3) if i % 7 else None) for i in range(100)], "query_id string, id int, query string, text string")
    got = m.model_scores(pairs, lambda q, t: [{"index": i, "score": x.count("word")} for i, x in reversed(list(enumerate(t)))])
    assert all(r.score == (r.id % 3 if r.id % 7 else 0) and not r.degraded for r in got.collect()) and got.count() == 100
    broken = m.model_scores(pairs, lambda q, t: 1 / 0, retries=0).collect()
    assert len(broken) == 100 and all(r.degraded and r.score == 0 for r in broken)
    calls = []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise OSError
        return [1.0]

    assert m.with_retries(flaky, 2, 0) == [1.0] and m.aligned([0.5], 2) == [0.5, 0.0] and m.aligned([{"index": 5, "score": 1}], 2) == [0.0, 0.0]


def test_hints(spark):
    top = spark.createDataFrame([("q", "a", 1), ("q", "b", 2), ("q", "c", 3)], "query_id string, id string, rank int")
    kinds = spark.createDataFrame([("a", "enum"), ("c", "struct")], "id string, kind string")
    got = hinted_order(top, kinds, spark.createDataFrame([("q", "which Struct is it")], "query_id string, query string"))
    assert [r.id for r in got.orderBy("place").collect()] == ["c", "a", "b"]


def test_salted_ranks(spark):
    df = spark.createDataFrame([("hot" if i % 3 else f"k{i}", i) for i in range(900)], "k string, i int")
    ranks = {}
    for r in rank_in_key(df, ["k"], ["i"], salts=16).collect():
        ranks.setdefault(r.k, []).append(r["rank"])
    assert all(sorted(v) == list(range(len(v))) for v in ranks.values())
    assert rank_in_key(df.limit(0), ["k"], ["i"]).count() == 0
    assert (salts_for(0), salts_for(25_600_000), salts_for(25_600_001), salts_for(10**9)) == (256, 256, 512, 16384)


def test_hot_keys_are_cut(spark):
    df = spark.createDataFrame([("hot", i) for i in range(500)] + [("cold", i) for i in range(5)], "k string, i int")
    parts = split_hot(df, ["k"], "i", hot_rows=100)
    sizes = {(r.k, r["_bucket"]): r["count"] for r in parts.groupBy("k", "_bucket").count().collect()}
    assert sizes["cold", 0] == 5 and max(n for (k, _), n in sizes.items() if k == "hot") < 30 and parts.count() == 505
    edges = parts.where("k = 'hot'").groupBy("_bucket").agg(F.min("i").alias("a"), F.max("i").alias("b")).orderBy("_bucket").collect()
    assert all(x.b < y.a for x, y in zip(edges, edges[1:], strict=False))


def test_checkpoints_survive(spark):
    df = materialize(spark.range(10).withColumn("r", F.rand()))
    assert df.collect() == df.collect() and not spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty()
