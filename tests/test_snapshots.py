"""Lookup tables against sets, the hash against Spark's, and the rules on unknown content."""

import random

import numpy as np
from pyspark.sql import functions as F

from quarryline.operators import snapshots as s

INV = "source_table string, corpus string, entity_id string, snapshot_id string, digest string, at string"
SNAP = "snapshot_id string, corpus string, commit_sha string, fetched_at string"


def days(n, corpus="c", sha=lambda i: f"{i:040x}"):
    return [(f"s{i}", corpus, sha(i), f"2024-01-{i + 1:02d}T00:00:00Z") for i in range(n)]


def changes(spark, rows, snaps, **more):
    got = s.inventory_changes(spark.createDataFrame(rows, INV), spark.createDataFrame(snaps, SNAP), **more)
    return sorted((r.entity_id, r.snapshot_id, r.change_kind) for r in got.collect())


def test_hash_is_sparks(spark):
    keys = np.array([0, 1, -1, 2**62, -(2**63), 123456789], np.int64)
    digests = keys[::-1].copy()
    df = spark.createDataFrame(list(zip(keys.tolist(), digests.tolist(), strict=True)), "k long, d long")
    assert [r[0] for r in df.select(F.xxhash64("k", "d", F.lit(-1).cast("long"))).collect()] == s._pair_hash(keys, digests, -1).tolist()


def test_many_changes_with_tiny_tables(spark):
    rng = random.Random(3)
    state, rows, want = {}, [], []
    for i in range(5):
        new = {k: v for k, v in state.items() if rng.random() > 0.2}
        new = {k: (rng.randrange(10**9) if rng.random() < 0.3 else v) for k, v in new.items()}
        new |= {f"e{i}_{j}": rng.randrange(10**9) for j in range(120)}
        if i:
            want += [(k, f"s{i}", "added") for k in new if k not in state] + [(k, f"s{i}", "removed") for k in state if k not in new] + [(k, f"s{i}", "changed") for k in new if k in state and state[k] != new[k]]
        rows += [("t", "c", k, f"s{i}", f"{v:x}", None) for k, v in new.items()]
        state = new
    assert changes(spark, rows, days(5), bucket_rows=300, first_cells=2) == sorted(want)


def test_unknown_content(spark):
    one = lambda e, i, d, at="2024-01-01T00:00:00Z": ("t", "c", e, f"s{i}", d, at)
    rows = [one("back", 0, "a"), one("back", 1, None), one("back", 2, "a"), one("moved", 0, "a"), one("moved", 1, None), one("moved", 2, "b")]
    rows += [one("fresh", 1, None), one("fresh", 2, "a"), one("again", 0, "a"), one("again", 2, "b"), one("start", 0, None), one("start", 1, "b"), one("start", 2, "b")]
    rows += [one("late", 0, "x", "2024-01-02T00:00:00Z"), one("late", 0, "y", "2024-01-01T00:00:00Z"), one("late", 1, "x"), one("late", 1, "x"), one("late", 2, "x", None)]
    assert changes(spark, rows, days(3)) == [("again", "s1", "removed"), ("again", "s2", "added"), ("fresh", "s1", "added"), ("moved", "s2", "changed")]


def test_missing_snapshots_and_ids(spark):
    rows = [("t", "c", "e", "s0", "a", None), ("t", "c", "e", "s2", "b", None), ("t", "c", "e", "nowhere", "z", None)]
    assert changes(spark, rows, [*days(3), ("bad", "c", "x", "never")]) == [("e", "s2", "changed")]
    assert changes(spark, [], days(2)) == []
    assert changes(spark, rows, []) == []


def test_commits(spark):
    snaps = [("s0", "c", "ABCDEF0123", "2024-01-01T00:00:00Z"), ("s1", "c", " abcdef ", "2024-01-02 00:00:00"), ("s2", "c", "abc999", "20240103T000000Z"), ("s2", "c", "abc999", "20240103T000000Z"), ("s3", "c", None, "2024-01-04T00:00:00Z")]
    got = s.commit_changes(spark.createDataFrame(snaps, SNAP)).collect()
    assert [(r.entity_id, r.snapshot_id, r.change_kind) for r in got] == [("c", "s2", "changed")]


def test_peel_reports_what_it_cannot():
    full = np.arange(3, dtype=np.int64)
    parts, stuck = s.peel(np.array([7, 7, 7]), full, np.array([2, 2, 2]), full + 5, full + 9, full + 3, 1)
    assert len(parts[0]) == 0 and stuck.tolist() == [7]
