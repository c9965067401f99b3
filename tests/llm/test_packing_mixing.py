"""Containers and mixtures: nothing lost, nothing over, close to what can be reached."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarryline.llm import mixing as m
from quarryline.llm import packing as p
from quarryline.llm.tokens import encoder, token_counts


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 30), max_size=20))
def test_tiers_are_labels_only(counts):
    tiered, plain = p.plan_containers(counts, 64, (8, 16, 32, 64)), p.plan_containers(counts, 64, (64,))
    assert [(c.lengths, c.times) for c in tiered] == [(c.lengths, c.times) for c in plain]


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 30), max_size=20))
def test_plan(counts):
    plan = p.plan_containers(counts, 64, (8, 16, 32, 64))
    total = {}
    for c in plan:
        assert c.used <= 64 and c.times > 0 and c.tier >= c.lengths[0][0]
        for length, n in c.lengths:
            total[length] = total.get(length, 0) + n * c.times
    assert total == counts
    boxes, need = sum(c.times for c in plan), sum(k * v for k, v in counts.items())
    assert boxes <= 2 * need / 64 + 1


def sized(spark, lengths):
    return spark.createDataFrame(list(enumerate(lengths)), "doc_id long, n_tokens long").withColumns({"rank": F.lit("clash"), "piece_no": F.lit(9), "tier": F.lit(1)})


def test_pack(spark):
    rng = random.Random(2)
    lengths = [rng.choice([0, 3, 7, 50, 300, 900, 2048, 2049, 5000, rng.randrange(1, 2500)]) for _ in range(600)] + [100] * 300
    rows = p.pack(sized(spark, lengths)).collect()
    by_doc, boxes = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        if r.container_id is not None:
            boxes.setdefault(r.container_id, []).append(r)
    assert sorted(by_doc) == list(range(len(lengths)))
    for d, parts in by_doc.items():
        parts.sort(key=lambda r: r.piece_no)
        assert sum(r.n_tokens for r in parts) == lengths[d] and len(parts) == max(1, -(-lengths[d] // 2048))
        assert [r.token_start for r in parts] == [2048 * i for i in range(len(parts))]
    for box in boxes.values():
        box.sort(key=lambda r: r.container_offset)
        assert all(a.container_offset + a.n_tokens == b.container_offset for a, b in zip(box, box[1:], strict=False)) and box[0].container_offset == 0
        assert box[-1].container_offset + box[-1].n_tokens <= 2048 and len({(r.tier, r.step_group) for r in box}) == 1
    assert len(boxes) <= 1.03 * sum(lengths) / 2048 + 2
    steps = {}
    for box in boxes.values():
        steps[box[0].step_group] = steps.get(box[0].step_group, 0) + 1
    assert max(steps.values()) <= p.STEP


def test_pack_edges(spark):
    assert p.pack(spark.createDataFrame([], "doc_id long, n_tokens long")).count() == 0
    only = p.pack(sized(spark, [0, 0])).collect()
    assert [(r.n_tokens, r.container_id) for r in only] == [(0, None), (0, None)]
    assert p.pack(sized(spark, [2048])).first().container_offset == 0
    with pytest.raises(ValueError):
        p.pack(sized(spark, [1]), capacity=100)


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 6), min_size=1, max_size=8), st.integers(0, 400), st.sampled_from([8, 50, 10**6]))
def test_subset(counts, target, rest):
    got = m.fit_subset(counts, target, rest)
    assert all(0 < n <= counts[k] for k, n in got.items())
    total = sum(k * n for k, n in got.items())
    assert total <= max(0, min(target, sum(k * n for k, n in counts.items())))
    if rest == 10**6 and target:
        # dynamic programming reaches what is left after the proportional part exactly, if any choice does
        share = {k: n * min(target, sum(a * b for a, b in counts.items())) // sum(a * b for a, b in counts.items()) for k, n in counts.items()}
        base = sum(k * n for k, n in share.items())
        sums = {0}
        for k, n in counts.items():
            sums = {s + k * i for s in sums for i in range(n - share[k] + 1)}
        goal = min(target, sum(a * b for a, b in counts.items())) - base
        assert total == base + max(s for s in sums if s <= goal)


def test_mix(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice(["big"] * 8 + ["small", "mid", "mid", "unlisted", None]), rng.randrange(0, 400)) for i in range(1500)]
    targets = spark.createDataFrame([("big", 0.5, 1), ("Mid ", 0.3, 3), ("small", 0.2, 4), ("none", 0.0, 2), ("gone", 0.1, 2)], "source string, target_share double, max_repeats int")
    df = spark.createDataFrame(rows, "doc_id long, source string, n_tokens long").withColumns({"laps": F.lit("clash"), "uses": F.lit(0), "extra": F.lit(1)})
    used, plans, wanted = m.mix(df, targets)
    got = used.collect()
    total = sum(r.uses * r.n_tokens for r in got)
    shares = {s: sum(r.uses * r.n_tokens for r in got if r.source == s) / total for s in wanted}
    assert shares["big"] == pytest.approx(0.5, abs=0.001) and shares["mid"] == pytest.approx(0.3, abs=0.001) and shares["small"] == pytest.approx(0.2, abs=0.001) and shares["gone"] == shares["none"] == 0
    assert all(0 < r.uses <= wanted[r.source][1] and r.n_tokens > 0 for r in got) and len({r.doc_id for r in got}) == len(got)
    assert sorted(m.mix(df, targets)[0].collect()) == sorted(got)
    assert sorted(m.mix(df, targets, seed=5)[0].collect()) != sorted(got)
    half = m.mix(df, targets, total=10_000)[0].collect()
    assert sum(r.uses * r.n_tokens for r in half) == pytest.approx(10_000, abs=3)
    assert m.mix(df.limit(0), targets)[0].count() == 0


def test_token_counts(spark):
    texts = ["Hello, world!", None, "", "naïve café 你好 \U0001f600", "<|endoftext|>", "x" * 10_000, " \n\t "]
    rows = token_counts(spark.createDataFrame(list(enumerate(texts)), "i int, t string").withColumn("n_tokens", F.lit(7)), "t").orderBy("i").collect()
    assert [r.n_tokens for r in rows] == [len(encoder().encode_ordinary(t or "")) for t in texts] and rows[1].n_tokens == rows[2].n_tokens == 0
    assert encoder().decode(encoder().encode_ordinary(texts[3])) == texts[3]


def test_checks(same_as_sql):
    from quarryline.llm import mixing, packing

    same_as_sql(packing.p7_checks, packing.ORACLES["p7_checks"])
    same_as_sql(mixing.p8_checks, mixing.ORACLES["p8_checks"])
