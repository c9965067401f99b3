"""Retrieval by settings on a few units."""

import pytest

from quarryline.operators.pipeline import retrieve
from quarryline.sources.config import resolve_config

UNITS = [("a", "", "frame pool frame"), ("b", "", "frame of a window"), ("c", "", "pool of threads"), ("d", "", "nothing here"), ("e", "", "window frame pool threads")]


@pytest.fixture(scope="module")
def inputs(spark):
    units = spark.createDataFrame(UNITS, "id string, heading string, text string")
    return spark.createDataFrame([("q1", "frame pool"), ("q2", "threads"), ("q3", "zzz"), ("q4", None)], "query_id string, query string"), units


def listed(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.id, r.fusion, r.degraded))
    return out


def test_modes_and_limits(inputs):
    got = {m: listed(retrieve(*inputs, resolve_config({"top_k": 2}), m)) for m in ("lexical", "semantic", "hybrid")}
    assert all(set(x) == {"q1", "q2"} and all(len(v) <= 2 for v in x.values()) for x in got.values())
    assert got["lexical"]["q1"][0][1:] == ("lexical", False) and got["hybrid"]["q1"][0][1] == "weighted-v1" and {i for i, *_ in got["lexical"]["q1"]} == {"a", "e"}
    with pytest.raises(ValueError):
        retrieve(*inputs, mode="psychic")
    assert retrieve(inputs[0].limit(0), inputs[1]).count() == 0 and retrieve(inputs[0], inputs[1].limit(0)).count() == 0


def test_rules_and_routing(spark, inputs):
    got = listed(retrieve(*inputs, mode="lexical", rules={"token_expansions": {"zzz": ["nothing"]}}))
    assert [i for i, *_ in got["q3"]] == ["d"]
    way = spark.createDataFrame([("q1", "rrf-v1"), ("q9", "rrf-v1")], "query_id string, fusion string")
    got = listed(retrieve(*inputs, resolve_config({"fusion": "weighted-v2"}), routing=way))
    assert {f for _, f, _ in got["q1"]} == {"rrf-v1"} and {f for _, f, _ in got["q2"]} == {"weighted-v2"}


def test_a_model_reranks_and_its_failure_falls_back(inputs):
    def likes_b(queries, texts):
        return [9.0 if "of a window" in t else 0.0 for t in texts]

    def fails_on_threads(queries, texts):
        if "threads" in queries:
            raise OSError("no model")
        return likes_b(queries, texts)

    assert listed(retrieve(*inputs, mode="semantic", scorer=likes_b))["q1"][0] == ("b", "semantic", False)
    got = listed(retrieve(*inputs, mode="hybrid", scorer=fails_on_threads))
    want = listed(retrieve(*inputs, mode="lexical"))
    assert [i for i, *_ in got["q2"]] == [i for i, *_ in want["q2"]] and all(d for _, _, d in got["q2"])
