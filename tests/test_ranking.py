"""Rankings over more units than the former limit of candidates, on odd units and titles, against their SQL; and that no pair is written."""

import re
from pathlib import Path

import duckdb
import pytest

from quarryline.operators import ranking
from quarryline.operators import retrieval as r
from quarryline.plans.rewrite import rewrite
from quarryline.registry import oracle_sql, queries
from tests.conftest import plain, rows_of

ROWS = 5_300
TITLES = ["common words of item_3", "common", "what is the", "the", "zzz yyy", "heading", "only_joined", "Common w17 w3", "", None, "w1 w2 w3 w4 w5 w6 w7", "mmon wor"]
RANKINGS = [
    "abstain_decision", "fuse_rrf", "fuse_rrf_histogram", "fuse_weighted_v1", "fuse_weighted_v2", "fuse_writer_anchor_cap", "pool_lexical_floor", "pool_lexical_floor_reranked", "pool_lexical_floor_window",
    "pool_v2", "pool_v2_reranked", "pool_v2_window", "projection_case_metrics", "projection_summary", "retrieve_routed", "row_projection",
]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    at = tmp_path_factory.mktemp("ranking")
    c = duckdb.connect()
    c.execute(f"""CREATE TABLE chunks AS SELECT 'u' || i AS chunk_uid, CASE WHEN i % 3 = 0 THEN NULL WHEN i % 7 = 0 THEN 'heading' ELSE 's' || i % 40 END AS section_id,
      CASE WHEN i % 11 = 0 THEN '' ELSE 'Common words of item_' || i % 5 || ' w' || i % 23 || ' w' || i % 7 || repeat(' x' || i % 13 || ' y' || i % 29, 1 + i % 4) || CASE WHEN i = 17 THEN ' only_joined' ELSE '' END END AS clean_text FROM range({ROWS}) t(i)""")
    c.execute("CREATE TABLE guideline_records (guideline_id VARCHAR, title VARCHAR)")
    c.executemany("INSERT INTO guideline_records VALUES (?, ?)", [(f"g{i}", t) for i, t in enumerate(TITLES)])
    c.execute("CREATE TABLE paragraphs AS SELECT 'p' || i AS paragraph_id, 'chapter' || i % 3 AS chapter, 'common words w' || i % 23 || ' y' || i % 29 AS clean_text, 'd' AS document_link, 's' AS section_link FROM range(60) t(i)")
    c.execute("CREATE TABLE guideline_fls_source_mappings AS SELECT 'g' || i AS guideline_id, 'p' || i AS raw_fls_id FROM range(9) t(i)")
    for name in ("chunks", "guideline_records", "paragraphs", "guideline_fls_source_mappings"):
        c.execute(f"COPY {name} TO '{at}/{name}.parquet'")
    return str(at), c


@pytest.mark.parametrize("name", RANKINGS)
def test_no_unit_is_left_out(name, spark, folder):
    df = queries()[name](spark, folder[0])
    result = folder[1].execute(oracle_sql()[name])
    names = [x[0] for x in result.description]
    at = [names.index(n) for n in sorted(names)]
    assert rows_of(df) == sorted(tuple(plain(x[i]) for i in at) for x in result.fetchall())


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["nearest_by_overlap", "mapping_audit"])
def test_overlaps_are_counted_in_the_task(name, spark, folder):
    df = queries()[name](spark, folder[0])
    result = folder[1].execute(oracle_sql()[name])
    names = [x[0] for x in result.description]
    assert rows_of(df) == sorted(tuple(plain(x[names.index(n)]) for n in sorted(names)) for x in result.fetchall())
    assert "MapInArrow" in plan_of(df) and "Generate" not in plan_of(df)


def test_queries_are_rewritten_where_they_are(spark):
    q = spark.createDataFrame([("q", "The must item", "a", "semantic")], "query_id string, query string, marker string, mode string")
    df = rewrite(q, {"token_expansions": {"must": ["shall", "item"]}, "suppress_tokens_when_present": {"the": ["must"]}, "row_marker_terms": {"a": ["alpha"]}, "mode_specific_rules": {"semantic": {"t": {"item": ["entry"]}, "semantic_intent_prefix": "intent"}}})
    assert "Exchange" not in plan_of(df) and "Join" not in plan_of(df)
    row = df.first()
    assert (row.rewritten, row.added) == ("intent must item shall alpha entry", ["shall", "alpha", "entry"])
    assert row.tags == ["rewrite-v1", "token-suppression", "token-expansion", "row-marker-terms", "mode-specific-token-expansion", "semantic-intent-prefix"]


def test_a_limit_keeps_the_best_by_bm25(spark):
    units = spark.createDataFrame([("a", "", "pool pool"), ("b", "", "pool of threads in a longer text"), ("c", "", "pool")], "id string, heading string, text string")
    q = spark.createDataFrame([("q", "pool")], "query_id string, query string")
    best = {x.id for x in r.scored_pairs(q, units, 2).collect()}
    got = r.ranked_by(q, units, "query_id string, id string, rank int", lambda ix, x: (x.unit, x.lex_rank), limit=2).collect()
    assert {x.id for x in got} == best and len(best) == 2


def test_rounding():
    assert ranking.rounded(ranking.np.array([0.1234565, -2.5e-6, 0.0, 1e-7])).tolist() == [0.123457, -3e-06, 0.0, 0.0]


def test_labels_are_rolled_up_in_the_task(spark, folder):
    plan = plan_of(queries()["row_projection"](spark, folder[0]))
    assert "MapInArrow" in plan and not any(x in plan for x in ("Join", "Window", "HashAggregate", "SortAggregate"))


def test_rolled_up_labels_are_those_of_the_operator(spark):
    rows = [(0, "b", 0.5), (0, "a", 0.5), (2, "a", 0.25), (3, "b", 1.0), (3, "c", 1.0)]
    labels = ranking.labelled(spark.createDataFrame(rows, "id int, label string, score double"), 5)
    unit, score = ranking.np.array([3, 1, 0, 2]), ranking.np.array([0.2, 0.1, 0.6, 0.4])
    got = sorted(zip(*[x.tolist() for x in ranking.rolled_up(unit, score, labels)], strict=True))
    ranked = spark.createDataFrame([("q", int(u), float(s), i + 1) for i, (u, s) in enumerate(zip(unit, score, strict=True))], "query_id string, id int, s double, rank int")
    want = r.row_projection(ranked, spark.createDataFrame(rows, "id int, label string, score double"), "s")
    assert got == sorted(tuple(x)[1:] for x in want.collect())
    none = ranking.labelled(spark.createDataFrame([], "id int, label string, score double"), 5)
    assert [len(x) for x in ranking.rolled_up(unit, score, none)] == [0] * 5


@pytest.mark.parametrize("units", [1, 64, 130, 5_000])
def test_shared_counts_by_bits(units):
    np = ranking.np
    words = [f"w{i}" for i in range(300)]
    lists = [np.flatnonzero((np.arange(units) * (7 * i + 3) + i) % (1 + i % 5 if i % 3 else 90) == 0).astype(np.int32) for i in range(300)]
    ends = np.cumsum([0, *map(len, lists)]).tolist()
    index = ranking.Postings(dict(zip(words, zip(ends, ends[1:]), strict=False)), np.concatenate(lists), None, {})
    for asked in (words[:9], words, ["absent"], [], ["absent", *words[90:100]]):
        want = sum((np.bincount(lists[words.index(w)], minlength=units) for w in asked if w in words), np.zeros(units, np.int64))
        assert ranking.shared_counts(index, asked, units).tolist() == want.tolist()
    assert index.masks


def test_what_is_sent_to_the_tasks_is_compressed(spark):
    value = ranking.Postings({"a": (0, 50_000)}, ranking.np.arange(50_000, dtype=ranking.np.int32) % 7, None, {})
    sent = ranking._sender(spark)(value)
    assert Path(sent._path).stat().st_size < value.units.nbytes / 10
    got = spark.sparkContext.parallelize([0], 1).map(lambda _: (type(sent.value).__name__, sent.value.at, sent.value.units.tolist())).collect()
    assert got == [("Postings", value.at, value.units.tolist())]


@pytest.mark.parametrize("name", ["projection_case_metrics", "projection_summary"])
def test_no_ranked_row_is_exchanged_for_metrics(name, spark, folder):
    assert "Window" not in plan_of(queries()[name](spark, folder[0]))


@pytest.mark.parametrize("name", ["projection_case_metrics", "projection_summary"])
def test_hits_of_labels_are_not_exchanged(name, spark, folder, monkeypatch):
    plans, labelled = [], ranking.labelled
    monkeypatch.setattr(ranking, "labelled", lambda rows, units: plans.append(plan_of(rows)) or labelled(rows, units))
    queries()[name](spark, folder[0])
    assert plans and not any("Exchange" in x for x in plans)


@pytest.mark.parametrize("hits", [1, 5, 2_000_000])
def test_labels_in_the_task_are_those_of_the_operator(spark, monkeypatch, hits):
    texts = ["", None, "of the", "none known", "w1 w2 w3", "w3 w3 W2", "w1 w2 w3 w4 w5 w6", "w4", "w6 w7 w8 w9 w1", *[f"w{i % 11} w{i % 7} w{i % 5} x{i}" for i in range(40)]]
    units = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    rows = [(f"l{n}", f"w{k}", len(range(n % 4, 11, 1 + n % 3))) for n in range(9) for k in range(n % 4, 11, 1 + n % 3)]
    profiles = spark.createDataFrame([*rows, ("\U0001f600", "w6", 1), ("\uff5e", "w6", 1)], "label string, k string, terms long")
    monkeypatch.setattr(ranking, "LABEL_HITS", hits)
    for given in (profiles, profiles.limit(0)):
        got = r.unit_labels(units, given)
        assert "Exchange" not in plan_of(got)
        assert sorted(got.collect()) == sorted(r.label_scores(units, given).select("id", "label", "score").collect())
    monkeypatch.setattr(r, "BROADCAST_BYTES", 0)
    assert sorted(r.unit_labels(units, profiles).collect()) == sorted(r.label_scores(units, profiles).select("id", "label", "score").collect())


@pytest.mark.parametrize("name", ["projection_case_metrics", "projection_summary"])
def test_texts_are_not_exchanged_for_tokens(name, spark, folder, monkeypatch):
    plans, postings = [], ranking._postings
    monkeypatch.setattr(ranking, "_postings", lambda rows, counted: (counted or plans.append(plan_of(rows))) and None or postings(rows, counted))
    queries()[name](spark, folder[0])
    assert plans and not any(re.search("(?<!Broadcast)Exchange", x) for x in plans)
